"""Query catalogue: name -> job(spark, sf_dir) -> DataFrame, and name -> oracle SQL.

Report, profile, KPI and forecast jobs read the star schema built once per
source and session (`warehouse.star`); the per-operator cleaning views read
the raw records landed once per session (`warehouse.raw`).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from tillflow import oracle
from tillflow.plans import cells, dashboard, etl_steps, forecast, kpis, profile, reports, warehouse

Job = Callable[[SparkSession, str], DataFrame]


def _on_star(fn, *args) -> Job:
    """Job that runs fn(star, *args) on the star schema of sf_dir."""
    def job(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(warehouse.star(spark, sf_dir), *args)
    job.__name__ = getattr(fn, "__name__", "job")
    job.__doc__ = fn.__doc__
    return job


# D5-D15, which the dashboard computes for every selection.
_KPI_VIEWS = {
    **{name: getattr(kpis, name) for name in (
        "kpi_summary", "churn_rate", "retention_rate", "dash_category_revenue", "dash_status_counts",
        "dash_top_products", "dash_state_ticket", "kpi_formatted")},
    "resample_daily": partial(kpis.resample, freq="D"),
    "resample_weekly": partial(kpis.resample, freq="W"),
    "resample_monthly": partial(kpis.resample, freq="MS"),
}

# Jobs on a built star: name -> job(star) -> DataFrame.
STAR_JOBS: dict[str, Callable[[warehouse.Star], DataFrame]] = {
    # Q1-Q7: named SQL reports
    **{name: getattr(reports, name) for name in (
        "revenue_by_category", "top_customers", "monthly_revenue", "ticket_by_state",
        "top_products_by_category", "rfm_customers", "status_distribution")},
    # Reads by one key, through the clustered copy of the fact
    **{name: getattr(reports, name) for name in ("sales_of_customer", "sales_of_product", "sales_between")},
    # Exploratory statistics
    **{name: getattr(profile, name) for name in (
        "numeric_stats", "categorical_stats", "correlation_matrix", "iqr_bounds", "outlier_rows",
        "outlier_summary", "outlier_detail", "top_outliers", "boxplot_stats", "dataset_profile")},
    # Dashboard data jobs: the opening state, a selection with every filter, an empty one
    "filtered_sales": kpis.filtered_sales_report,
    "customer_lifecycle": kpis.customer_lifecycle,
    "filter_domains": kpis.filter_domains,
    **_KPI_VIEWS,
    **{f"{name}_selection": partial(fn, p=kpis.SELECTION) for name, fn in _KPI_VIEWS.items()},
    **{f"{name}_empty": partial(fn, p=kpis.NOTHING) for name, fn in _KPI_VIEWS.items()},
    # D5, Q4, E10 from kept customer sets
    "kpi_merged": cells.kpi_merged,
    "kpi_merged_selection": partial(cells.kpi_merged, p=kpis.SELECTION),
    "kpi_merged_empty": partial(cells.kpi_merged, p=kpis.NOTHING),
    "state_merged": cells.state_merged,
    "profile_merged": cells.profile_merged,
    # D5-D14 of one dashboard state from one scan
    "dashboard": dashboard.dashboard,
    "dashboard_selection": partial(dashboard.dashboard, p=kpis.SELECTION),
    "dashboard_empty": partial(dashboard.dashboard, p=kpis.NOTHING),
    # forecast
    "daily_revenue_dense": forecast.daily_revenue_dense,
    "calendar_features": forecast.calendar_feature_table,
    **{name: getattr(forecast, name) for name in (
        "train_test_split", "split_summary", "forecast_holdout", "forecast_metrics", "baseline_metrics",
        "forecast_next_month", "forecast_total", "mean_month_revenue", "monthly_history")},
}

QUERIES: dict[str, Job] = {
    # C*, M*, S2: cleaning and modelling operators
    **etl_steps.STEP_QUERIES,
    **{name: _on_star(fn) for name, fn in STAR_JOBS.items()},
}

ORACLE: dict[str, Callable[[], str]] = {
    **oracle.STEP_SQL, **oracle.REPORT_SQL, **oracle.PROFILE_SQL, **oracle.KPI_SQL,
    **oracle.FORECAST_SQL,
}


def queries() -> dict[str, Job]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {name: make() for name, make in ORACLE.items() if name in QUERIES}
