"""Plan-shape checks: the physical plans keep the properties the design relies on."""

import re
import uuid

import pytest
from pyspark.sql import functions as F

from helpers import raw_df, sale
from tillflow.operators import cleaning as C
from tillflow.plans import catalog, kpis, reports
from tillflow.plans.warehouse import build_star
from tillflow.session import scratch_path
from tillflow.sources.sinks import write_table

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_first_limits_before_the_shuffle(spark):
    df = raw_df(spark, [sale("T1"), sale("T1", price="2.00"), sale("T2")])
    p = plan(df.transform(C.dedupe_keep_first))
    assert re.search(r"WindowGroupLimit .*Partial", p), p
    # the partial limit sits below the exchange (map side)
    assert p.index("Exchange hashpartitioning") < p.rindex("Partial")


def test_hot_key_dedupe_and_median(spark):
    """A transaction id holding a third of the rows: one row survives, the median is exact."""
    rows = [sale("HOT", qty=float(i % 7 + 1)) for i in range(300)] + \
           [sale(f"T{i}", qty=float(i % 5 + 1)) for i in range(600)]
    out = C.clean_sales(raw_df(spark, rows))
    assert out.count() == 601
    assert out.where("ID_Transacao = 'HOT'").first()["Quantidade"] == 1


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_no_cartesian_or_python_in_plans(spark, name):
    p = plan(catalog.queries()[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
        assert bad not in p, f"{name}: {bad}"


def test_dashboard_filters_reach_the_scan(spark, star_small):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        p = plan(kpis.filtered_sales(star_small, kpis.DEMO))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PushedFilters: [IsNotNull(Data_Venda), GreaterThanOrEqual(Data_Venda,1996-01-01)" in p
    assert "In(Status_Pedido" in p and "In(Categoria_Produto" in p


def test_rfm_quartile_has_no_global_window(spark, star_small):
    p = plan(reports.rfm_customers(star_small))
    assert "Window" not in p and "ntile" not in p.lower()
    assert "rangepartitioning" not in p  # the index's own layout orders the result: no second sort
    values = [r["valor_total"] for r in reports.rfm_customers(star_small).collect()]
    assert values == sorted(values, reverse=True)


def test_top_k_uses_take_ordered(spark, star_small):
    assert "TakeOrderedAndProject" in plan(reports.top_customers(star_small))
    assert "WindowGroupLimit" in plan(reports.top_products_by_category(star_small))


def test_buyers_are_distinct_before_the_semi_join(spark, star_small):
    p = plan(kpis.churn_rate(star_small))
    semi = p[p.index("LeftSemi"):]
    assert "HashAggregate(keys=[ID_Cliente" in semi
    # without a category filter the product dimension is not joined
    assert "ID_Produto" not in p


def test_hot_customer(spark):
    """One customer with most of the sales: the rates count customers, not sales."""
    rows = [sale(f"H{i}", cust="CLI00001", date="1998-08-01") for i in range(500)]
    rows += [sale("A", cust="CLI00002", date="1998-01-01"), sale("B", cust="CLI00003", date="1998-08-02")]
    star = build_star(spark, raw_df(spark, rows), scratch_path(spark, f"hot-{uuid.uuid4().hex}"))
    assert tuple(kpis.churn_rate(star).first()) == (90, 3, 33.33)
    assert tuple(kpis.retention_rate(star).first()) == (1, 0.0)


def test_fact_files_cover_disjoint_dates(spark, star_small):
    key = "spark.sql.adaptive.coalescePartitions.enabled"  # else so small a table is one file
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        fact = write_table(star_small.fact, scratch_path(spark, f"fact-{uuid.uuid4().hex}"),
                           date_col="Data_Venda", key_col="ID_Transacao")
    finally:
        spark.conf.set(key, before)
    files = fact.groupBy(F.input_file_name().alias("f")).agg(
        F.min("Data_Venda").alias("a"), F.max("Data_Venda").alias("b")).orderBy("a", "b").collect()
    assert len(files) > 4
    assert all(x["b"] <= y["a"] for x, y in zip(files, files[1:]))  # at most a shared day
    assert fact.exceptAll(star_small.fact).isEmpty()


# product reports: queries that read a product column but move no sale for it
PRODUCT_REPORTS = ["revenue_by_category", "top_products_by_category", "categorical_stats", "dataset_profile",
                   "dash_category_revenue", "dash_category_revenue_selection", "dash_top_products",
                   "dash_top_products_selection", "outlier_rows", "outlier_detail", "top_outliers", "filtered_sales",
                   "enriched_sales", "kpi_summary_selection", "filter_domains"]


def exchanges_of_sales(p: str) -> list[str]:
    """Exchanges of a plan with the scan of the fact below and no aggregate or limit between."""
    lines = [x for x in p.split("\n") if x.strip()]
    depth = [len(x) - len(x.lstrip(" :+-*()0123456789")) for x in lines]
    bad = []
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" not in line and "Exchange rangepartitioning" not in line:
            continue
        for j in range(i + 1, len(lines)):
            if depth[j] <= depth[i] or "Aggregate" in lines[j] or "TakeOrdered" in lines[j]:
                break
            if "Scan parquet" in lines[j] and "Faturamento" in lines[j] + line or "/fact" in lines[j]:
                bad.append(line)
    return bad


@pytest.mark.parametrize("name", PRODUCT_REPORTS)
def test_product_join_moves_no_sales(spark, name):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        p = plan(catalog.queries()[name](spark, SF))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "Scan parquet" in p
    assert exchanges_of_sales(p) == []


def test_a_product_dimension_beyond_the_limit_is_not_broadcast(spark, star_small, monkeypatch):
    from tillflow.plans import warehouse
    whole = star_small.product_bytes
    wide = star_small.enriched()
    assert "BroadcastHashJoin" in plan(wide) and star_small.product_bytes > 0
    monkeypatch.setattr(warehouse, "PRODUCT_BROADCAST_BYTES", 10)
    merged = star_small.enriched()
    assert "Broadcast" not in plan(merged) and exchanges_of_sales(plan(merged)) != []
    assert merged.exceptAll(wide).isEmpty() and merged.count() == wide.count()
    # the reports still join sums, not sales
    assert exchanges_of_sales(plan(reports.revenue_by_category(star_small))) == []
    assert whole is None or whole == star_small.product_bytes
