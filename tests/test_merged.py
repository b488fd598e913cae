"""Kept customer sets and the one-scan dashboard, against count_distinct and the single jobs."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tillflow.operators import distinct as D
from tillflow.plans import cells, dashboard, kpis, reports

STATES = {"open": kpis.DEFAULT, "selection": kpis.SELECTION, "empty": kpis.NOTHING,
          "one month": kpis.KpiParams(start=dt.date(1997, 3, 1), end=dt.date(1997, 3, 31), status=("F",))}


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("few", [1, 40, 2048])
def test_sets_merge_to_exact_counts(spark, monkeypatch, few):
    """Positions and bitmaps, several blocks of numbers, repeated members, NULL cells."""
    monkeypatch.setattr(D, "FEW", few)
    rng = random.Random(few)
    data = [(rng.choice(["a", "b", None]), rng.randrange(5), rng.choice([rng.randrange(1, 200), rng.randrange(1, 140_000)]))
            for _ in range(3000)] + [("hot", 1, 7)] * 2000
    df = spark.createDataFrame(data, f"x string, y long, {D.NUMBER} long").withColumn("n", F.lit(1))
    kept = D.sets_by_cell(df, ["x", "y"], {"n": F.col("n")})
    assert kept.where(F.col(D.BITS).isNull() == F.col(D.PLACES).isNull()).isEmpty()
    assert (kept.where(F.col(D.BITS).isNotNull()).count() > 0) == (few < 2048)
    for cond in ("true", "x = 'a'", "y in (1, 3) and x is null", "x = 'nothing'"):
        picked = [r for r, m in zip(data, [True] * len(data)) if m and _holds(cond, r)]
        got = D.merged_counts(kept.where(cond), [], ["n"], "d").first()
        assert (got["n"] or 0, got["d"]) == (len(picked), len({r[2] for r in picked}))
    by_x = {r["x"]: (r["n"], r["d"]) for r in D.merged_counts(kept, ["x"], ["n"], "d").collect()}
    assert by_x == {x: (sum(r[0] == x for r in data), len({r[2] for r in data if r[0] == x})) for x in {r[0] for r in data}}


def test_bitmaps_are_made_after_the_shuffle(spark):
    """A cell and block of few members travels as positions, never as a bitmap of 4 KB."""
    df = spark.range(2000).select(F.col("id").alias("x"), F.col("id").alias(D.NUMBER), F.lit(1).alias("n"))
    plan = D.sets_by_cell(df, ["x"], {"n": F.col("n")})._jdf.queryExecution().sparkPlan().toString()
    executed = D.sets_by_cell(df, ["x"], {"n": F.col("n")})._jdf.queryExecution().executedPlan().toString()
    assert "partial_bitmap_construct_agg" in plan
    made = executed[executed.index("bitmap_construct_agg"):executed.rindex("partial_bitmap_construct_agg")]
    assert "Exchange" not in made


def test_rows_are_shuffled_once_for_their_sets(spark):
    """No row is shuffled to its cell and member first: a task reduces its rows to positions by itself."""
    df = spark.range(2000).select((F.col("id") % 3).alias("x"), (F.col("id") % 2 + 1).alias(D.NUMBER), F.lit(1).alias("n"))
    kept = D.sets_by_cell(df, ["x"], {"n": F.col("n")})
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2  # the same one, read for positions and for bitmaps
    assert "partial_collect_set" in plan[plan.index("Exchange hashpartitioning"):]
    assert {(r["x"], r["n"], tuple(sorted(r[D.PLACES]))) for r in kept.collect()} == {
        (0, 667, (0, 1)), (1, 667, (0, 1)), (2, 666, (0, 1))}


def test_files_of_cells_hold_few_blocks(spark, tmp_path):
    """Laid out by block, the pairs of file and block number files plus blocks at most."""
    rows = spark.range(12 * 32_768).select((F.col("id") % 40).alias("x"), F.col("id").alias(D.NUMBER), F.lit(1).alias("n"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        D.by_block(D.sets_by_cell(rows, ["x"], {"n": F.col("n")}), ["x"]).write.parquet(str(tmp_path / "cells"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    back = spark.read.parquet(str(tmp_path / "cells")).select("_metadata.file_path", D.BLOCK)
    files, blocks = back.select("file_path").distinct().count(), back.select(D.BLOCK).distinct().count()
    assert files > 4 and blocks >= 12 and back.distinct().count() <= files + blocks


def _holds(cond, r):
    return {"true": True, "x = 'a'": r[0] == "a", "y in (1, 3) and x is null": r[1] in (1, 3) and r[0] is None}.get(cond, False)


@pytest.mark.parametrize("state", STATES)
def test_kpis_from_cells_equal_count_distinct(spark, star_small, state):
    p = STATES[state]
    assert rows(cells.kpi_merged(star_small, p)) == rows(kpis.kpi_summary(star_small, p))


def test_reports_from_cells(spark, star_small):
    assert rows(cells.state_merged(star_small)) == rows(reports.ticket_by_state(star_small))
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        scans = cells.kpi_merged(star_small, kpis.SELECTION)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "/fact" not in scans and "customer_cells" in scans  # sales are read when the cells are built, never again
    assert "PushedFilters" in scans


@pytest.mark.parametrize("state", STATES)
def test_dashboard_views_equal_the_single_jobs(spark, star_small, state):
    p = STATES[state]
    single = {"kpi_summary": kpis.kpi_summary, "churn_rate": kpis.churn_rate, "retention_rate": kpis.retention_rate,
              "resample_daily": lambda s, q: kpis.resample(s, q, "D"), "resample_weekly": lambda s, q: kpis.resample(s, q, "W"),
              "resample_monthly": lambda s, q: kpis.resample(s, q, "MS"), "dash_category_revenue": kpis.dash_category_revenue,
              "dash_top_products": kpis.dash_top_products, "dash_status_counts": kpis.dash_status_counts,
              "dash_state_ticket": kpis.dash_state_ticket, "kpi_formatted": kpis.kpi_formatted}
    views = dashboard.dashboard_views(star_small, p)
    assert set(views) == set(single)
    for name, view in views.items():
        want = single[name](star_small, p)
        assert view.columns == want.columns and rows(view) == rows(want), name


def test_dashboard_reads_the_sales_once(spark, star_small):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        plan = dashboard.grouped_sums(star_small, kpis.SELECTION)._jdf.queryExecution().executedPlan().toString()
        whole = dashboard.dashboard(star_small, kpis.SELECTION)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert plan.count("/fact]") == 1 and plan.count("Exchange hashpartitioning") == 1
    assert "partial_sum" in plan[plan.index("Exchange hashpartitioning"):]
    assert "/fact]" not in whole
