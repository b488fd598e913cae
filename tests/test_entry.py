"""The driver contract on sf0.001: entry runs, every query runs, oracle SQL agrees."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from oracle_check import canon  # noqa: E402
from tillflow.plans import catalog  # noqa: E402
from tillflow.sources.tables import DRIVER_TABLES  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns == ["mes", "faturamento", "variacao_absoluta",
                                             "variacao_pct", "media_movel_3m"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_sales_query_is_registered_with_an_oracle():
    names = set(catalog.queries())
    assert names <= set(entry.queries()) and names == set(catalog.oracle_sql())


# the training-data queries have tests of their own
@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert len(rows) > 0
        return
    rel = duck.sql(sql)
    assert canon(df.columns, rows) == canon(rel.columns, rel.fetchall())
