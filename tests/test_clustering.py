"""Access paths: files clustered on several columns, their zone map, and reads that skip files."""

import datetime as dt
import random
import uuid

import pytest
from pyspark.sql import functions as F

from tillflow.operators import clustering as K
from tillflow.plans import reports, warehouse
from tillflow.session import scratch_path

COLUMNS = ["ID_Cliente", "ID_Produto", "Data_Venda"]


@pytest.fixture(scope="module")
def laid(spark):
    star = warehouse.star(spark, "/root/testdata/sf0.01")
    path = scratch_path(spark, f"clustered-{uuid.uuid4().hex[:8]}")
    K.write_clustered(star.fact, path, COLUMNS, ["ID_Transacao"], cells=64)
    return star, path


def lookup_of(star, column):
    values = star.fact.groupBy(column).count().orderBy(F.col("count").desc(), column).limit(5).collect()
    return [K.Lookup(column, (r[column],)) for r in values]


@pytest.mark.parametrize("column", COLUMNS)
def test_a_read_by_any_one_key_skips_half_of_the_files(spark, laid, column):
    star, path = laid
    total = spark.read.parquet(f"{path}/{K.ZONES}").count()
    assert total > 50
    for look in lookup_of(star, column):
        files = K.matching_files(spark, path, [look])
        assert 0 < len(files) <= total // 2, (column, len(files), total)
        got = K.read_clustered(spark, path, [look])
        assert {f.rsplit("/", 1)[-1] for f in got.inputFiles()} <= {f.rsplit("/", 1)[-1] for f in files}
        want = star.fact.where(look.rows())
        assert got.count() == want.count() > 0 and got.exceptAll(want).isEmpty()


def test_rows_are_unchanged(spark, laid):
    star, path = laid
    back = spark.read.parquet(path).drop(K.CELL)
    assert back.count() == star.fact.count() and back.exceptAll(star.fact).isEmpty()
    assert spark.read.parquet(f"{path}/{K.ZONES}").agg(F.sum("rows")).first()[0] == back.count()


def test_ranges_and_two_keys_together(spark, laid):
    star, path = laid
    total = spark.read.parquet(f"{path}/{K.ZONES}").count()
    days = K.Lookup("Data_Venda", least=dt.date(1997, 3, 1), most=dt.date(1997, 4, 30))
    customer = lookup_of(star, "ID_Cliente")[0]
    assert len(K.matching_files(spark, path, [days, customer])) <= total // 4 >= 16
    for looks in ([days], [K.Lookup("Data_Venda", least=dt.date(1998, 1, 1))], [days, customer], []):
        want = star.fact
        for x in looks:
            want = want.where(x.rows())
        got = K.read_clustered(spark, path, looks)
        assert got.count() == want.count() and got.exceptAll(want).isEmpty()
    assert K.read_clustered(spark, path, [K.Lookup("ID_Cliente", ("nobody",))]).count() == 0


def test_range_numbers_and_interleaved_bits(spark):
    rng = random.Random(4)
    rows = [(i, rng.randrange(100), rng.choice("abcdefgh") if i % 9 else None) for i in range(500)]
    df = spark.createDataFrame(rows, "i long, x long, s string")
    bounds = K.range_bounds(df, ["x", "s"], bits=3)
    got = df.select("i", K.range_number("x", bounds["x"]).alias("a"), K.range_number("s", bounds["s"]).alias("b")).collect()
    assert len(bounds["x"]) <= 7
    for r, (_, x, s) in zip(sorted(got), rows):
        assert r["a"] == sum(b <= x for b in bounds["x"])
        assert r["b"] == (0 if s is None else sum(b <= s for b in bounds["s"]))
    pairs = spark.createDataFrame([(a, b) for a in range(8) for b in range(8)], "a long, b long")
    for r in pairs.select("a", "b", K.interleave([F.col("a"), F.col("b")], 3).alias("z")).collect():
        want = "".join(x + y for x, y in zip(f"{r['a']:03b}", f"{r['b']:03b}"))
        assert r["z"] == int(want, 2)


def test_hot_key_empty_table_and_nulls(spark):
    rows = [("hot", f"p{i % 40}", i) for i in range(3000)] + [(f"c{i}", "p1", i) for i in range(1000)] + [(None, None, None)] * 20
    df = spark.createDataFrame(rows, "c string, p string, d long")
    path = scratch_path(spark, f"hot-{uuid.uuid4().hex[:8]}")
    K.write_clustered(df, path, ["c", "p", "d"], cells=16)
    zones = spark.read.parquet(f"{path}/{K.ZONES}")
    assert zones.agg(F.max("rows")).first()[0] < 1500  # the hot customer lies in many files
    for look, n in ((K.Lookup("c", ("hot",)), 3000), (K.Lookup("d", least=2990), 10), (K.Lookup("p", ("p1", "p2")), 1150)):
        assert K.read_clustered(spark, path, [look]).count() == n
    empty = scratch_path(spark, f"empty-{uuid.uuid4().hex[:8]}")
    K.write_clustered(df.limit(0), empty, ["c", "p", "d"])
    assert K.read_clustered(spark, empty, [K.Lookup("c", ("hot",))]).count() == 0


def test_access_path_is_written_once_per_star(spark, star_small):
    path = warehouse.access_path(star_small)
    first = spark.read.parquet(f"{path}/{K.ZONES}").collect()
    star_small.memo.pop("access_path")
    assert warehouse.access_path(star_small) == path
    assert spark.read.parquet(f"{path}/{K.ZONES}").collect() == first
    got = reports.sales_of_customer(star_small)
    assert got.count() == star_small.fact.where(F.col("ID_Cliente") == star_small.customers.agg(F.min("ID_Cliente")).first()[0]).count()


def test_zone_map_does_not_sort_the_rows(spark, tmp_path):
    """Text bounds are taken without sorting the rows of a task by file."""
    spark.range(1000).select(F.col("id").cast("string").alias("k")).repartition(4).write.parquet(str(tmp_path / "t"))
    zones = K.zone_map(spark.read.parquet(str(tmp_path / "t")), ["k"])
    plan = zones._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" in plan and "Sort" not in plan
    got = zones.agg(F.min("k_least"), F.max("k_most"), F.sum("rows"), F.min("bytes") > 0).first()
    assert tuple(got) == ("0", "999", 1000, True)
