"""Text columns carried through shuffles as numbers: the same rows, with and without a dictionary."""

import uuid

import pytest
from pyspark.sql import functions as F

from helpers import raw_df, sale
from tillflow.operators import cleaning as C
from tillflow.operators import dictionary as D
from tillflow.operators import distinct
from tillflow.plans import cells, kpis, reports, warehouse
from tillflow.session import scratch_path

SF = "/root/testdata/sf0.001"


def test_combinations_come_back_with_nulls(spark):
    rows = [(i, ["a", "A ", None, ""][i % 4], [None, "x", "é"][i % 3]) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, p string, q string")
    words, = D.dictionaries(df, ("p", "q"))
    coded = words.encoded(df)
    assert coded.columns == ["id", words.code]
    assert sorted(r[0] for r in words.values().select(words.code).collect()) == list(range(12))
    back = words.decoded(coded).select("id", "p", "q")
    assert back.exceptAll(df).isEmpty() and back.count() == 60
    upper = words.decoded(coded, words.values().withColumn("p", F.upper("p")))
    assert {(r["id"], r["p"]) for r in upper.collect()} == {(i, p if p is None else p.upper()) for i, p, _ in rows}


def test_too_many_combinations_give_no_dictionary(spark, monkeypatch):
    df = spark.range(2000).select(F.col("id").cast("string").alias("a"), (F.col("id") % 3).cast("string").alias("b"))
    monkeypatch.setattr(D, "DICTIONARY_BYTES", 2000)
    many, few = D.dictionaries(df, ("a",), ("b",))
    assert many is None and few.values().count() == 3


def test_no_rows(spark):
    df = spark.createDataFrame([], "a string, b string")
    words, = D.dictionaries(df, ("a", "b"))
    assert words.decoded(words.encoded(df)).count() == 0


RAW = [sale("A", loc="recife/pe/brasil", method="  pix ", cat="casa", prod=" Kit "), sale("A", loc="X", method=None),
       sale("B", loc=None, method=None, cat=None, prod=None), sale("C", loc="OLINDA - pe", cat="CASA", date="x"),
       sale("D", cust=None), sale(None), sale("E", qty=None, price="R$ 1.000,05")]


@pytest.mark.parametrize("limit", [0, 200, D.DICTIONARY_BYTES])  # none, some and all columns as numbers
def test_parsed_rows_are_the_same(spark, monkeypatch, limit):
    monkeypatch.setattr(D, "DICTIONARY_BYTES", limit)
    for raw in (raw_df(spark, RAW), warehouse.raw(spark, SF)):
        plain, coded = C.parse_stage(raw), C.parse_stage(raw, stored=True)
        assert set(plain.columns) == set(coded.columns)
        coded = coded.select(*plain.columns)
        assert coded.exceptAll(plain).isEmpty() and plain.exceptAll(coded).isEmpty()


def test_texts_are_not_shuffled_for_the_keep_first(spark):
    plan = C.parse_stage(warehouse.raw(spark, SF), stored=True)._jdf.queryExecution().executedPlan().toString()
    moved = plan[plan.index("Exchange hashpartitioning"):].split("\n")[1]  # what goes into the exchange
    window = plan[plan.index("WindowGroupLimit"):]
    assert "BroadcastHashJoin" in plan[:plan.index("Exchange hashpartitioning")]  # the texts come back behind it
    assert "Localidade_Venda" not in moved and window.count("BroadcastHashJoin") >= 2


@pytest.mark.parametrize("limit", [0, D.DICTIONARY_BYTES])
def test_star_and_cells_are_the_same(spark, star_small, monkeypatch, limit):
    monkeypatch.setattr(D, "DICTIONARY_BYTES", limit)
    star = warehouse.build_star(spark, warehouse.raw(spark, SF), scratch_path(spark, f"words-{uuid.uuid4().hex}"), stored=True)
    assert star.fact.columns == star_small.fact.columns and star.fact.count() == star_small.fact.count()
    assert star.fact.exceptAll(star_small.fact).isEmpty()
    assert star.audit == {k: v for k, v in star_small.audit.items() if k != "linhas_brutas"}
    for p in (kpis.DEFAULT, kpis.SELECTION, kpis.NOTHING):
        assert cells.kpi_merged(star, p).collect() == kpis.kpi_summary(star, p).collect()
    assert cells.state_merged(star).collect() == reports.ticket_by_state(star).collect()
    kept = cells.customer_cells(star)
    assert set(kept.columns) == {*cells.CELL, *cells.SUMS, distinct.BLOCK, distinct.BITS, distinct.PLACES}
    assert kept.groupBy(*cells.CELL, distinct.BLOCK).count().where("count > 1").isEmpty()
