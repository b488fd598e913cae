"""Batches against the one-shot jobs, releases that change over at once, and the audit of the writes."""

import datetime as dt
import os
import random
import subprocess
import sys
import uuid

import pytest
from pyspark.sql import functions as F

from helpers import raw_df, sale
from tillflow.operators import cleaning as C
from tillflow.operators.ledger import BATCH, KEY, KeyLedger
from tillflow.operators.lifecycle import lifecycle_of, lifecycle_state, merge_states
from tillflow.plans import etl_steps, kpis, runner, warehouse
from tillflow.session import scratch_path
from tillflow.sources import release as V
from tillflow.sources.sinks import write_table
from tillflow.sources.tables import ORDINAL, RAW_COLUMNS


def fresh(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:10]}")


# ---------------------------------------------------------------- key ledger

@pytest.mark.parametrize("cuts", [[], [1], [3, 3, 40], [10, 20, 30, 40, 50]])
def test_any_split_into_batches_gives_the_one_shot_rows(spark, cuts):
    rng = random.Random(len(cuts))
    rows = [sale(None if rng.random() < 0.1 else f"T{rng.randrange(25)}", price=f"{i}.00") for i in range(60)]
    raw = raw_df(spark, rows).cache()
    name = f"ledger_{uuid.uuid4().hex[:10]}"
    ledger = KeyLedger(spark, name, fresh(spark, "ledger"), buckets=4)
    edges = [0, *cuts, len(rows)]
    for i, (a, b) in enumerate(zip(edges, edges[1:])):
        ledger.land(raw.where((F.col(f"{ORDINAL}.pos") >= a) & (F.col(f"{ORDINAL}.pos") < b)), i)
    got = sorted(tuple(r) for r in ledger.rows().select(*RAW_COLUMNS).na.fill("-").collect())
    want = sorted(tuple(r) for r in raw.transform(C.dedupe_keep_first).select(*RAW_COLUMNS).na.fill("-").collect())
    assert got == want
    spark.sql(f"DROP TABLE {name}")


def test_a_batch_run_again_replaces_its_rows(spark):
    name = f"ledger_{uuid.uuid4().hex[:10]}"
    ledger = KeyLedger(spark, name, fresh(spark, "ledger"), buckets=4)
    first, second = raw_df(spark, [sale("A"), sale("B")]), raw_df(spark, [sale("B", price="9.00"), sale("C")])
    ledger.land(first, 0)
    ledger.land(second, 1)
    ledger.land(second, 1)   # the same batch once more, its keys already entered
    assert sorted(r["ID_Transacao"] for r in ledger.rows().collect()) == ["A", "B", "C"]
    assert ledger.rows().where("ID_Transacao = 'B'").first()["Valor_Unitario"] == "100.00"
    plan = ledger.unseen(second, 2)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    # only the batch is dealt into buckets: the one exchange on the ledger's key is not above the ledger's scan
    assert plan.count(f"Exchange hashpartitioning({KEY}") == 1
    ledger_side = plan[plan.rindex("+- Sort ["):]
    assert "Exchange" not in ledger_side and BATCH in ledger_side and "Bucketed: true" in ledger_side
    spark.sql(f"DROP TABLE {name}")


# ----------------------------------------------------------------- lifecycle

@pytest.mark.parametrize("seed", range(3))
def test_state_after_any_batches_equals_the_whole(spark, seed):
    rng = random.Random(seed)
    day = dt.date(2025, 1, 1)
    sales = [(f"C{rng.randrange(12)}", day + dt.timedelta(rng.randrange(400)), rng.randrange(4)) for _ in range(150)]
    df = spark.createDataFrame(sales, "ID_Cliente string, Data_Venda date, lote long")
    cut = dt.date(2025, 7, 1)
    state = lifecycle_state(df.limit(0), cut)
    for i in (0, 1, 2, 3, 3):   # a repeated batch changes nothing
        state = write_table(merge_states(state, lifecycle_state(df.where(F.col("lote") == i), cut)), fresh(spark, "state"))
    got = sorted(map(tuple, lifecycle_of(state).collect()))
    assert got == sorted(map(tuple, lifecycle_of(lifecycle_state(df, cut)).collect()))
    last = max(d for _, d, _ in sales)
    assert got == sorted((c, max(d for x, d, _ in sales if x == c), (last - max(d for x, d, _ in sales if x == c)).days,
                          any(d < cut for x, d, _ in sales if x == c), any(d >= cut for x, d, _ in sales if x == c))
                         for c in {x for x, _, _ in sales})


def test_lifecycle_of_no_sales(spark, star_small):
    empty = lifecycle_of(lifecycle_state(star_small.fact.limit(0), kpis.DEFAULT.cut))
    assert empty.count() == 0


# ------------------------------------------------------------------- release

def test_readers_stay_on_the_old_release_until_all_tables_are_written(spark, tmp_path, monkeypatch):
    def csv(name, n):
        path = tmp_path / name
        head = ",".join(RAW_COLUMNS)
        path.write_text("\n".join([head, *[f"T{i},2025-01-{i % 28 + 1:02d},CLI{i % 3},Bola,Casa,10.00,1.0,Recife/PE/Brasil,"
                                           "Pix,Concluido" for i in range(n)]]) + "\n")
        return str(path)

    out = str(tmp_path / "out")
    root = f"{out}/tables"
    with pytest.raises(FileNotFoundError):
        V.read_released(spark, root, "sales")
    runner.run_raw(spark, csv("one.csv", 5), out, ["status_distribution"])
    before = V.current(spark, root)
    assert before["tables"] == {"customers": 3, "products": 1, "sales": 5}

    real = runner.write_table

    def broken(df, path, *a, **k):
        if path.endswith("/sales"):
            raise OSError("lost between tables")
        return real(df, path, *a, **k)
    monkeypatch.setattr(runner, "write_table", broken)
    with pytest.raises(OSError):
        runner.run_raw(spark, csv("two.csv", 9), out, ["status_distribution"])
    assert V.current(spark, root) == before
    assert V.read_released(spark, root, "sales").count() == 5 and V.read_released(spark, root, "customers").count() == 3

    monkeypatch.setattr(runner, "write_table", real)
    runner.run_raw(spark, csv("two.csv", 9), out, ["status_distribution"])
    assert V.read_released(spark, root, "sales").count() == 9
    assert V.prune(spark, root, keep=0) == []  # young folders may still be written
    assert len(V.prune(spark, root, keep=0, older_than_hours=-1)) == 2
    assert V.read_released(spark, root, "sales").count() == 9
    assert [p.name for p in (tmp_path / "out" / "tables").iterdir() if p.name.startswith("CURRENT.")] == []


# --------------------------------------------------------------------- audit

def test_audit_is_counted_by_the_writes(spark, star_small):
    df = etl_steps.etl_audit(spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Scan parquet" not in plan and "Exchange" not in plan
    got = df.first().asDict()
    raw = warehouse.raw(spark, "/root/testdata/sf0.001")
    assert got == {"linhas_brutas": raw.count(), "linhas_limpas": star_small.clean.count(),
                   "clientes": star_small.customers.count(), "produtos": star_small.products.count(),
                   "vendas": star_small.fact.count(),
                   "precos_invalidos": star_small.clean.where("Valor_Unitario IS NULL").count()}


RETRY = """
import os, sys
sys.path.insert(0, sys.argv[1])
from pyspark import TaskContext
from pyspark.sql import functions as F
from tillflow.session import build_session
from tillflow.sources.sinks import write_table
folder = sys.argv[2]
spark = build_session(master="local[4,3]", shuffle_partitions=4)

def flaky(batches):
    mark = f"{folder}/{TaskContext.get().partitionId()}"
    yield from batches
    if not os.path.exists(mark):
        open(mark, "w").close()
        raise RuntimeError("lost")

audit = {}
df = spark.range(1000).repartition(4).mapInArrow(flaky, "id long")
write_table(df, folder + "/t", metrics={"rows": F.count(F.lit(1))}, audit=audit)
print("COUNTED", audit["rows"], spark.read.parquet(folder + "/t").count(), sum(x.isdigit() for x in os.listdir(folder)))
"""


def test_metrics_count_once_when_tasks_are_run_again(tmp_path):
    """Every task of the writing stage fails once and is run again; the metric still counts each row once.
    (A process of its own: this suite's local master runs a failed task no second time.)"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    run = subprocess.run([sys.executable, "-c", RETRY, root, str(tmp_path)], capture_output=True, text=True, timeout=300)
    assert "COUNTED 1000 1000 4" in run.stdout, run.stderr[-2000:]


def test_metrics_of_an_empty_table(spark, tmp_path):
    audit = {}
    write_table(spark.range(0), str(tmp_path / "e"), metrics={"rows": F.count(F.lit(1))}, audit=audit)
    write_table(spark.createDataFrame([], "a long, d date"), str(tmp_path / "f"), date_col="d",
                metrics={"rows2": F.count(F.lit(1)), "none": F.count_if(F.col("a").isNull())}, audit=audit)
    assert audit == {"rows": 0, "rows2": 0, "none": 0}
