"""Radix selection: every step of it, against sorting."""

import random
from decimal import Decimal, localcontext

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillflow.operators import quantiles as Q

BIG = 1.7976931348623157e308


def values(kind, rng, n):
    if kind == "hot":
        return [rng.choice([5.0, 5.0, 5.0, 7.5, rng.uniform(0, 10)]) for _ in range(n)]
    if kind == "spread":
        return [rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300) for _ in range(n)]
    if kind == "huge":
        return [rng.choice([-BIG, BIG, 0.0, -0.0, 1e308, -1e308, 5e-324, float("inf"), float("-inf")]) for _ in range(n)]
    if kind == "near":
        return [1.0 + rng.randrange(4) * 2.220446049250313e-16 for _ in range(n)]
    return [float(rng.randrange(-1000, 1000)) for _ in range(n)]


KINDS = ["hot", "spread", "huge", "near", "whole"]


@pytest.mark.parametrize("few,ranges,n", [(0, 64, 40), (10 ** 5, 2048, 150)])
def test_ranks_equal_sorting(spark, monkeypatch, few, ranges, n):
    """Columns of all kinds in one run; NULL and NaN are left out."""
    monkeypatch.setattr(Q, "FEW_ROWS", few)
    rng = random.Random(few)
    vals = {k: values(k, rng, n) for k in KINDS}
    rows = [*zip(*vals.values()), (None,) * len(KINDS), (float("nan"),) * len(KINDS)]
    df = spark.createDataFrame(rows, ", ".join(f"{k} double" for k in KINDS))
    ranks = sorted({0, n - 1, n // 2, n // 4})
    count, found = Q.select_ranks(df, lambda _: ranks, KINDS, "double", ranges)
    assert count == {k: n for k in KINDS}
    assert found == {c: {k: sorted(v)[k] for k in ranks} for c, v in vals.items()}


@pytest.mark.parametrize("few,ranges", [(0, 8), (25, 8)])
def test_decimals_of_38_digits_and_integers_together(spark, monkeypatch, few, ranges):
    """Decimals that differ behind the precision of a double, integers, and an empty column, in one run."""
    monkeypatch.setattr(Q, "FEW_ROWS", few)
    rng = random.Random(few)
    with localcontext() as exact:
        exact.prec = 60
        rows = [(Decimal(10 ** 30 + rng.randrange(50)).scaleb(-6), rng.randrange(-5, 60),
                 Decimal(rng.randrange(10 ** 6)).scaleb(-2)) for _ in range(100)]
        df = spark.createDataFrame(rows, "a decimal(38,6), b int, c decimal(18,2)").withColumn("e", F.lit(None).cast("double"))
        got = Q.quantile_values(df, ["a", "b", "c", "e"], [0.25, 0.5, 0.9], "decimal(38,6)", ranges)
        for i, c in enumerate("abc"):
            ordered = sorted(Decimal(r[i]) for r in rows)
            for p in (0.25, 0.5, 0.9):
                place = Decimal(str(p)) * (len(ordered) - 1)
                lo = int(place)
                want = ordered[lo] + (ordered[min(lo + 1, len(ordered) - 1)] - ordered[lo]) * (place - lo)
                assert got[c, p] == want.quantize(Decimal("1e-12"))
    assert got["e", 0.5] is None


def test_steps_narrow_quickly_and_read_only_the_range(spark, monkeypatch):
    """Evenly spread values: each step divides what is left by the number of ranges; later steps push the
    range to the scan."""
    seen = []
    step = Q._narrowed

    def spy(numbers, open_, ranges):
        seen.append(max(x.rows for xs in open_.values() for x in xs))
        return step(numbers, open_, ranges)
    monkeypatch.setattr(Q, "_narrowed", spy)
    monkeypatch.setattr(Q, "FEW_ROWS", 50)
    df = spark.range(200_000).select((F.col("id") * 7919 % 200_003).cast("double").alias("x"))
    got = Q.quantile_values(df, ["x"], [0.5], "double", ranges=64)
    vals = np.sort((np.arange(200_000) * 7919) % 200_003).astype(float)
    assert got["x", 0.5] == np.percentile(vals, 50)
    assert len(seen) <= 4 and all(b <= a / 30 for a, b in zip(seen, seen[1:]))


def test_selection_sorts_and_checkpoints_nothing(spark, star_small):
    """The plan of a step: one scan of the columns, partial and final aggregate, no sort of rows."""
    open_ = {"Faturamento": [Q.Interval(0, 999900, 0, 10 ** 9, [5])], "Quantidade": [Q.Interval(1, 50, 0, 10 ** 9, [7])]}
    numbers = Q._numbers(star_small.fact, ["Faturamento", "Quantidade"], "decimal(38,6)")
    plan = Q._counts(numbers, open_, 2048)._jdf.queryExecution().executedPlan().toString()
    assert numbers.kind == "bigint" and numbers.scales == {"Faturamento": 2, "Quantidade": 0}
    assert "Sort" not in plan and "rangepartitioning" not in plan and plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Scan parquet") == 1 and "ReadSchema: struct<Quantidade:int,Faturamento:decimal(18,2)>" in plan
