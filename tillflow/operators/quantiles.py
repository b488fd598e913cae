"""Exact, linearly interpolated quantiles by radix selection.

Spark's `percentile` is exact but merges one hash map of every distinct value
into a single task, and `percentile_approx` returns other values. Sorting
everything to find a few ranks moves all rows. Here a quantile is two ranks,
floor and ceil of p * (n - 1), and ranks are found by narrowing:

1. one aggregate gives count, least and greatest value of every column;
2. the interval that holds a wanted rank is cut into equal ranges (the next
   digit of the value's place in it), and a partial aggregate counts the rows
   of each range, with its least and greatest value: one small row per range
   and task is shuffled, whatever the number of rows or the skew of values;
3. a running sum over those few counts tells which range holds the rank. Only
   rows of that range are counted in the next step. A range of one value is
   the answer; one of few rows is counted by value.

A range is described by the values in it, so the ends of an interval always
fall into different ranges. Evenly spread values are divided by the number of
ranges in every step. Where a step leaves more than a quarter of the rows
(values over many orders of magnitude), the next one cuts by the logarithm of
the distance from the least value. All columns share one scan a step; nothing is
sorted, sampled or checkpointed. The intervals are a broadcast table of a few
rows, so every step runs the same compiled plan.

NULL and NaN are left out. Decimals are compared and interpolated exactly.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field
from decimal import ROUND_HALF_UP, Decimal, localcontext
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COL = "coluna"
#: Ranges an interval is cut into by one step.
RANGES = 4096
#: Rows of an interval that are counted by value instead of by range.
FEW_ROWS = 10_000
_BIG = math.ldexp(1.0, 1022)
_BINADES = 1100.0


@dataclass
class Interval:
    """Values least .. most of a column: `before` rows lie below them, `rows` in them, and
    the wanted ranks (among all rows of the column) between."""
    least: object
    most: object
    before: int
    rows: int
    ranks: list[int] = field(default_factory=list)
    by_log: bool = False


@dataclass
class Numbers:
    """How the columns are compared: as whole units of each column's last decimal where those fit a long
    (cheap and exact), else in value_type. The plan of a step depends on nothing else, so it is compiled once."""
    kind: str
    long: DataFrame            # (coluna, v), NULL and NaN left out
    scales: dict[str, int]     # of columns in units

    def value(self, column: str, v):
        """A compared number as a value of the column."""
        return Decimal(v).scaleb(-self.scales[column]) if self.kind == "bigint" else v


def _numbers(df: DataFrame, columns: list[str], value_type: str) -> Numbers:
    types, scales = dict(df.dtypes), {}
    for c in columns:
        found = re.fullmatch(r"decimal\((\d+),(\d+)\)", types[c])
        if found and int(found[1]) <= 18:
            scales[c] = int(found[2])
        elif types[c] in ("tinyint", "smallint", "int"):
            scales[c] = 0
    if value_type != "double" and len(scales) == len(columns):
        kind = "bigint"
        picked = [(F.col(c) * F.lit(10 ** scales[c]) if scales[c] else F.col(c)).cast(kind) for c in columns]
    else:
        kind = value_type
        picked = [F.col(c).cast(kind) for c in columns]
    names = [f"c{i}" for i in range(len(columns))]
    one = df.select(*[p.alias(n) for p, n in zip(picked, names)])
    if kind == "double":
        one = one.select(*[F.when(~F.isnan(n), F.col(n)).alias(n) for n in names])
    long = one.toDF(*columns).unpivot([], list(columns), COL, "v").where(F.col("v").isNotNull())
    return Numbers(kind, long, scales)


def _bounds(kind: str, x: Interval) -> tuple[float, float]:
    """(half of the least value, the divisor of distances); halves of doubles cannot overflow."""
    if kind == "double":
        lo, hi = (min(max(e, -_BIG), _BIG) / 2 for e in (x.least, x.most))
        return lo, hi - lo
    return 0.0, float(x.most - x.least)


def _by_value(kind: str, x: Interval) -> bool:
    return x.rows <= FEW_ROWS or not _bounds(kind, x)[1] > 0  # few rows, or no room for ranges


def _small(spark, schema: pa.Schema, rows: list[tuple]) -> DataFrame:
    """A broadcast table of a few rows (one per interval or wanted rank)."""
    arrays = [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)]
    return F.broadcast(spark.createDataFrame(pa.Table.from_arrays(arrays, schema=schema)))


def _counts(numbers: Numbers, open_: dict[str, list[Interval]], ranges: int) -> DataFrame:
    """(coluna, place, least, most, rows): the ranges, or values, of each open interval of each column."""
    kind = numbers.kind
    arrow = {"bigint": pa.int64(), "double": pa.float64()}.get(kind) or \
        pa.decimal128(*map(int, re.findall(r"\d+", kind)))
    schema = pa.schema([(COL, pa.string()), ("place", pa.int32()), ("first", arrow), ("last", arrow), ("half", pa.float64()),
                        ("width", pa.float64()), ("whole", pa.bool_()), ("by_log", pa.bool_())])
    intervals = _small(numbers.long.sparkSession, schema, [
        (c, i, x.least, x.most, *_bounds(kind, x), not _by_value(kind, x), x.by_log)
        for c, xs in open_.items() for i, x in enumerate(xs)])
    v = F.col("v")
    inside = numbers.long.join(intervals, COL).where(v.between(F.col("first"), F.col("last")))
    away = (F.greatest(F.least(v, F.lit(_BIG)), F.lit(-_BIG)) / F.lit(2.0) - F.col("half") if kind == "double"
            else (v - F.col("first")).cast("double"))
    share = F.try_divide(away, F.col("width"))
    log = F.greatest(F.lit(0.0), F.lit(1.0) + F.coalesce(F.log2(share), F.lit(-_BINADES)) / F.lit(_BINADES))
    # the number of the range never falls as the value rises; the ends lie in different ranges
    cut = F.least(F.floor(F.when(F.col("by_log"), log).otherwise(share) * F.lit(float(ranges))), F.lit(ranges - 1))
    return inside.groupBy(COL, "place", F.when(F.col("whole"), cut).alias("cut"),
                          F.when(~F.col("whole"), v).alias("value")).agg(
        F.min("v").alias("least"), F.max("v").alias("most"), F.count(F.lit(1)).alias("rows")) \
        .select(COL, "place", "least", "most", "rows")


def _narrowed(numbers: Numbers, open_: dict[str, list[Interval]], ranges: int) -> dict[str, list[Interval]]:
    """One step for all open intervals of all columns: the ranges (or values) that hold their ranks.

    The driver takes `ranges` or FEW_ROWS rows an interval at most, however many rows there are.
    """
    counted = _counts(numbers, open_, ranges).toArrow().sort_by([(COL, "ascending"), ("place", "ascending"), ("least", "ascending")])
    names, places, rows = (counted.column(c).to_pylist() for c in (COL, "place", "rows"))
    ends = np.cumsum(rows)
    first: dict[tuple, int] = {}
    for i, key in enumerate(zip(names, places)):
        first.setdefault(key, i)
    out: dict[str, list[Interval]] = {c: [] for c in open_}
    for (c, place), i in first.items():
        was, skipped = open_[c][place], int(ends[i] - rows[i])
        held: dict[int, list[int]] = {}
        for k in was.ranks:
            held.setdefault(int(np.searchsorted(ends, k - was.before + skipped, side="right")), []).append(k)
        for at, ranks in held.items():
            out[c].append(Interval(counted.column("least")[at].as_py(), counted.column("most")[at].as_py(),
                                   was.before + int(ends[at] - rows[at]) - skipped, rows[at], ranks,
                                   was.by_log ^ (rows[at] * 4 > was.rows)))
    return out


def select_ranks(df: DataFrame, ranks_of, columns: list[str], value_type: str = "double",
                 ranges: int = RANGES) -> tuple[dict[str, int], dict[str, dict[int, object]]]:
    """(number of values by column, {column: {rank: value}}) of the 0-based ranks that ranks_of(number) asks for."""
    numbers = _numbers(df, columns, value_type)
    rows, found, open_ = dict.fromkeys(columns, 0), {c: {} for c in columns}, {}
    for r in numbers.long.groupBy(COL).agg(F.count("v").alias("rows"), F.min("v").alias("least"),
                                           F.max("v").alias("most")).collect():  # one row per column
        rows[r[COL]] = r["rows"]
        open_[r[COL]] = [Interval(r["least"], r["most"], 0, r["rows"], sorted(set(ranks_of(r["rows"]))))]
    while open_:
        for c, xs in open_.items():
            found[c].update((k, numbers.value(c, x.least)) for x in xs for k in x.ranks if x.least == x.most)
        open_ = {c: left for c, xs in open_.items() if (left := [x for x in xs if x.least != x.most])}
        if open_:
            open_ = _narrowed(numbers, open_, max(2, ranges))
    return rows, found


def _interpolated(lo, hi, share: Fraction, value_type: str):
    if value_type == "double":
        return lo if not share else lo + (hi - lo) * float(share)
    with localcontext() as exact:
        exact.prec = 76
        value = lo + (hi - lo) * Decimal(share.numerator) / Decimal(share.denominator)
        return value.quantize(Decimal("1e-12"), ROUND_HALF_UP)


def quantile_values(df: DataFrame, columns: list[str], probs: list[float], value_type: str = "double",
                    ranges: int = RANGES) -> dict[tuple[str, float], object]:
    """{(column, prob): interpolated quantile}, NULL (None) for a column without values."""
    def ranks_of(n: int) -> list[int]:
        places = [Fraction(str(p)) * (n - 1) for p in probs]
        return [k for x in places for k in (math.floor(x), math.ceil(x))]

    rows, found = select_ranks(df, ranks_of, columns, value_type, ranges)
    out = {}
    for c, n in rows.items():
        for p in probs:
            place = Fraction(str(p)) * (n - 1)
            lo, hi = math.floor(place), math.ceil(place)
            out[c, p] = _interpolated(found[c][lo], found[c][hi], place - lo, value_type) if n else None
    return out


def exact_quantiles(df: DataFrame, columns: list[str], probs: list[float], value_type: str = "double",
                    num_partitions: int | None = None) -> DataFrame:
    """One row per (coluna, prob): the interpolated quantile `valor` (NULL if no values).

    num_partitions: ranges an interval is cut into by one step.
    """
    values = quantile_values(df, columns, probs, value_type, num_partitions or RANGES)
    kind = "double" if value_type == "double" else "decimal(38,12)"
    return df.sparkSession.createDataFrame([(c, float(p), v) for (c, p), v in values.items()],
                                           f"{COL} string, prob double, valor {kind}")
