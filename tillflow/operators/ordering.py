"""Global ordering without a single-partition exchange.

A window with ORDER BY but no PARTITION BY makes Spark move every row into one
task. `global_row_index` gives each row its 0-based position in a total order
instead, fully distributed:

1. range-partition on the order and sort inside each partition;
2. stamp each row with its partition id and its position inside the
   partition (``monotonically_increasing_id`` keeps the partition id in the
   upper 31 bits and the in-partition position in the lower 33);
3. checkpoint to the shared checkpoint folder, so that the partition layout
   cannot change between the jobs below, even if executors are lost;
4. count rows per partition (one small row per partition reaches the driver),
   turn the counts into prefix offsets and broadcast them (size bounded by
   the partition count, not by the data).

`ntile_from_index` then reproduces SQL NTILE(n) from the position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PID = "_pid"
LOCAL = "_local"
ROW = "_row"
OFFSET = "_offset"


def default_partitions(df: DataFrame) -> int:
    """The session's shuffle partition count (default parallelism when it is not a number)."""
    value = df.sparkSession.conf.get("spark.sql.shuffle.partitions", None)
    try:
        return max(1, int(value))
    except (TypeError, ValueError):  # e.g. "auto" on some platforms
        return max(1, df.sparkSession.sparkContext.defaultParallelism)


def range_stamp(df: DataFrame, order: list[Column], num_partitions: int | None = None) -> DataFrame:
    """Range-partitioned, sorted, partition-stamped and checkpointed copy of df."""
    n = num_partitions or default_partitions(df)
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    pid = F.spark_partition_id().cast("long")
    stamped = ranged.withColumns({
        PID: pid,
        LOCAL: F.monotonically_increasing_id() - F.shiftleft(pid, 33),
    })
    return stamped.checkpoint(eager=True)


def partition_offsets(stamped: DataFrame, weight: Column | None = None,
                      by: list[str] | None = None) -> tuple[DataFrame, dict]:
    """Prefix offsets per (partition [, group]) and the grand totals per group.

    Returns a small DataFrame (PID [, by...], _offset) holding the number (or
    weight) of rows of the same group in earlier partitions, and a dict
    group-tuple -> total. One row per partition and group reaches the driver.
    """
    spark = stamped.sparkSession
    by = by or []
    measure = F.count(F.lit(1)) if weight is None else F.sum(weight)
    rows = stamped.groupBy(PID, *by).agg(measure.alias("_n")).collect()
    running: dict[tuple, int] = {}
    out = []
    for r in sorted(rows, key=lambda r: r[PID]):
        g = tuple(r[b] for b in by)
        out.append((r[PID], *g, running.get(g, 0)))
        running[g] = running.get(g, 0) + int(r["_n"] or 0)
    types = dict(stamped.dtypes)
    schema = ", ".join([f"{PID} long"] + [f"{b} {types[b]}" for b in by] + [f"{OFFSET} long"])
    return spark.createDataFrame(out, schema), running


def global_row_index(df: DataFrame, order: list[Column], num_partitions: int | None = None,
                     index_col: str = ROW) -> tuple[DataFrame, int]:
    """(df plus `index_col`, row count): 0-based position in `order`.

    End the order with a unique key when ties matter.
    """
    stamped = range_stamp(df, order, num_partitions)
    offsets, totals = partition_offsets(stamped)
    indexed = (stamped.join(F.broadcast(offsets), PID)
               .withColumn(index_col, F.col(OFFSET) + F.col(LOCAL))
               .drop(PID, LOCAL, OFFSET))
    return indexed, int(totals.get((), 0))


def ntile_from_index(index: Column, total: int, n: int) -> Column:
    """SQL NTILE(n) for the row at 0-based `index` of `total` rows.

    Buckets hold total // n rows and the first total % n buckets one more.
    """
    q, r = divmod(total, n)
    big = r * (q + 1)
    first = F.floor(index / F.lit(q + 1)) + 1
    rest = F.lit(r) + F.floor((index - F.lit(big)) / F.lit(max(q, 1))) + 1
    return F.when(index < F.lit(big), first).otherwise(rest).cast("int")
