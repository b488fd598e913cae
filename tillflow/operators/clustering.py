"""Multi-dimensional clustering of a table's files: an access path on several columns at once.

Rows are laid out along a curve through all key columns: each column is cut
into 2^bits ranges of about equal size, and the bits of a row's range numbers
are interleaved into one clustering key. The key's leading bits name a cell,
and every file lies in one cell, so a file covers a narrow range of *every*
column and a read by any one of them skips most files. (Files sorted by one
column are skipped by that column only; files cut anywhere along the curve
would straddle its jumps.)

The range bounds come from a sample of bounded size. They decide where a row
is stored, never whether it is found: the zone map holds the true smallest and
largest value of every column in every file.

`write_clustered` writes the files and their zone map, `read_clustered` opens
only files whose zones can hold a match. A key with very many rows is cut by
the other columns and by the tie-break columns, so no file takes it whole.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Ranges per column are 2^BITS; three columns of 6 bits tell 262,144 cells apart.
BITS = 6
#: Rows of a cell where the number of cells is not given (some tens of MB of sales).
ROWS_PER_CELL = 1_000_000
#: Rows of the sample that the range bounds are read off (all key columns of one row travel together).
SAMPLE_ROWS = 20_000
#: Folder of the zone map under the table; the underscore hides it from readers of the table.
ZONES = "_zones"
#: Folder with the schema of the table, which may have no files.
SCHEMA = "_schema"
_KEY = "_cluster_key"
CELL = "celula"


def range_bounds(df: DataFrame, columns: list[str], bits: int = BITS, sample_rows: int = SAMPLE_ROWS) -> dict[str, list]:
    """Upper bounds (exclusive) of all ranges but the last, per column, from about sample_rows rows."""
    rows = df.count()
    keys = df.select(*columns)
    sample = (keys.sample(min(1.0, sample_rows / rows), seed=7) if rows > sample_rows else keys).collect()
    out = {}
    for c in columns:
        values = sorted(r[c] for r in sample if r[c] is not None)
        cuts = {values[len(values) * i // 2 ** bits] for i in range(1, 2 ** bits)} if values else set()
        out[c] = sorted(cuts)
    return out


def range_number(column: str, bounds: list, first: int = 0) -> Column:
    """Number of bounds at or below the value (0 for NULL), by halving: log2 comparisons a row."""
    if not bounds:
        return F.lit(first)
    mid = len(bounds) // 2
    return F.when(F.col(column) >= F.lit(bounds[mid]), range_number(column, bounds[mid + 1:], first + mid + 1)) \
        .otherwise(range_number(column, bounds[:mid], first))


def interleave(numbers: list[Column], bits: int = BITS) -> Column:
    """The bits of all numbers in turn, the highest bits first."""
    terms = []
    for b in range(bits):
        for place, n in enumerate(numbers):
            bit = F.shiftright(n.cast("long"), b).bitwiseAND(F.lit(1).cast("long"))
            terms.append(F.shiftleft(bit, b * len(numbers) + len(numbers) - 1 - place))
    return reduce(lambda a, b: a.bitwiseOR(b), terms)


def cluster_key(bounds: dict[str, list], bits: int = BITS) -> Column:
    """The clustering key of a row. A column with few distinct values has fewer ranges; its numbers are
    spread over all 2^bits, so that it takes part in the first cuts too."""
    numbers = [F.floor(range_number(c, b) * F.lit(2 ** bits) / F.lit(len(b) + 1)) for c, b in bounds.items()]
    return interleave(numbers, bits)


def clustered(df: DataFrame, columns: list[str], ties: list[str] = (), cells: int | None = None,
              bits: int = BITS) -> DataFrame:
    """df with its cell, range-partitioned by cell and sorted along the curve through `columns`.

    A cell with very many rows is split between partitions by the tie-break columns.
    """
    if cells is None:
        cells = -(-df.count() // ROWS_PER_CELL)
    depth = min(bits * len(columns), max(0, cells - 1).bit_length())
    keyed = df.withColumn(_KEY, cluster_key(range_bounds(df, columns, bits), bits)) \
        .withColumn(CELL, F.shiftright(_KEY, bits * len(columns) - depth))
    return keyed.repartitionByRange(2 ** depth, CELL, *ties).sortWithinPartitions(CELL, _KEY, *ties).drop(_KEY)


def zone_map(table: DataFrame, columns: list[str]) -> DataFrame:
    """One row per file: file, rows, bytes and for each column the least and largest value and the number of NULLs.

    The bounds may be text, which Spark's hash aggregate cannot update in place: it would sort all rows of a
    task by file. A collected set (of the file's one size) makes it keep the few groups of a task as objects.
    """
    zones = [x for c in columns for x in (F.min(c).alias(f"{c}_least"), F.max(c).alias(f"{c}_most"),
                                          F.count_if(F.col(c).isNull()).alias(f"{c}_nulls"))]
    return table.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("rows"), F.array_max(F.collect_set("_metadata.file_size")).alias("bytes"), *zones)


def write_clustered(df: DataFrame, path: str, columns: list[str], ties: list[str] = (), cells: int | None = None,
                    bits: int = BITS) -> DataFrame:
    """Replace the table at path by df, clustered on `columns`, with its zone map (written last)."""
    spark = df.sparkSession
    clustered(df, columns, list(ties), cells, bits).write.mode("overwrite").partitionBy(CELL).parquet(path)
    df.limit(0).write.mode("overwrite").parquet(f"{path}/{SCHEMA}")
    table = spark.read.schema(df.schema).parquet(path)
    zone_map(table, columns).coalesce(1).write.mode("overwrite").parquet(f"{path}/{ZONES}")
    return table


@dataclass(frozen=True)
class Lookup:
    """A condition on one key column: the listed values, or an inclusive range."""
    column: str
    values: tuple = ()
    least: str | int | dt.date | None = None
    most: str | int | dt.date | None = None

    def rows(self) -> Column:
        c = F.col(self.column)
        if self.values:
            return c.isin(*self.values)
        return reduce(lambda a, b: a & b, [x for x in (
            c >= F.lit(self.least) if self.least is not None else None,
            c <= F.lit(self.most) if self.most is not None else None) if x is not None], c.isNotNull())

    def zones(self) -> Column:
        """Whether a file can hold a match."""
        least, most = F.col(f"{self.column}_least"), F.col(f"{self.column}_most")
        if self.values:
            return reduce(lambda a, b: a | b, [(least <= F.lit(v)) & (most >= F.lit(v)) for v in self.values])
        return reduce(lambda a, b: a & b, [x for x in (
            most >= F.lit(self.least) if self.least is not None else None,
            least <= F.lit(self.most) if self.most is not None else None) if x is not None], least.isNotNull())


def matching_files(spark: SparkSession, path: str, lookups: list[Lookup]) -> list[str]:
    """Files whose zones can hold rows that meet all lookups (their names reach the driver, as for any scan)."""
    zones = spark.read.parquet(f"{path}/{ZONES}")
    wanted = reduce(lambda a, b: a & b, [x.zones() for x in lookups], F.lit(True))
    return [r["file"] for r in zones.where(wanted).select("file").collect()]


def read_clustered(spark: SparkSession, path: str, lookups: list[Lookup]) -> DataFrame:
    """Rows of the table at path that meet all lookups, read from matching files only."""
    files = matching_files(spark, path, lookups)
    schema = spark.read.parquet(f"{path}/{SCHEMA}").schema
    found = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    return found.where(reduce(lambda a, b: a & b, [x.rows() for x in lookups], F.lit(True)))
