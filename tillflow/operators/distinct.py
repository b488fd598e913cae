"""Exact distinct counts that merge: sets of dense numbers, kept per cell.

Counting the distinct customers of every possible selection by `count_distinct`
reads and shuffles the sales again for each. Here every customer gets a dense
number, and the set of customers of a *cell* (one combination of the columns
that selections ask for) is kept as a few small rows, one per block of 32,768
numbers. A block with few customers keeps their positions, a fuller one a
bitmap of 4 KB, so a set never takes more than two bytes a customer and cell.
Sums that merge (rows, money) ride along.

The answer to any selection is the union of the sets of its cells: bitmaps are
OR-ed, positions are set as bits, and bits are counted. Only cells are read,
and what is shuffled is one bitmap per block, task and group. Cells laid out by
block (`by_block`) put few blocks into a task, so these bitmaps grow with the
number of blocks and tasks, not with their product.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.operators.ordering import global_row_index

#: Sets of a block with fewer members are kept as positions (2 bytes each) instead of a bitmap (4,096 bytes).
FEW = 2048
NUMBER, BLOCK, BITS, PLACES = "_numero", "_bloco", "_mapa", "_posicoes"


def dense_numbers(keys: DataFrame, column: str) -> DataFrame:
    """(column, _numero): distinct values numbered from 1 in order."""
    indexed, _ = global_row_index(keys.select(column).distinct(), [F.col(column).asc_nulls_first()], index_col=NUMBER)
    return indexed.select(column, (F.col(NUMBER) + 1).alias(NUMBER))


def sets_by_cell(rows: DataFrame, cell: list[str], sums: dict[str, Column]) -> DataFrame:
    """One row per cell and block: the members' numbers (`_numero` of rows) as bits or positions, and the sums.

    Every task reduces its rows to one per cell and block, where a member with very many rows is one position.
    So rows are shuffled once, two bytes a member; a bitmap is made only of a block that is full enough, once it is whole.
    """
    blocks = rows.groupBy(*cell, F.bitmap_bucket_number(NUMBER).alias(BLOCK)).agg(
        F.collect_set(F.bitmap_bit_position(NUMBER).cast("smallint")).alias(PLACES),  # at most 32,768 positions
        *[F.sum(c).alias(n) for n, c in sums.items()])
    few = F.size(PLACES) < FEW
    sparse = blocks.where(few).select(*cell, BLOCK, F.lit(None).cast("binary").alias(BITS), PLACES, *sums)
    # the keys hold the block whole, so its positions become bits without another shuffle
    dense = blocks.where(~few).select(*cell, BLOCK, *sums, F.explode(PLACES).alias("_p")).groupBy(*cell, BLOCK, *sums) \
        .agg(F.bitmap_construct_agg(F.col("_p").cast("bigint")).alias(BITS))
    return sparse.unionByName(dense.withColumn(PLACES, F.lit(None).cast("array<smallint>")))


def by_block(cells: DataFrame, cell: list[str], finish: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Cells laid out by block, and by cell within a block, so a range of the first cell column skips row groups.

    `finish` adds what follows from a row alone, behind the exchange.
    """
    laid_out = cells.repartitionByRange(BLOCK, *cell)
    laid_out = laid_out.transform(finish) if finish else laid_out
    return laid_out.sortWithinPartitions(BLOCK, *[c for c in cell if c in laid_out.columns])


def merged_counts(cells: DataFrame, group: list[str], sums: list[str], distinct: str) -> DataFrame:
    """One row per group (one row in all without group): the sums, and the number of distinct members."""
    dense = cells.where(F.col(BITS).isNotNull()).groupBy(*group, BLOCK).agg(F.bitmap_or_agg(BITS).alias(BITS))
    places = cells.where(F.col(PLACES).isNotNull()).select(*group, BLOCK, F.explode(PLACES).alias("_p"))
    sparse = places.groupBy(*group, BLOCK).agg(F.bitmap_construct_agg(F.col("_p").cast("bigint")).alias(BITS))
    union = dense.unionByName(sparse).groupBy(*group, BLOCK).agg(F.bitmap_or_agg(BITS).alias(BITS))
    counted = union.select(*group, F.bitmap_count(BITS).alias(distinct))
    added = cells.select(*group, *sums)
    both = added.withColumn(distinct, F.lit(0).cast("bigint")).unionByName(
        counted.select(*group, *[F.lit(None).cast(t).alias(n) for n, t in added.dtypes if n in sums], distinct))
    return both.groupBy(*group).agg(*[F.sum(n).alias(n) for n in sums], F.coalesce(F.sum(distinct), F.lit(0)).alias(distinct))
