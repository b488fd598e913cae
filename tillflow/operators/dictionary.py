"""Text columns that travel through a shuffle as numbers.

Rows of a sale hold several texts (place, method, status, product) that take
few different values together. Shuffled with every row they are a third of its
bytes. Here the distinct combinations of such columns are numbered; rows carry
the number through the shuffle, and the texts are joined back behind it. What
depends on the texts alone (normalising, splitting) is done once per
combination instead of once per row.

Both joins broadcast the dictionary, so there is one only where its estimated
size allows that. Columns of more combinations stay as they are, and the caller
gets None: the same rows, only wider on the way. The rows must come from stored
tables, as they are read once more to find the combinations.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.session import shuffles_dropped

#: Largest dictionary that is broadcast (bytes in memory).
DICTIONARY_BYTES = 32 << 20
_OF, CODE = "_de_", "_codigo_"


def dictionaries(df: DataFrame, *groups: tuple[str, ...]) -> list[Dictionary | None]:
    """For each group of columns its numbered distinct combinations, None where they are too many to broadcast."""
    sizes = df.agg(*[
        (F.approx_count_distinct(F.struct(*g)) * F.avg(sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in g), F.lit(64))))
        .alias(str(i)) for i, g in enumerate(groups)]).first()
    return [Dictionary(df, g, f"{CODE}{g[0]}") if (size or 0) <= DICTIONARY_BYTES else None for g, size in zip(groups, sizes)]


class Dictionary:
    """The distinct combinations of some text columns of df, numbered from 0 (NULL is a value like others)."""

    def __init__(self, df: DataFrame, columns: tuple[str, ...], code: str):
        self.columns, self.code = columns, code
        # one task numbers them: they are few; the checkpoint keeps the numbers as they are
        found = df.select(*[F.col(c).alias(_OF + c) for c in columns]).distinct().coalesce(1) \
            .withColumn(code, F.monotonically_increasing_id().cast("int"))
        with shuffles_dropped(df.sparkSession):
            self.table = found.checkpoint(eager=True)

    def encoded(self, df: DataFrame) -> DataFrame:
        """df with the number of their combination in place of the columns."""
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(_OF + c)) for c in self.columns])
        kept = [c for c in df.columns if c not in self.columns]
        return df.join(F.broadcast(self.table), same).select(*kept, self.code)

    def values(self) -> DataFrame:
        """The number and the columns of every combination."""
        return self.table.select(self.code, *[F.col(_OF + c).alias(c) for c in self.columns])

    def decoded(self, df: DataFrame, values: DataFrame | None = None) -> DataFrame:
        """df with the columns (or what `values` has made of them) in place of the number."""
        return df.join(F.broadcast(self.values() if values is None else values), self.code).drop(self.code)
