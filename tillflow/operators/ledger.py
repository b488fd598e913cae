"""Keep-first de-duplication of arriving batches against all earlier ones.

A one-shot keep-first sorts every raw row by key. When rows arrive in batches,
only the keys of earlier batches matter, not their rows: they are kept in a
ledger, a table bucketed and sorted by key. A batch is de-duplicated by itself,
shuffled into the same buckets, and joined to the ledger bucket by bucket, so
neither the history's rows nor the ledger are shuffled again.

Every ledger row names its batch, and a batch is compared with *earlier* batches
only, while its own output replaces what an earlier attempt left. So a batch
that is run again after a failure gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.operators.cleaning import TRANSACTION_KEY, dedupe_keep_first

KEY, BATCH = "_chave", "_lote"


def ledger_key(column: str) -> Column:
    """The key as text that is never NULL: NULL keys are one key, as in the one-shot job."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit("-"))


class KeyLedger:
    """Keys already landed, in a bucketed table `name` under `path`, and the rows kept of each batch."""

    def __init__(self, spark: SparkSession, name: str, path: str, buckets: int = 64, key: str = TRANSACTION_KEY):
        self.spark, self.name, self.path, self.buckets, self.key = spark, name, path.rstrip("/"), buckets, key

    def _known(self) -> DataFrame | None:
        return self.spark.table(self.name) if self.spark.catalog.tableExists(self.name) else None

    def unseen(self, batch: DataFrame, number: int) -> DataFrame:
        """First rows of the batch whose key no earlier batch had (needs the input-order column)."""
        first = dedupe_keep_first(batch, self.key).withColumn(KEY, ledger_key(self.key))
        known = self._known()
        if known is None:
            return first.drop(KEY)
        earlier = known.where(F.col(BATCH) < number).select(KEY)
        # a merge join at every size: the ledger stays in its buckets, and the batch is dealt into the same ones
        return first.join(earlier.hint("merge"), KEY, "left_anti").drop(KEY)

    def land(self, batch: DataFrame, number: int) -> DataFrame:
        """Keep the batch's unseen rows and enter their keys; batches are numbered in order of arrival."""
        where = f"{self.path}/rows/{BATCH}={number}"
        self.unseen(batch, number).write.mode("overwrite").parquet(where)
        kept = self.spark.read.parquet(where)
        keys = kept.select(ledger_key(self.key).alias(KEY), F.lit(number).cast("long").alias(BATCH))
        keys.repartition(self.buckets, KEY).write.mode("append").format("parquet") \
            .bucketBy(self.buckets, KEY).sortBy(KEY).option("path", f"{self.path}/ledger").saveAsTable(self.name)
        return kept

    def rows(self) -> DataFrame:
        """All rows kept so far."""
        return self.spark.read.parquet(f"{self.path}/rows").drop(BATCH)
