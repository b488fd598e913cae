"""Incremental ingestion of raw sales files (Structured Streaming).

The reference reads one raw CSV per run. When raw files keep arriving in a
landing folder, this job lands them in a bronze Parquet table exactly once
(file-source offsets and the query checkpoint live in the shared folder)
with a global arrival ordinal (micro-batch, file, split, position). The batch
cleaning job then keeps the first copy of every transaction across all
arrivals, exactly as it does for a single file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillflow.sources.tables import ORDINAL, RAW_COLUMNS, RAW_SALES_SCHEMA, csv_reader, null_na_tokens


def raw_sales_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming scan of raw sales CSVs (explicit schema, header, NA tokens -> NULL)."""
    reader = csv_reader(spark.readStream.schema(RAW_SALES_SCHEMA))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    df = reader.csv(landing_dir)
    return df.select(*RAW_COLUMNS, F.col("_metadata.file_path").alias("_file"),
                     F.col("_metadata.file_block_start").alias("_block"))


def _land(bronze_path: str):
    """foreachBatch sink: each micro-batch overwrites its own `batch_id=` folder,
    so a batch retried after a failure replaces its output instead of duplicating it."""
    def land(batch: DataFrame, batch_id: int) -> None:
        ordinal = F.struct(F.lit(batch_id).cast("long").alias("batch"), F.col("_file").alias("file"),
                           F.col("_block").alias("block"), F.monotonically_increasing_id().alias("pos"))
        out = null_na_tokens(batch.select(*RAW_COLUMNS, ordinal.alias(ORDINAL)))
        out.write.mode("overwrite").parquet(f"{bronze_path.rstrip('/')}/batch_id={batch_id}")
    return land


def ingest_raw_sales(spark: SparkSession, landing_dir: str, bronze_path: str,
                     checkpoint_location: str, available_now: bool = True,
                     processing_time: str | None = None) -> StreamingQuery:
    """Start the landing stream (availableNow by default: process what is there, then stop).

    checkpoint_location must stay the same for the life of bronze_path, also across
    sessions: it says which files have landed.
    """
    writer = raw_sales_stream(spark, landing_dir).writeStream.foreachBatch(_land(bronze_path)) \
        .option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else \
        writer.trigger(processingTime=processing_time or "1 minute")
    return writer.start()


def read_bronze(spark: SparkSession, bronze_path: str) -> DataFrame:
    """Landed raw records with their arrival ordinal, ready for cleaning.clean_sales."""
    return spark.read.parquet(bronze_path).select(*RAW_COLUMNS, ORDINAL)
