"""Sinks: clean CSV, star-schema tables with a date layout, report CSVs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tillflow.session import shuffles_dropped


# Fixed value: the tables are read far less often than they take up disk.
TABLE_CODEC = "zstd"


def write_csv(df: DataFrame, path: str) -> None:
    """Flat CSV with a header, replacing what is there (one file per task).

    Text is written as is: Spark's CSV writer trims leading and trailing
    spaces unless told not to, and quotes inside a field are doubled (RFC
    4180), which every CSV reader understands.
    """
    (df.write.mode("overwrite").option("header", True)
     .option("quote", '"').option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))


def write_table(df: DataFrame, path: str, date_col: str | None = None,
                key_col: str | None = None, partition_by_month: bool = False,
                table: str | None = None, metrics: dict[str, Column] | None = None,
                audit: dict[str, int] | None = None,
                finish: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """S6 + S7: replace-mode Parquet load with an access-path layout.

    `metrics` (name -> aggregate) are collected by the write itself and put
    into `audit`. They sit behind the last exchange, in the writing tasks, whose
    results count once even if a stage is run again.

    With `date_col` rows are range-partitioned on (date, key): every file
    covers a narrow range of dates, so date filters skip whole files through
    min/max statistics, and a day with very many rows is split by key. With
    `partition_by_month` the files also go to `ano_mes=yyyy-MM` folders
    (partition pruning). `table` also registers it in the catalog
    (saveAsTable) instead of a path-only write. `finish` adds what follows from a
    row alone, behind the exchange, so that it is not shuffled.

    The shuffle files of the write go as soon as it is done.
    """
    out = df
    if date_col is not None:
        order = [c for c in (date_col, key_col) if c]
        if partition_by_month:
            out = out.withColumn("ano_mes", F.date_format(F.col(date_col), "yyyy-MM"))
            order = ["ano_mes", *order]
        out = out.repartitionByRange(*order)
        out = (out.transform(finish) if finish else out).sortWithinPartitions(*order)
    elif finish:
        out = out.transform(finish)
    seen = Observation() if metrics else None
    if metrics:
        out = out.observe(seen, *[c.alias(n) for n, c in metrics.items()])
    writer = out.write.mode("overwrite").format("parquet").option("compression", TABLE_CODEC)
    if date_col is not None and partition_by_month:
        writer = writer.partitionBy("ano_mes")
    spark = df.sparkSession
    with shuffles_dropped(spark):
        if table:
            writer.option("path", path).saveAsTable(table)
        else:
            writer.save(path)
    back = spark.table(table) if table else spark.read.parquet(path)
    if metrics:
        audit.update({n: int(v or 0) for n, v in seen.get.items()})
    return back


def write_report(df: DataFrame, out_dir: str, name: str) -> str:
    """One CSV folder per report name under out_dir."""
    path = f"{out_dir.rstrip('/')}/{name}"
    write_csv(df, path)
    return path
