"""Atomic replacement of a set of tables: versioned folders and one manifest.

The tables of a run are written to a new folder, `versions/<id>/<table>`, and
readers go by the manifest `CURRENT`, which names one folder. The manifest is
replaced in one step, after all tables are written. So readers see all tables
of the old run or all of the new one; a run broken in between leaves an unnamed
folder, which `prune` removes.

The step is a rename onto the old manifest, which HDFS and local file systems
do atomically. (On an object store the same holds for its single small object.)
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

MANIFEST = "CURRENT"


def _path(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file beside `path`, then rename it onto `path`."""
    jvm = spark._jvm
    fs, new = _path(spark, f"{path}.{uuid.uuid4().hex}")
    out = fs.create(new, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    files.rename(fs.makeQualified(new), fs.makeQualified(_path(spark, path)[1]), options)


def current(spark: SparkSession, root: str) -> dict | None:
    """The manifest: {"version": folder name, "tables": {name: rows or None}}; None before the first release."""
    fs, where = _path(spark, f"{root}/{MANIFEST}")
    if not fs.exists(where):
        return None
    return json.loads("".join(r[0] for r in spark.read.text(f"{root}/{MANIFEST}", wholetext=True).collect()))


def table_path(spark: SparkSession, root: str, name: str) -> str:
    """Folder of a table of the current release."""
    manifest = current(spark, root)
    if manifest is None or name not in manifest["tables"]:
        raise FileNotFoundError(f"no released table {name} under {root}")
    return f"{root}/versions/{manifest['version']}/{name}"


def read_released(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(spark, root, name))


class Release:
    """One run's tables. Write each to path(name), then publish once."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.version = f"{int(time.time() * 1000):013d}-{uuid.uuid4().hex[:8]}"
        self.tables: dict[str, int | None] = {}

    def path(self, name: str) -> str:
        return f"{self.root}/versions/{self.version}/{name}"

    def add(self, name: str, rows: int | None = None) -> None:
        """The table `name` is complete under path(name)."""
        self.tables[name] = rows

    def publish(self) -> dict:
        """Readers change over here."""
        manifest = {"version": self.version, "tables": self.tables}
        _replace_text(self.spark, f"{self.root}/{MANIFEST}", json.dumps(manifest))
        return manifest


def prune(spark: SparkSession, root: str, keep: int = 1, older_than_hours: float = 24.0) -> list[str]:
    """Delete versions but the current one, the `keep` newest others and those young enough to be still written."""
    fs, where = _path(spark, f"{root}/versions")
    if not fs.exists(where):
        return []
    named = (current(spark, root) or {}).get("version")
    limit = (time.time() - older_than_hours * 3600) * 1000
    others = sorted((e for e in fs.listStatus(where) if e.getPath().getName() != named),
                    key=lambda e: e.getPath().getName(), reverse=True)
    gone = []
    for e in others[keep:]:
        if e.getModificationTime() < limit:
            fs.delete(e.getPath(), True)
            gone.append(e.getPath().getName())
    return gone
