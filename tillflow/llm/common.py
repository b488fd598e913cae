"""Helpers shared by the training-data operators."""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.session import scratch_path

#: Rows of one Arrow batch. Documents are long; 1,000 of them keep a batch at a few MB.
ARROW_ROWS = 1000


def prepare(spark: SparkSession) -> SparkSession:
    """Bound the Arrow batches of this session (never raises a smaller setting)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder of its own in the storage that all executors see."""
    return scratch_path(spark, f"llm/{name}-{uuid.uuid4().hex[:12]}")


def written(df: DataFrame, name: str) -> DataFrame:
    """df written once to shared storage and read back: cuts lineage, survives lost executors."""
    path = shared_folder(df.sparkSession, name)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Shared:
    """A broadcast value that workers need no copy of this package for: it travels as bytes, its classes with it.

    (A broadcast object is otherwise pickled by the names of its classes, which workers would import.)
    """

    def __init__(self, spark: SparkSession, value):
        self.raw = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self):
        return pickle.loads(self.raw.value)


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                schema: str) -> DataFrame:
    return df.mapInArrow(fn, schema)


def append_columns(df: DataFrame, inputs: list[str], added: str,
                   make: Callable[[], Callable[[list[list]], list]]) -> DataFrame:
    """Every row of df with the columns `added` (a DDL string) behind its own.

    make() runs once per task and returns a function from the lists of the
    input columns (text as str, NULL as None) to the list of added columns.
    Columns are addressed by position, so clashing names do no harm.
    """
    names = df.columns
    place = [names.index(c) for c in inputs]
    inner = df.toDF(*[f"c{i}" for i in range(len(names))])
    extra = T.StructType.fromDDL(added)
    schema = T.StructType([*inner.schema.fields, *extra.fields])
    width = len(names)

    def run(batches):
        score = make()
        target = None
        for b in batches:
            if target is None:
                from pyspark.sql.pandas.types import to_arrow_schema
                target = to_arrow_schema(extra)
            cols = score([b.column(i).to_pylist() for i in place])
            arrays = [pa.array(c, type=f.type) for c, f in zip(cols, target)]
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(width)], *arrays],
                                             names=[*b.schema.names, *[f.name for f in target]])

    out = inner.mapInArrow(run, schema)
    return out.toDF(*names, *[f.name for f in extra.fields])


def hashed_sample(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """At most `rows` rows of df, chosen by the hash of keys; what reaches one task stays near `rows`."""
    every = max(1, df.count() // max(1, rows))
    mark = F.xxhash64(*keys)
    return df.where(F.pmod(mark, F.lit(every)) == 0).orderBy(mark, *keys).limit(rows)


def held_out(doc_id):
    """Rows whose labels are never learned from: crc32(doc_id as text) mod 5 = 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))
