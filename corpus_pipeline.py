"""The training-data pipeline: documents -> packed sequences, one Parquet table per stage.

STAGES run in order; each reads all rows its predecessor kept, and its
decisions take effect:

1. toxicity: documents scored 0.5 or more go;
2. SimHash near-duplicates: one document of each group stays;
3. benchmark decontamination: documents that hold a benchmark window go;
4. secret scans: found spans are masked, every document stays;
5. best-fit packing: the kept documents' pieces, placed in sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillflow.llm.common import prepare, shared_folder, table, written
from tillflow.llm.decontaminate import mark_occurrences
from tillflow.llm.packing import pack_documents
from tillflow.llm.secrets import mask_secrets
from tillflow.llm.simhash import keep_one
from tillflow.llm.toxicity import fit_toxicity, score_toxicity

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

TOXIC_FROM = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    scored = score_toxicity(docs, model)
    width = len(docs.columns)
    inner = scored.toDF(*[f"c{i}" for i in range(width + 1)])
    return inner.where(inner[f"c{width}"] < TOXIC_FROM).drop(f"c{width}").toDF(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    width = len(docs.columns)
    marked = mark_occurrences(docs, table(spark, sf_dir, "benchmark"))
    inner = marked.toDF(*[f"c{i}" for i in range(width + 3)])
    return inner.where(f"size(c{width}) = 0").select(*[f"c{i}" for i in range(width)]).toDF(*docs.columns)


def mask_found_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mask_secrets(docs, shared_folder(spark, "ledger"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scans", mask_found_secrets),
    ("best_fit_packing", pack),
]

#: Learned scores, fingerprints and a tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir; every stage is written to shared storage and read again."""
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
