"""Secret scans with an incremental blob ledger.

Every historical version of a path is a blob named by the SHA-256 of its
UTF-8 bytes. The ledger is a Parquet table of (blob, rules, findings) rows:
one for each blob already scanned under a rule version, with or without
findings. A scan takes the versions whose (blob, rule version) pair is not in
the ledger, reads one copy of each, appends the findings, and joins the
ledger's findings back to every path that holds the blob.

Defined cases: a NULL text is the empty blob. Copies of a blob, repeated rows
included, share one scan and all get its findings. An empty table appends
nothing. Extra columns are ignored; NULL ids are kept.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.llm.common import append_columns, shared_folder, table, written

# The base rules, by kind, with the shortest value that counts.
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
HEX_LONG = re.compile(r"[0-9a-f]{24,}")
ASSIGN_HINT = re.compile(r"(?i:passw|secret|token|api_?key)", re.ASCII)
BASE_KINDS = ("assign", "access", "hex")
# Further rules, whose spans are added to the base ones.
MORE_RULES = (
    ("github", re.compile(r"gh[pousr]_[A-Za-z0-9]{36,}")),
    ("jwt", re.compile(r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}")),
    # the whole key: to its END line, or without one to the end of the key's headers and base64 lines
    ("pem", re.compile(r"-----BEGIN ([A-Z ]*PRIVATE KEY)-----(?:(?:(?!-----BEGIN )[\s\S])*?-----END \1-----|"
                       r"(?:(?:\s|\\[nr])+(?:(?:Proc-Type|DEK-Info): [^\r\n]*|[A-Za-z0-9+/]{16,}={0,2}|[A-Za-z0-9+/]+={1,2}))*)")),
)
KINDS = BASE_KINDS + tuple(k for k, _ in MORE_RULES)
RULE_VERSION = "3"

FINDINGS = "array<struct<kind:string,start:int,end:int>>"
LEDGER = f"blob binary, rules string, findings {FINDINGS}"


def find_secrets(text: str) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end) in code points, by start, then by kind as listed."""
    out = []
    if ASSIGN_HINT.search(text):
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    # a maximal run of 24 or more is found alike by the bounded form, which steps over short runs
    out += [("hex", m.start(), m.end()) for m in HEX_LONG.finditer(text)]
    for kind, rule in MORE_RULES:
        out += [(kind, m.start(), m.end()) for m in rule.finditer(text)]
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger at path, empty if nothing was written there yet."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)
    return spark.read.schema(LEDGER).parquet(path) if there else spark.createDataFrame([], LEDGER)


def versions_of(rows: DataFrame, text: str) -> DataFrame:
    """rows with the content address of each version (`blob`)."""
    return rows.withColumn("blob", F.unhex(F.sha2(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary"), 256)))


def scan_versions(rows: DataFrame, ledger_path: str, key: str = "doc_id", text: str = "text",
                  rules: str = RULE_VERSION) -> DataFrame:
    """Append the findings of unseen (blob, rules) pairs to the ledger; returns (key, blob, findings).

    Keys and 32-byte addresses are shuffled to find the unseen pairs and the
    copy of each blob to read, so a text is scanned once (repeated rows with
    one key and one text are scanned alike). The two joins read written
    tables, so that Spark can split a blob held by very many paths.
    """
    spark = rows.sparkSession
    held = versions_of(rows.select(F.col(key).alias("k"), F.col(text).alias("t")), "t")
    paths = written(held.select("k", "blob"), "paths")
    known = read_ledger(spark, ledger_path).where(F.col("rules") == rules).select(
        "blob", F.lit(True).alias("seen")).distinct()
    # Most blobs have one copy and need no decision: only blobs that several rows hold, or that
    # the ledger knows, are listed, with the path whose copy is read.
    counts = paths.groupBy("blob").agg(F.count("*").alias("n"), F.min("k").alias("first"))
    listed = written(counts.join(known, "blob", "left").where("n > 1 OR seen").select(
        F.col("blob").alias("b"), "first", F.coalesce("seen", F.lit(False)).alias("seen")), "listed")
    # always a merge join: the listed blobs grow with the corpus
    unseen = held.join(listed.hint("merge"), F.col("blob") == F.col("b"), "left").where(
        F.col("b").isNull() | (~F.col("seen") & F.col("first").eqNullSafe(F.col("k"))))
    fresh = append_columns(unseen.select("blob", "t"), ["t"], f"findings {FINDINGS}", _scanner)
    fresh.select("blob", F.lit(rules).alias("rules"), "findings").write.mode("append").option(
        "compression", "zstd").parquet(ledger_path)
    found = (read_ledger(spark, ledger_path).where((F.col("rules") == rules) & (F.size("findings") > 0))
             .groupBy(F.col("blob").alias("b")).agg(F.first("findings").alias("findings")))
    out = paths.join(written(found, "found"), F.col("blob") == F.col("b"), "left")
    return out.select(F.col("k").alias(key), "blob",
                      F.coalesce("findings", F.array().cast(FINDINGS)).alias("findings"))


def _scanner():
    def run(cols):
        return [[[{"kind": k, "start": s, "end": e} for k, s, e in find_secrets(t)] if t else []
                 for t in cols[0]]]
    return run


def mask_secrets(docs: DataFrame, ledger_path: str, key: str = "doc_id", text: str = "text", count: str | None = "n_chars",
                 mark: str = "[secret]") -> DataFrame:
    """docs with the spans that scan_versions finds replaced by a mark; `count` follows the text's length."""
    found = written(scan_versions(docs, ledger_path, key, text).where(F.size("findings") > 0).groupBy(
        F.col("blob").alias("b")).agg(F.first("findings").alias("found")), "masks")
    names = docs.columns
    inner = docs.toDF(*[f"c{i}" for i in range(len(names))])
    body = f"c{names.index(text)}"
    held = versions_of(inner, body).join(found.hint("merge"), F.col("blob") == F.col("b"), "left").drop("blob", "b")

    def make():
        def run(cols):
            return [[masked(t, spans, mark) for t, spans in zip(*cols)]]
        return run
    out = append_columns(held, [body, "found"], "masked string", make)
    new = {body: F.col("masked")}
    if count in names:
        c = f"c{names.index(count)}"
        new[c] = F.when(F.col("found").isNull(), F.col(c)).otherwise(F.length("masked")).cast(dict(docs.dtypes)[count])
    return out.select(*[new.get(f"c{i}", F.col(f"c{i}")) for i in range(len(names))]).toDF(*names)


def masked(text: str | None, findings: list | None, mark: str) -> str | None:
    """text with the found spans replaced; spans that overlap share one mark."""
    if not findings or not text:
        return text
    out, last = [], 0
    for x in findings:
        if x["start"] >= last:
            out += [text[last:x["start"]], mark]
        last = max(last, x["end"])
    return "".join([*out, text[last:]])


def joined(findings: list, kinds=KINDS) -> str:
    return ",".join(f"{x['kind']}:{x['start']}:{x['end']}" for x in findings if x["kind"] in kinds)


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract digest of scan_versions over all documents, on a new ledger."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan_versions(docs, shared_folder(spark, "ledger")).drop("blob")

    def run(batches):
        for b in batches:
            rows = b.column("findings").to_pylist()
            count = [[sum(x["kind"] == k for x in r) for r in rows] for k in BASE_KINDS]
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), *[pa.array(c, pa.int64()) for c in count],
                pa.array([hashlib.sha256(joined(r, BASE_KINDS).encode()).hexdigest() for r in rows]),
                pa.array([joined(r) for r in rows])],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    kind = dict(docs.dtypes)["doc_id"]
    return found.mapInArrow(run, f"doc_id {kind}, n_assign long, n_access long, n_hex long, "
                                 "base_sha256 string, spans string")
