"""Harmonic packing: pieces of reciprocal-capacity lengths, a fixed number of them in each bin.

Harmonic packing puts lengths of (C/(k+1), C/k] into class k and k of them into
each bin of that class, whatever the other workers do. Its loss is the distance
of a piece from the top of its class. Since documents may be cut freely, every
piece is cut to a top length: a length L for which floor(C/L) pieces leave at
most `slack` tokens of C free. A document gives whole sequences and a rest; the
rest is cut into the fewest top lengths, and among those into the ones with the
least padding (a table over all rests, worked out once).

Each tokenising task numbers its pieces of a length. Counts per task and length
give the number of pieces before the task's own, so every piece knows its bin
and its place there from its own number; no worker waits for another, and the
counts hold a few dozen rows a task. What does not fill a last bin (fewer than
floor(C/L) pieces a length, so a number that depends on C and slack alone) is
packed by first fit, longest first.

Defined cases: NULL and empty texts are one separator. Repeated rows are packed
as often as they occur; NULL ids are kept. An empty table gives no pieces.
Extra columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillflow.llm.common import prepare, table, written
from tillflow.llm.tokens import ByteTokens, texts_of, tokenizer_path

CAPACITY = 1024
SEPARATOR = 0
#: Tokens that a full bin may leave free (0.4 % of the capacity).
SLACK = 4


def top_lengths(capacity: int, slack: int) -> list[int]:
    """Lengths of which a whole number fills a bin but for at most `slack` tokens, longest first."""
    return [n for n in range(capacity, 0, -1) if capacity % n <= slack]


def cut_table(capacity: int, slack: int) -> list[tuple[int, ...]]:
    """For each rest 0 .. capacity - 1 its cut into top lengths: fewest pieces, then least padding."""
    tops = [(n, capacity % n / (capacity // n)) for n in top_lengths(capacity, slack)]
    best: list[tuple[int, float, int]] = [(0, 0.0, 0)]
    for rest in range(1, capacity):
        best.append(min((best[rest - n][0] + 1, best[rest - n][1] + pad, -n) for n, pad in tops if n <= rest))
    out = []
    for rest in range(capacity):
        cut = []
        while rest:
            cut.append(-best[rest][2])
            rest -= cut[-1]
        out.append(tuple(cut))
    return out


def harmonic_pieces(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text",
                    capacity: int = CAPACITY, slack: int = SLACK, with_ids: bool = False) -> DataFrame:
    """(key, start, length, ids_crc32, doc_tokens[, ids], task, number) of every document, written once.

    number counts the pieces of this length that the task made before.
    """
    kind = dict(docs.dtypes)[key]
    schema = (f"k {kind}, start long, length long, ids_crc32 long, doc_tokens long"
              + ", ids binary" * with_ids + ", task int, number long")
    names = [c.split()[0] for c in schema.split(", ")]
    end = np.array([SEPARATOR], "<u4")

    def run(batches):
        tokens, cuts = ByteTokens(tokenizer), cut_table(capacity, slack)
        task, seen = TaskContext.get().partitionId(), [0] * (capacity + 1)
        for b in batches:
            rows = []
            for i, ids in enumerate(tokens.encode(texts_of(b.column(1)))):
                ids = np.append(ids, end)
                n, at = len(ids), 0
                raw = memoryview(ids.tobytes())
                for length in (*[capacity] * (n // capacity), *cuts[n % capacity]):
                    part = raw[4 * at:4 * (at + length)]
                    made = (i, at, length, zlib.crc32(part), n, seen[length])
                    rows.append((*made, bytes(part)) if with_ids else made)
                    seen[length] += 1
                    at += length
            if rows:
                i, at, length, crc, n, number, *part = zip(*rows)
                cols = [b.column(0).take(pa.array(i, pa.int64())), *[pa.array(c, pa.int64()) for c in (at, length, crc, n)],
                        *[pa.array(p, pa.binary()) for p in part],
                        pa.array(np.full(len(i), task, np.int32)), pa.array(number, pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return written(docs.select(key, text).mapInArrow(run, schema), "harmonic-pieces")


def first_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """(bin, place) of each piece, longest first into the first bin with room."""
    fill: list[int] = []
    bins, places = [0] * len(lengths), [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        k = next((k for k, used in enumerate(fill) if used + lengths[i] <= capacity), len(fill))
        if k == len(fill):
            fill.append(0)
        bins[i], places[i] = k, fill[k]
        fill[k] += lengths[i]
    return bins, places


def harmonic_bins(pieces: DataFrame, capacity: int = CAPACITY, slack: int = SLACK) -> DataFrame:
    """harmonic_pieces with sequence_id and offset instead of task and number."""
    keep = [c for c in pieces.columns if c not in ("task", "number")]
    tops = top_lengths(capacity, slack)
    made = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("made"))
    # one window per length over one row a task
    earlier = Window.partitionBy("length").orderBy("task")
    before = made.select("length", "task", (F.sum("made").over(earlier) - F.col("made")).alias("before"),
                         F.sum("made").over(Window.partitionBy("length")).alias("all"))
    fill = F.floor(F.lit(capacity) / F.col("length")).cast("long")
    numbered = pieces.join(before, ["length", "task"]).withColumn("nth", F.col("before") + F.col("number"))
    # sequences of a length take every (number of lengths + 1)-th number; the last row of numbers is the rest's
    rank = F.lit(len(tops)) - F.array_position(F.array(*[F.lit(n).cast("long") for n in tops]), F.col("length"))
    nth_bin = F.floor(F.col("nth") / fill)
    full = numbered.where(nth_bin < F.floor(F.col("all") / fill)).select(
        *keep, (nth_bin * (len(tops) + 1) + rank).cast("long").alias("sequence_id"),
        (F.pmod("nth", fill) * F.col("length")).cast("long").alias("offset"))
    rest = numbered.where(nth_bin >= F.floor(F.col("all") / fill)).select(*keep, "nth", F.lit(0).alias("g"))

    def pack(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("length", "descending"), ("nth", "ascending")])
        bins, places = first_fit(rows.column("length").to_pylist(), capacity)
        ids = [k * (len(tops) + 1) + len(tops) for k in bins]
        return rows.drop_columns(["nth", "g"]).append_column("sequence_id", pa.array(ids, pa.int64())) \
            .append_column("offset", pa.array(places, pa.int64()))

    packed = rest.groupBy("g").applyInArrow(pack, full.schema)
    return full.unionByName(packed)


def pack_harmonic(docs: DataFrame, tokenizer: str | None = None, key: str = "doc_id", text: str = "text",
                  capacity: int = CAPACITY, slack: int = SLACK, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their sequence and place there."""
    pieces = harmonic_pieces(docs, tokenizer or tokenizer_path(), key, text, capacity, slack, with_ids)
    return harmonic_bins(pieces, capacity, slack).withColumnRenamed("k", key)


def op12_harmonic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract digest of pack_harmonic over all documents."""
    docs = table(prepare(spark), sf_dir, "documents")
    return pack_harmonic(docs).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
