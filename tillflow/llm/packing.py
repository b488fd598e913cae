"""Packing of tokenised documents into fixed-length sequences by minimum bin slack.

Tokens: a public byte-level BPE as it is read from its file, added tokens
included, with one separator id behind each document.
A document longer than a sequence is cut into full pieces behind a shorter
first one. Full pieces are sequences of their own. The others are dealt at
random into groups of bounded size, and each group is packed alone: the
longest piece left opens a bin, a bitset subset-sum over the lengths still
available finds the fullest combination for the rest of the bin, and that
combination is removed. A group leaves at most its last bins slack, so the
loss stays a small share of the sequences at every size.

Defined cases: NULL and empty texts are one separator. Repeated rows are
packed as often as they occur; NULL ids are kept. An empty table gives no
pieces. Extra columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.llm.common import prepare, table, written
from tillflow.llm.tokens import ByteTokens, tokenizer_path

CAPACITY = 2048
SEPARATOR = 0
#: Pieces packed together; a group holds a few thousand small rows.
GROUP_PIECES = 4000


class WordTokenizer:
    """Token ids of whole texts, as little-endian unsigned 32-bit bytes (see `tokens.ByteTokens`).

    With `added`, the tokenizer stays as it was read: a text that holds one of
    its added tokens gets that token's id. Otherwise such tokens are plain text.
    """

    def __init__(self, path: str, added: bool = False):
        self.tokens = ByteTokens(path, plain=not added)

    def encode(self, texts: list[str]) -> list[bytes]:
        return [ids.tobytes() for ids in self.tokens.encode(texts)]


def pieces_of(ids: bytes, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of one document; only the first may be shorter."""
    n = len(ids) // 4
    if n <= capacity:
        return [(0, n)]
    head = n % capacity
    starts = ([0] if head else []) + list(range(head, n, capacity))
    return [(s, e - s) for s, e in zip(starts, [*starts[1:], n])]


def tokenized_pieces(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text",
                     capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """(uid, key, piece, start, length, ids_crc32[, ids]) of every document, written once."""
    kind = dict(docs.dtypes)[key]
    schema = f"k {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids

    def run(batches):
        words = WordTokenizer(tokenizer, added=True)
        end = np.asarray([SEPARATOR], "<u4").tobytes()
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            rows = []
            for i, ids in enumerate(words.encode(texts)):
                ids += end
                for p, (s, n) in enumerate(pieces_of(ids, capacity)):
                    part = ids[4 * s:4 * (s + n)]
                    rows.append((i, p, s, n, zlib.crc32(part), part if with_ids else None))
            if rows:
                at, p, s, n, crc, part = zip(*rows)
                cols = [b.column(0).take(pa.array(at, pa.int64())), pa.array(p, pa.int32()), pa.array(s, pa.int64()),
                        pa.array(n, pa.int64()), pa.array(crc, pa.int64())]
                names = ["k", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    cols.append(pa.array(part, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    pieces = docs.select(key, text).mapInArrow(run, schema)
    return written(pieces.withColumn("uid", F.monotonically_increasing_id()), "pieces").withColumnRenamed("k", key)


def fullest(seed: int, counts: dict[int, int], lengths: list[int], capacity: int) -> list[int]:
    """Lengths that fill capacity - seed as far as any combination of the available ones can.

    Bit s of the set says that sum s can be reached. Lengths enter from the
    longest; the search ends when the bin is full.
    """
    room = capacity - seed
    goal, limit = 1 << room, (1 << (room + 1)) - 1
    bits, steps = 1, []
    for n in lengths:
        if n > room:
            continue
        copies, block = min(counts[n], room // n), 1
        while copies and not bits & goal:  # copies of one length enter in doubling blocks
            take = min(block, copies)
            steps.append((n, take, bits))
            bits |= bits << (n * take) & limit
            copies -= take
            block *= 2
        if bits & goal:
            break
    left, out = bits.bit_length() - 1, []
    for n, take, before in reversed(steps):
        if not before >> left & 1:
            out += [n] * take
            left -= n * take
    return out


def minimum_bin_slack(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Bins of item numbers, by minimum bin slack with the longest item as the seed of each bin."""
    items: dict[int, list[int]] = {}
    for i, n in enumerate(lengths):
        items.setdefault(n, []).append(i)
    counts = {n: len(x) for n, x in items.items()}
    left = sorted(counts, reverse=True)
    bins = []

    def take(n):
        counts[n] -= 1
        if not counts[n]:
            left.remove(n)
        return items[n].pop()

    while left:
        seed = left[0]
        first = take(seed)
        bins.append([first, *[take(n) for n in fullest(seed, counts, left, capacity)]])
    return bins


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """pieces(uid, length, ...) with sequence_id and offset. Needs uids that stay (a written table)."""
    short = pieces.where(F.col("length") < capacity)
    groups = max(1, -(-short.count() // group_pieces))
    names = pieces.columns

    def pack(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("uid")
        lengths = rows.column("length").to_pylist()
        seq, off = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
        for k, items in enumerate(minimum_bin_slack(lengths, capacity)):
            at = 0
            for i in items:
                seq[i], off[i] = k, at
                at += lengths[i]
        # odd numbers; full pieces take even ones
        seq = (rows.column("g").to_numpy() * (1 << 32) + seq) * 2 + 1
        return rows.drop_columns("g").append_column("sequence_id", pa.array(seq)).append_column("offset", pa.array(off))

    schema = ", ".join(f"`{c}` {t}" for c, t in pieces.dtypes) + ", sequence_id long, offset long"
    dealt = short.withColumn("g", F.pmod(F.xxhash64("uid"), F.lit(groups)))
    packed = dealt.groupBy("g").applyInArrow(pack, schema)
    full = pieces.where(F.col("length") >= capacity).select(
        *names, (F.col("uid") * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(full)


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with their sequence and place."""
    return pack_pieces(tokenized_pieces(docs, tokenizer or tokenizer_path(), capacity=capacity), capacity)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract digest of pack_documents over all documents."""
    docs = table(prepare(spark), sf_dir, "documents")
    return pack_documents(docs).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
