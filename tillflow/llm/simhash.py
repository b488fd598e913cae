"""SimHash near-duplicates with bit-sliced comparison.

A text's fingerprint holds the majority of each bit over the hashes of its
word shingles. Fingerprints within `radius` bits link. The 64 bits are cut
into radius + 2 blocks: two fingerprints within the radius agree in at least
two of them, so pairs of blocks are the keys of buckets in which all links are
found. Inside a bucket the bits of 64 fingerprints are stored vertically, one
word per bit plane. The distances of a fingerprint to all 64 are counted at
once in carry-save bit counters, plane by plane, and a block is abandoned as
soon as all its counters exceed the radius.

Distinct fingerprints are compared, so exact copies cost nothing. A bucket of
many fingerprints is cut into chunks, and each pair of chunks is a task of
its own. A task hands on one link per fingerprint, not all pairs.

Defined cases: NULL, empty and word-less texts have fingerprint zero and link
like any other. A NULL id takes part, but never names a component unless all
its members are NULL. Repeated rows share a fingerprint and a component. An
empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.llm.common import prepare, table, written
from tillflow.llm.components import label_components, star_edges

SHINGLE_WORDS = 4
RADIUS = 4
SEED = 42
#: Fingerprints of a bucket that are compared in one task; larger buckets are cut into chunks.
CHUNK = 512
#: (fingerprint, block) comparisons carried through the planes together.
LANES = 1 << 15

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def shingle_hashes(text: str | None, words: int = SHINGLE_WORDS) -> np.ndarray:
    """XXH64 of every shingle of `words` space-joined words of the lower-cased text, repeats included."""
    import xxhash
    parts = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not parts:
        return np.zeros(0, np.uint64)
    line = b" ".join(parts)
    if len(parts) <= words:
        return np.array([xxhash.xxh64_intdigest(line, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    n = len(parts) - words + 1
    return np.fromiter((digest(line[s:e], SEED) for s, e in zip(starts[:n].tolist(), ends[words - 1:].tolist())),
                       np.uint64, n)


def fingerprint(hashes: np.ndarray) -> int:
    """Bits set in more than half of the hashes, as a signed 64-bit number; 0 for none."""
    if not len(hashes):
        return 0
    count = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.ascontiguousarray(hashes[at:at + (1 << 16)]).astype("<u8")
        count += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(count * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """(k, h, fp) of every row: fingerprint of the whole text, and a hash that tells texts of one key apart."""
    def run(batches):
        for b in batches:
            fp = [fingerprint(shingle_hashes(t, words)) for t in b.column("t").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("k"), b.column("h"), pa.array(fp, pa.int64())], names=["k", "h", "fp"])
    rows = docs.select(F.col(key).alias("k"), F.xxhash64(text).alias("h"), F.col(text).alias("t"))
    return rows.mapInArrow(run, f"k {dict(docs.dtypes)[key]}, h long, fp long")


def bucket_keys(radius: int = RADIUS):
    """Array column of bucket keys of column fp: one for each pair of the radius + 2 blocks."""
    count = radius + 2
    edges = [64 * i // count for i in range(count + 1)]
    block = [F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)) for lo, hi in zip(edges, edges[1:])]
    width = max(hi - lo for lo, hi in zip(edges, edges[1:]))
    return F.array(*[F.shiftleft(F.lit(t).cast("long"), 2 * width) + F.shiftleft(block[i], width) + block[j]
                     for t, (i, j) in enumerate(combinations(range(count), 2))])


def bit_planes(values: np.ndarray) -> np.ndarray:
    """64 planes of the values: bit l of word w of plane b is bit b of value 64 * w + l."""
    padded = np.zeros(-(-len(values) // 64) * 64, "<u8")
    padded[:len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8")


def linked_rows(values: np.ndarray, first: np.ndarray, last: np.ndarray, radius: int):
    """Links (row, row) of each value to the values of rows first..last-1, in parts.

    Works on blocks of 64 rows; rows of a block outside the range are masked.
    """
    planes = bit_planes(values)
    rows = np.nonzero(last > first)[0]
    begin, blocks = first[rows] >> 6, ((last[rows] - 1) >> 6) - (first[rows] >> 6) + 1
    done = np.concatenate([[0], np.cumsum(blocks)])
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    at = 0
    while at < len(rows):
        end = max(at + 1, int(np.searchsorted(done, done[at] + LANES, side="right")) - 1)
        part, size = rows[at:end], blocks[at:end]
        q = np.repeat(part, size)
        w = np.arange(len(q)) - np.repeat(done[at:end] - done[at], size) + np.repeat(begin[at:end], size)
        low = np.clip(first[q] - (w << 6), 0, 63).astype(np.uint64)
        high = np.clip((w << 6) + 64 - last[q], 0, 63).astype(np.uint64)
        live = (full << low) & (full >> high)
        counters = [np.zeros(len(q), np.uint64) for _ in range(max(1, radius.bit_length()))]
        over = np.zeros(len(q), np.uint64)
        for b in range(64):
            carry = planes[b][w] ^ (np.uint64(0) - ((values[q] >> np.uint64(b)) & np.uint64(1)))
            for c in counters:  # carry-save: each counter bit plane takes the carry of the one below
                carry, c[:] = c & carry, c ^ carry
            over |= carry
            if b % 8 == 7 and b >= 15:
                live &= ~(over | exceeds(counters, radius))
                keep = live != 0
                if not keep.any():
                    q = q[:0]
                    break
                if keep.mean() < 0.7:
                    q, w, live, over = q[keep], w[keep], live[keep], over[keep]
                    counters = [c[keep] for c in counters]
        if len(q):
            hit = np.unpackbits(live.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            k, lane = np.nonzero(hit)
            if len(k):
                yield q[k], (w[k] << 6) + lane
        at = end


def exceeds(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose bit-sliced counter is above the radius."""
    above, equal = np.uint64(0), ~np.uint64(0)
    for k in range(len(counters) - 1, -1, -1):
        if radius >> k & 1:
            equal = equal & counters[k]
        else:
            above = above | (equal & counters[k])
            equal = equal & ~counters[k]
    return above + np.zeros_like(counters[0])


def compare_tiles(tiles: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) between fingerprints of each tile(key, i, j, chunk, fp): chunk i against chunk j."""
    def run(batches):
        names = ("key", "i", "j", "chunk", "fp")
        cols = [[] for _ in names]
        for b in batches:
            for c, name in zip(cols, names):
                c.append(b.column(name).to_numpy())
        if not cols[0]:
            return
        key, i, j, chunk, fp = (np.concatenate(c) for c in cols)
        n = len(key)
        new = np.ones(n, bool)
        new[1:] = (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
        start = np.nonzero(new)[0]
        tile = np.cumsum(new) - 1
        last = np.append(start[1:], n)[tile]
        first = np.arange(n) + 1
        # a tile of two chunks compares its first chunk with its second; rows are sorted by chunk
        cross = i != j
        firsts = np.bincount(tile[chunk == i], minlength=len(start))
        second = (start + firsts)[tile]
        first = np.where(cross, second, first)
        last = np.where(cross & (chunk == j), first, last)
        for a, b in linked_rows(fp.view(np.uint64), first, last, radius):
            a, b = star_edges(a, b)
            yield pa.RecordBatch.from_arrays([pa.array(fp[a]), pa.array(fp[b])], names=["a", "b"])

    return tiles.mapInArrow(run, "a long, b long")


def link_fingerprints(distinct: DataFrame, radius: int = RADIUS, chunk: int = CHUNK) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints (column fp) within the radius."""
    keyed = distinct.select("fp", F.explode(bucket_keys(radius)).alias("key"))
    sizes = written(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "sizes")
    shared = keyed.join(sizes, "key").withColumn("chunks", F.ceil(F.col("n") / chunk).cast("int")).withColumn(
        "chunk", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))
    tiles = shared.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(
        "key", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "chunk", "fp")
    dealt = tiles.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "chunk")
    return compare_tiles(dealt, radius)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS,
                    radius: int = RADIUS) -> DataFrame:
    """(k, h, fp, root, component) of every row; component is the smallest key reachable by links."""
    rows = written(fingerprints(docs, key, text, words), "fingerprints")
    distinct = written(rows.groupBy("fp").agg(F.min("k").alias("rep")), "distinct")
    labels = label_components(distinct.select(F.col("fp").alias("node"), F.col("rep").alias("name")),
                              link_fingerprints(distinct, radius))
    return rows.join(labels, F.col("fp") == F.col("node")).select("k", "h", "fp", "root", F.col("label").alias("component"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS,
             radius: int = RADIUS) -> DataFrame:
    """docs with one row of each near-duplicate group: the smallest key (NULL last), then the smallest text hash."""
    found = written(near_duplicates(docs, key, text, words, radius), "found")
    first = written(found.groupBy(F.col("root").alias("r")).agg(
        F.min(F.struct(F.col("k").isNull().alias("none"), "k", "h")).alias("w")), "first")
    chosen = (F.col("w.k").eqNullSafe(F.col("k"))) & (F.col("w.h") == F.col("h"))
    rows = found.join(first, F.col("root") == F.col("r")).groupBy("k", "h").agg(
        F.max(chosen).alias("chosen"), F.count("*").alias("n"))
    listed = written(rows.where("NOT chosen OR n > 1").select(
        F.col("k").alias("lk"), F.col("h").alias("lh"), "chosen"), "listed")
    names = docs.columns
    inner = docs.toDF(*[f"c{i}" for i in range(len(names))])
    k, t = (f"c{names.index(c)}" for c in (key, text))
    # always a merge join: the dropped rows grow with the corpus
    marked = inner.withColumn("h", F.xxhash64(t)).join(
        listed.hint("merge"), F.col(k).eqNullSafe(F.col("lk")) & (F.col("h") == F.col("lh")), "left")
    kept = marked.where("chosen IS NULL").drop("h", "lk", "lh", "chosen")
    if not listed.where("chosen").isEmpty():  # a chosen row that occurs repeatedly stays once
        kept = kept.unionByName(marked.where("chosen").dropDuplicates([k, "h"]).drop("h", "lk", "lh", "chosen"))
    return kept.toDF(*names)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract result of near_duplicates over all documents."""
    found = near_duplicates(table(prepare(spark), sf_dir, "documents"))
    return found.select(F.col("k").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                        F.col("component").alias("component_id"))
