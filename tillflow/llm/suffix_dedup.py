"""Exact substring de-duplication: sampled suffixes ranked at growing lengths.

Removes every byte covered by a string of `length` bytes that also starts
anywhere else in the corpus. Ranking all suffixes would shuffle every
position several times, so a content-defined sample of them is ranked: each
window of `length` bytes is represented by its anchor, the position of the
smallest hash among its strings of `gram` bytes. Equal windows have equal
anchors at equal places, so no pair is missed, and an anchor stands for the
run of windows that choose it. Ranks are names (hashes) of growing strings,
as in prefix doubling: equal strings have equal names.

1. Name by the gram at the anchor. A unique name ends the suffix: none of its
   windows repeats.
2. Name by the whole text of the anchor's windows. If it repeats, all of the
   windows do.
3. What is left stands at the edges of repeats: its windows are named one by
   one, against the other texts of its gram.

Names that repeat inside one input partition are settled there, and one row
speaks for them, so a passage that very many documents hold never meets in
one task. Edges whose gram has very many texts are settled in chunks, and
across chunks by a table of the windows left. Equal documents are one
document until the end.

Names are two independent 64-bit hashes wherever a removal is decided.

Defined cases: a NULL text is empty. Texts shorter than `length` keep all
bytes. Repeated rows and copies of a text remove each other whole. NULL ids
are kept. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.llm.common import prepare, table, written
from tillflow.llm.decontaminate import merge
from tillflow.operators.ordering import default_partitions

LENGTH = 200
GRAM = 40
#: Bytes hashed together; longer texts are hashed in overlapping pieces.
SEGMENT = 1 << 20
#: Texts of one gram in a chunk, if they are too many for one task.
GROUP = 128
#: Edge texts whose windows are named together inside a task.
EDGE_ROWS = 4000

# Kinds of rows between the rounds.
COVERED, ALONE, OPEN, PRESENT, CLASS, EDGE, PARTNER = range(7)
RECORD = "gram long, f long, k1 long, k2 long, packed long"

_rng = np.random.default_rng(20240229)
_TABLES = _rng.integers(1, 2 ** 63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTORS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_MASK = (1 << 64) - 1


def scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Names:
    """Names of all substrings of byte buffers, from prefix sums of a polynomial modulo 2**64."""

    def __init__(self):
        self.powers: list[tuple[np.ndarray, np.ndarray]] = []

    def _power(self, which: int, n: int):
        while len(self.powers) <= which:
            self.powers.append((np.ones(1, np.uint64), np.ones(1, np.uint64)))
        if len(self.powers[which][0]) < n:
            size = max(n, SEGMENT)
            def grow(r):
                out = np.full(size, r, np.uint64)
                out[0] = 1
                return np.cumprod(out, dtype=np.uint64)
            factor = _FACTORS[which]
            self.powers[which] = (grow(factor), grow(pow(factor, -1, 1 << 64)))
        return self.powers[which]

    def sums(self, which: int, buf: np.ndarray) -> np.ndarray:
        out = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(_TABLES[which][buf] * self._power(which, len(buf) + 1)[0][:len(buf)], out=out[1:])
        return out

    def name(self, which: int, sums: np.ndarray, start, end) -> np.ndarray:
        return scramble((sums[end] - sums[start]) * self._power(which, len(sums))[1][start])


def anchors(names: Names, texts: list[bytes], length: int, gram: int):
    """(text number, anchor, first window, last window, gram name, name of all windows) per anchor, as arrays.

    Positions are relative to the text. Windows never cross texts.
    """
    buf = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    width = length - gram + 1
    if len(buf) < length:
        return [np.zeros(0, np.int64)] * 4 + [np.zeros(0, np.uint64)] * 2
    a, b = names.sums(0, buf), names.sums(1, buf)
    at = np.arange(len(buf) - gram + 1)
    grams = names.name(0, a, at, at + gram)
    # smallest hash of each window, with its place in the low bits: the leftmost wins ties
    low = (grams & np.uint64(_MASK << 24 & _MASK)) | at.astype(np.uint64)
    span = 1
    while span * 2 <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    windows = len(buf) - length + 1
    low = np.minimum(low[:windows], low[width - span:width - span + windows])
    place = (low & np.uint64((1 << 24) - 1)).astype(np.int64)
    begin = np.concatenate([[0], ends[:-1]])
    inside = np.zeros(len(buf) + 1, np.int32)
    fit = ends - begin >= length
    np.add.at(inside, begin[fit], 1)
    np.add.at(inside, ends[fit] - length + 1, -1)
    start = np.nonzero(np.cumsum(inside[:windows]) > 0)[0]
    if not len(start):
        return [np.zeros(0, np.int64)] * 4 + [np.zeros(0, np.uint64)] * 2
    place = place[start]
    text = np.searchsorted(ends, start, side="right")
    new = np.ones(len(start), bool)
    new[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
    first = np.nonzero(new)[0]
    last = np.append(first[1:], len(start)) - 1
    lo, hi, p, text = start[first], start[last], place[first], text[first]
    whole = names.name(1, b, lo, hi + length)
    whole = scramble(whole + (p - lo).astype(np.uint64) * np.uint64(0xA24BAED4963EE407) + (p - hi).astype(np.uint64))
    base = begin[text]
    return [text, p - base, lo - base, hi - base, grams[p], whole]


def _key(text: Column) -> tuple[Column, Column]:
    return F.xxhash64(text), F.xxhash64(F.lit(1), text)


def content(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(k, k1, k2, t): rows with the 128-bit name and the UTF-8 bytes of their text."""
    body = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.col(key).alias("k"), body.alias("t"))
    k1, k2 = _key(F.col("t"))
    return rows.select("k", k1.alias("k1"), k2.alias("k2"), "t")


def _pack(pos, dlo, dhi, kind):
    return pos << 19 | dlo << 11 | dhi << 3 | kind


def _batch(kind, gram, f, k1, k2, packed):
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(x).view(np.int64) if np.asarray(x).dtype == np.uint64 else np.asarray(x, np.int64))
                                       for x in (gram, f, k1, k2, (packed & ~7) | kind)],
                                      names=["gram", "f", "k1", "k2", "packed"])


def _slices(n: int, size: int = 50_000):
    return ((at, min(n, at + size)) for at in range(0, n, size))


def anchor_rows(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """Round 0: anchors of every text, settled as far as one input partition can tell.

    ALONE: gram unique here. OPEN: gram repeated here, its windows' text not.
    COVERED: text repeated here, merged to byte ranges (gram = start, f = end).
    PRESENT / CLASS: one row that speaks for a gram / a text repeated here.
    """
    def run(batches):
        names, seen, parts = Names(), set(), []
        pending, size = [], 0

        def flush():
            if pending:
                text, p, lo, hi, g, f = anchors(names, [t for *_, t in pending], length, gram)
                k1 = np.array([x[0] for x in pending], np.int64)[text]
                k2 = np.array([x[1] for x in pending], np.int64)[text]
                base = np.array([x[2] for x in pending], np.int64)[text]
                parts.append((g, f, k1, k2, base + p, p - lo, p - hi))
                pending.clear()

        for b in batches:
            for k1, k2, t in zip(b.column("k1").to_pylist(), b.column("k2").to_pylist(), b.column("t").to_pylist()):
                if len(t) < length or (k1, k2) in seen:
                    continue
                seen.add((k1, k2))
                for base in range(0, max(1, len(t) - length + 1), SEGMENT):
                    piece = t[base:base + SEGMENT + length - 1]
                    if pending and size + len(piece) > SEGMENT:
                        flush()
                        size = 0
                    pending.append((k1, k2, base, piece))
                    size += len(piece)
        flush()
        if not parts:
            return
        g, f, k1, k2, pos, dlo, dhi = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((f, g))
        g, f, k1, k2, pos, dlo, dhi = (x[order] for x in (g, f, k1, k2, pos, dlo, dhi))
        packed = _pack(pos, dlo, dhi, 0)
        new_g = np.append(True, g[1:] != g[:-1])
        new_f = new_g | np.append(True, f[1:] != f[:-1])
        many = lambda new: (n := np.diff(np.append(np.nonzero(new)[0], len(new))))[np.cumsum(new) - 1]
        n_g, n_f = many(new_g), many(new_f)
        picks = ((ALONE, n_g == 1), (OPEN, (n_g > 1) & (n_f == 1)), (PRESENT, new_g & (n_g > 1)), (CLASS, new_f & (n_f > 1)))
        for kind, mask in picks:
            at = np.nonzero(mask)[0]
            for s, e in _slices(len(at)):
                i = at[s:e]
                yield _batch(kind, g[i], f[i], k1[i], k2[i], packed[i])
        at = np.nonzero(n_f > 1)[0]
        yield from _ranges(k1[at], k2[at], pos[at] - dlo[at], pos[at] - dhi[at] + length)

    return rows.select("k1", "k2", "t").mapInArrow(run, RECORD)


def _ranges(k1, k2, start, end):
    """COVERED rows of the merged byte ranges of each text."""
    if not len(k1):
        return
    order = np.lexsort((start, k2, k1))
    k1, k2, start, end = k1[order], k2[order], start[order], end[order]
    text = np.append(True, (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]))
    # running end within a text: texts are shifted apart, so one running maximum serves all
    shift = np.cumsum(text) * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + shift)
    new = text | np.append(True, start[1:] + shift[1:] > reach[:-1])
    first = np.nonzero(new)[0]
    last = np.append(first[1:], len(k1)) - 1
    for s, e in _slices(len(first)):
        i, j = first[s:e], last[s:e]
        yield _batch(COVERED, start[i], reach[j] - shift[j], k1[i], k2[i], np.zeros(len(i), np.int64))


def _columns(batches):
    cols = [[] for _ in range(5)]
    for b in batches:
        for c, x in zip(cols, b.columns):
            c.append(x.to_numpy())
    return [np.concatenate(c) if c else np.zeros(0, np.int64) for c in cols]


def rank_grams(rows: DataFrame) -> DataFrame:
    """Round 1: an ALONE row whose gram occurs elsewhere becomes OPEN; other ALONE rows end here."""
    kind = F.col("packed").bitwiseAND(F.lit(7))
    deal = F.when(kind.isin(ALONE, PRESENT), F.col("gram")).when(kind.isin(OPEN, CLASS), F.col("f")).otherwise(F.col("k1"))

    def run(batches):
        g, f, k1, k2, packed = _columns(batches)
        if not len(g):
            return
        kinds = packed & 7
        ask = np.nonzero((kinds == ALONE) | (kinds == PRESENT))[0]
        _, at, count = np.unique(g[ask], return_inverse=True, return_counts=True)
        again = ask[(count[at] > 1) & (kinds[ask] == ALONE)]
        for kind, rest in ((OPEN, again), (OPEN, np.nonzero(kinds == OPEN)[0]), (CLASS, np.nonzero(kinds == CLASS)[0]),
                           (COVERED, np.nonzero(kinds == COVERED)[0])):
            for s, e in _slices(len(rest)):
                i = rest[s:e]
                yield _batch(kind, g[i], f[i], k1[i], k2[i], packed[i])

    return rows.repartition(deal).mapInArrow(run, RECORD)


def rank_texts(rows: DataFrame, length: int) -> DataFrame:
    """Round 2: OPEN rows whose windows' text occurs elsewhere are COVERED; the others are EDGE rows.

    A PARTNER row stands for each repeated text, for the edges of its gram.
    """
    kind = F.col("packed").bitwiseAND(F.lit(7))

    def run(batches):
        g, f, k1, k2, packed = _columns(batches)
        if not len(g):
            return
        order = np.lexsort((packed >> 3, k2, k1, f, g))
        g, f, k1, k2, packed = (x[order] for x in (g, f, k1, k2, packed))
        new = np.append(True, (g[1:] != g[:-1]) | (f[1:] != f[:-1]))
        group = np.cumsum(new) - 1
        # equal texts in several partitions are one place
        place = new | np.append(True, (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]) | (packed[1:] >> 3 != packed[:-1] >> 3))
        known = np.zeros(group[-1] + 1, bool)
        np.logical_or.at(known, group, (packed & 7) == CLASS)
        known |= np.bincount(group, place) > 1
        settled = known[group]
        for kind, mask in ((PARTNER, settled & new), (EDGE, ~settled & place)):
            at = np.nonzero(mask)[0]
            for s, e in _slices(len(at)):
                i = at[s:e]
                yield _batch(kind, g[i], f[i], k1[i], k2[i], packed[i])
        at = np.nonzero(settled & ((packed & 7) == OPEN))[0]
        pos, dlo, dhi = packed[at] >> 19, packed[at] >> 11 & 255, packed[at] >> 3 & 255
        yield from _ranges(k1[at], k2[at], pos - dlo, pos - dhi + length)

    return rows.where(kind.isin(OPEN, CLASS)).repartition("f").mapInArrow(run, RECORD)


def squeezed(rows: DataFrame, once: bool) -> DataFrame:
    """Rows with zstd-compressed text for a shuffle; once: equal texts of a partition as one row (NULL k)."""
    kind = dict(rows.dtypes)["k"]

    def run(batches):
        pack = zstandard.ZstdCompressor(level=3).compress
        seen = set()
        for b in batches:
            k1, k2, t = (b.column(c).to_pylist() for c in ("k1", "k2", "t"))
            keep = range(len(t))
            if once:
                keep = [i for i in keep if (k1[i], k2[i]) not in seen and not seen.add((k1[i], k2[i]))]
            yield pa.RecordBatch.from_arrays([b.column("k").take(pa.array(keep, pa.int64())),
                                              *[b.column(c).take(pa.array(keep, pa.int64())) for c in ("k1", "k2")],
                                              pa.array([pack(t[i]) for i in keep], pa.binary())], names=["k", "k1", "k2", "z"])
    return rows.mapInArrow(run, f"k {kind}, k1 long, k2 long, z binary")


def edge_texts(rows: DataFrame, edges: DataFrame, length: int) -> DataFrame:
    """(gram, n, k1, k2, packed, body): the windows' text of every edge and partner of a gram with several texts."""
    grams = written(edges.groupBy(F.col("gram").alias("g")).agg(F.count("*").alias("n")).where("n > 1"), "grams")
    wanted = written(edges.join(grams, F.col("gram") == F.col("g")).groupBy("k1", "k2").agg(
        F.collect_list(F.struct("gram", "n", "packed")).alias("at")).select(
        F.col("k1").alias("e1"), F.col("k2").alias("e2"), "at"), "wanted")
    held = squeezed(rows.where(F.octet_length("t") >= length), once=True).join(
        wanted.hint("merge"), (F.col("k1") == F.col("e1")) & (F.col("k2") == F.col("e2"))).select("k1", "k2", "z", "at")

    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for b in batches:
            out = []
            for k1, k2, z, at in zip(*[c.to_pylist() for c in b.columns]):
                t = unpack(z)
                for x in at:
                    pos, dlo, dhi = x["packed"] >> 19, x["packed"] >> 11 & 255, x["packed"] >> 3 & 255
                    out.append((x["gram"], x["n"], k1, k2, x["packed"], t[pos - dlo:pos - dhi + length]))
            for s, e in _slices(len(out), 5000):
                cols = list(zip(*out[s:e]))
                yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in cols[:5]], pa.array(cols[5], pa.binary())],
                                                 names=["gram", "n", "k1", "k2", "packed", "body"])
    return held.mapInArrow(run, "gram long, n long, k1 long, k2 long, packed long, body binary")


def window_names(names: Names, bodies: list[bytes], length: int):
    """(row, window, name, name) of every window of every body, as arrays."""
    buf = np.frombuffer(b"".join(bodies), np.uint8)
    size = np.array([len(x) for x in bodies], np.int64)
    begin = np.cumsum(size) - size
    count = size - length + 1
    row = np.repeat(np.arange(len(bodies)), count)
    window = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    start = begin[row] + window
    return row, window, *[names.name(i, names.sums(i, buf), start, start + length) for i in (0, 1)]


def repeated_windows(names: Names, rows: list[tuple], length: int, share: bool):
    """Settle the windows of rows (gram, k1, k2, packed, body) among themselves.

    Yields COVERED ranges of the edges' windows that occur twice. With share,
    also the rest for a comparison with other rows: windows that occur once
    (EDGE, or PRESENT for a partner's) and one PRESENT row of each that repeats;
    gram and f are then the window's names, packed holds its place.
    """
    row, window, x, y = window_names(names, [r[4] for r in rows], length)
    k1, k2, packed = (np.array([r[i] for r in rows], np.int64) for i in (1, 2, 3))
    order = np.lexsort((y, x))
    new = np.append(True, (x[order][1:] != x[order][:-1]) | (y[order][1:] != y[order][:-1]))
    many = np.diff(np.append(np.nonzero(new)[0], len(new)))[np.cumsum(new) - 1] > 1
    again, lead = np.zeros(len(row), bool), np.zeros(len(row), bool)
    again[order], lead[order] = many, new
    start = (packed[row] >> 19) - (packed[row] >> 11 & 255) + window
    edge = (packed[row] & 7) == EDGE
    at = np.nonzero(again & edge)[0]
    yield from _ranges(k1[row[at]], k2[row[at]], start[at], start[at] + length)
    if share:
        for kind, mask in ((EDGE, ~again & edge), (PRESENT, (again & lead) | (~again & ~edge))):
            at = np.nonzero(mask)[0]
            for s, e in _slices(len(at)):
                i = at[s:e]
                yield _batch(kind, x[i], y[i], k1[row[i]], k2[row[i]], start[i] << 3)


def _settle(length: int, share: bool, *by: str):
    """mapInArrow function: whole groups of equal `by` columns, some thousand rows at a time."""
    def run(batches):
        names, rows = Names(), []
        cols = (*by, "k1", "k2", "packed", "body")
        for b in batches:
            rows += zip(*[b.column(c).to_pylist() for c in cols])
        rows.sort(key=lambda r: r[:-1])
        rows = [r for i, r in enumerate(rows) if not i or r[:-1] != rows[i - 1][:-1]]
        group = lambda i: rows[i][:len(by)]
        at = 0
        while at < len(rows):
            end = min(len(rows), at + (1 if share else EDGE_ROWS))
            while end < len(rows) and group(end) == group(end - 1):
                end += 1
            yield from repeated_windows(names, [(r[0], *r[-4:]) for r in rows[at:end]], length, share)
            at = end
    return run


def rank_windows(texts: DataFrame, length: int, group: int = GROUP) -> DataFrame:
    """Round 3: COVERED ranges of the single windows of edges that occur elsewhere.

    The texts of one gram meet in one task if they are few beside what a task
    reads anyway. Otherwise they are dealt into chunks: what repeats inside a
    chunk is settled there and one row speaks for it, and the windows that
    occur once in their chunk are compared across chunks by name.
    """
    most = max(group, texts.count() // default_partitions(texts) // 4)
    few = texts.where(F.col("n") <= most).repartition("gram").mapInArrow(_settle(length, False, "gram"), RECORD)
    chunk = F.pmod(F.xxhash64("k1", "k2", "packed"), F.ceil(F.col("n") / group)).alias("chunk")
    dealt = texts.where(F.col("n") > most).select("*", chunk).repartition("gram", "chunk")
    single = written(dealt.mapInArrow(_settle(length, True, "gram", "chunk"), RECORD), "windows")
    kind = F.col("packed").bitwiseAND(F.lit(7))
    place = F.xxhash64("k1", "k2", F.shiftright("packed", 3))
    again = written(single.where(kind != COVERED).groupBy(F.col("gram").alias("x"), F.col("f").alias("y")).agg(
        F.min(place).alias("lo"), F.max(place).alias("hi")).where("lo <> hi").select("x", "y"), "again")
    many = single.where(kind == EDGE).join(again, (F.col("gram") == F.col("x")) & (F.col("f") == F.col("y"))).select(
        F.shiftright("packed", 3).alias("gram"), (F.shiftright("packed", 3) + length).alias("f"), "k1", "k2",
        F.lit(COVERED).cast("long").alias("packed"))
    return few.unionByName(single.where(kind == COVERED)).unionByName(many)


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(k, z, n_bytes, spans): each row's compressed text and the merged byte ranges to remove."""
    rows = content(docs, key, text)
    opened = written(rank_grams(anchor_rows(rows, length, gram)), "grams")
    kind = F.col("packed").bitwiseAND(F.lit(7))
    ranked = written(rank_texts(opened, length), "texts")
    texts = written(edge_texts(rows, ranked.where(kind.isin(EDGE, PARTNER)), length), "edges")
    windows = rank_windows(texts, length)
    whole = (rows.select("k1", "k2", F.octet_length("t").cast("long").alias("n")).where(F.col("n") >= length)
             .groupBy("k1", "k2").agg(F.count("*").alias("c"), F.max("n").alias("f")).where("c > 1")
             .select(F.lit(0).cast("long").alias("gram"), "f", "k1", "k2", F.lit(COVERED).cast("long").alias("packed")))
    covered = opened.where(kind == COVERED).unionByName(ranked.where(kind == COVERED)).unionByName(windows).unionByName(whole)
    spans = written(covered.groupBy(F.col("k1").alias("s1"), F.col("k2").alias("s2")).agg(
        F.collect_set(F.struct(F.col("gram").alias("s"), F.col("f").alias("e"))).alias("spans")), "spans")
    return squeezed(rows, once=False).join(
        spans.hint("merge"), (F.col("k1") == F.col("s1")) & (F.col("k2") == F.col("s2")), "left").select("k", "z", "spans")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract digest of remove_repeats over all documents."""
    found = remove_repeats(table(prepare(spark), sf_dir, "documents"))
    kind = dict(found.dtypes)["k"]

    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for b in batches:
            out = []
            for z, spans in zip(b.column("z").to_pylist(), b.column("spans").to_pylist()):
                t = unpack(z)
                gone = merge([(x["s"], x["e"]) for x in spans or ()])
                digest, last = hashlib.sha256(), 0
                for s, e in gone:
                    digest.update(t[last:s])
                    last = e
                digest.update(t[last:])
                out.append((len(t), sum(e - s for s, e in gone), len(gone), digest.hexdigest()))
            n, cut, runs, sha = zip(*out) if out else ((),) * 4
            yield pa.RecordBatch.from_arrays([b.column("k"), *[pa.array(x, pa.int64()) for x in (n, cut, runs)], pa.array(sha, pa.string())],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return found.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
