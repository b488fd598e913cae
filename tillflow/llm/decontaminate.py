"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the windows of `window` consecutive words of every benchmark
item (an item of fewer words is one window). Patterns of one length m share a
table set. With blocks of two words, SHIFT[block] is the distance from the
block's last occurrence in any pattern to the pattern end. A block that no
pattern holds lets the scan jump m - 1 words. Where the shift is 0, the hash
bucket of that ending block lists the patterns that end in it, and a direct
comparison of all words confirms the occurrence.

Defined cases: NULL or word-less documents have no words, no hits and the
digest of the empty list. Word-less items give no window. Items with the same
window are all reported. A NULL item_id takes part as an item but has no name
in the list. Repeated documents are judged row by row. An empty benchmark
leaves every document clean. Extra columns of either table are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.llm.common import append_columns, table

#: Windows of one broadcast pattern block (10 words each, about 150 bytes a window).
BLOCK_WINDOWS = 200_000

SPANS = "array<struct<s:int,e:int>>"

# Bytes that separate words once A-Z is lower-cased: everything in ASCII but 0-9 and a-z.
_FOLD = bytes((c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32)
              for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words of a text, as UTF-8: runs of digits, a-z and non-ASCII characters."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


def item_windows(words: list[bytes], window: int) -> set[tuple[bytes, ...]]:
    if len(words) <= window:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + window]) for i in range(len(words) - window + 1)}


class WuManber:
    """Word-level Wu-Manber tables for patterns of any lengths.

    patterns: {words: value}; search yields (start, end, value) of every occurrence.
    """

    def __init__(self, patterns: dict[tuple[bytes, ...], object]):
        by_length: dict[int, list[tuple[bytes, ...]]] = {}
        for p in patterns:
            by_length.setdefault(len(p), []).append(p)
        self.patterns = patterns
        self.sets = []
        for m, group in sorted(by_length.items()):
            size = min(2, m)
            shift: dict = {}
            bucket: dict = {}
            for p in group:
                for end in range(size, m + 1):
                    block = p[end - size:end]
                    jump = m - end
                    if shift.get(block, m) > jump:
                        shift[block] = jump
                bucket.setdefault(p[m - size:], []).append(p)
            self.sets.append((m, size, shift, bucket))

    def search(self, words: list[bytes]):
        n = len(words)
        for m, size, shift, bucket in self.sets:
            if n < m:
                continue
            end, jump, get = m, m - size + 1, shift.get
            if size == 2:
                while end <= n:
                    block = (words[end - 2], words[end - 1])
                    s = get(block, jump)
                    if s:
                        end += s
                        continue
                    for p in bucket[block]:
                        if tuple(words[end - m:end]) == p:
                            yield end - m, end, self.patterns[p]
                    end += 1
            else:  # one-word items: the block is the word itself
                for i, w in enumerate(words):
                    if (w,) in shift:
                        yield i, i + 1, self.patterns[(w,)]


def pattern_blocks(benchmark: DataFrame, window: int, block_windows: int = BLOCK_WINDOWS):
    """Yield pattern dicts {window words: sorted item numbers} of bounded size.

    Items reach the driver one block at a time (toLocalIterator); a block is
    closed when it holds block_windows windows, so no broadcast outgrows it.
    """
    block: dict[tuple[bytes, ...], list] = {}
    items = benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string"))
    for item, text in items.toLocalIterator():
        for w in item_windows(words_of(text), window):
            block.setdefault(w, []).append(item)
        if len(block) >= block_windows:
            yield block
            block = {}
    if block:
        yield block


def mark_occurrences(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = 10,
                     block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """docs with `hit_spans` (word ranges [start, end)), `hit_items` and `hit_words`.

    Narrow: no shuffle. A benchmark over one block adds one map stage per
    block, each with its own bounded broadcast.
    """
    sc = docs.sparkSession.sparkContext
    width = len(docs.columns)
    inner = docs.toDF(*[f"c{i}" for i in range(width)])
    body = f"c{docs.columns.index(text)}"
    blocks = 0
    for block in pattern_blocks(benchmark, window, block_windows):
        shared = sc.broadcast({w: tuple(sorted({i for i in items if i is not None}))
                               for w, items in block.items()})
        inner = append_columns(inner, [body], f"s{blocks} {SPANS}, i{blocks} array<string>, w{blocks} int",
                               _matcher(shared))
        blocks += 1
    if not blocks:
        inner = append_columns(inner, [body], "w0 int", _count_words)
    spans = F.flatten(F.array(*[F.col(f"s{b}") for b in range(blocks)])) if blocks else F.array().cast(SPANS)
    items = F.array_sort(F.array_distinct(F.flatten(F.array(*[F.col(f"i{b}") for b in range(blocks)])))) \
        if blocks else F.array().cast("array<string>")
    return inner.select(*[f"c{i}" for i in range(width)], spans, items, "w0").toDF(
        *docs.columns, "hit_spans", "hit_items", "hit_words")


def _count_words():
    return lambda cols: [[len(words_of(t)) for t in cols[0]]]


def _matcher(shared):
    def make():
        machine = WuManber(shared.value)

        def run(cols):
            spans, found, count = [], [], []
            for t in cols[0]:
                words = words_of(t)
                hits, items = [], set()
                for s, e, names in machine.search(words):
                    hits.append((s, e))
                    items.update(names)
                spans.append([{"s": s, "e": e} for s, e in merge(hits)])
                found.append(sorted(items))
                count.append(len(words))
            return [spans, found, count]
        return run
    return make


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of half-open ranges, in order."""
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def covered(spans: list) -> int:
    return sum(e - s for s, e in merge([(x["s"], x["e"]) for x in spans]))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract digest of mark_occurrences over all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = mark_occurrences(docs, table(spark, sf_dir, "benchmark")).drop("text")

    def run(batches):
        for b in batches:
            hit = [covered(x) for x in b.column("hit_spans").to_pylist()]
            items = b.column("hit_items").to_pylist()
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"),
                pa.array(b.column("hit_words").to_pylist(), pa.int64()),
                pa.array(hit, pa.int64()),
                pa.array([len(x) for x in items], pa.int64()),
                pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items]),
                pa.array([h > 0 for h in hit])],
                names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    kind = dict(docs.dtypes)["doc_id"]
    return marked.mapInArrow(run, f"doc_id {kind}, n_words long, n_hit long, n_items long, "
                                  "items_sha256 string, contaminated boolean")
