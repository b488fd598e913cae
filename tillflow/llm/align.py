"""Cross-tokenizer alignment by divide and conquer at shared cuts.

Two tokenizers cut the same bytes. A byte offset where tokens of both end is a
shared cut. An interval of the text is divided at a shared cut near its middle:
the search starts at the end of A's middle token and bisects the ends of B for
it, then the ends of A for what it found, and so on until both meet (first to
the right, then to the left). Both halves are divided alike; an interval of
one token of either side, or without a shared cut inside, is a group. All texts of a batch are
divided together, one level of halves at a time, in numpy.

A link is a pair of an A token and a B token whose byte ranges overlap; links
never leave a group. How many links hold an id pair is counted over the whole
corpus. A task collects the distinct pairs of a block of texts (a block ends at
a bound of pairs or links), and each text keeps its links as numbers into its
block's list; so one row per block and pair is shuffled for the counts, not one
per link, and a pair that every text holds is one row per block. The counts go
back to their blocks, where the texts' links look them up.

Defined cases: NULL and empty texts, and texts whose tokens do not give back
the text's bytes, have no tokens: zeros and an empty digest. Repeated rows are
texts of their own; NULL ids are kept. An empty table gives no rows. Extra
columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.llm.common import prepare, table, written
from tillflow.llm.tokens import ByteTokens, PieceTokens, texts_of, tokenizer_path

#: A block of texts ends when it holds this many links or distinct pairs.
BLOCK_LINKS = 2_000_000
BLOCK_PAIRS = 400_000


def common_end(a: np.ndarray, b: np.ndarray, i: np.ndarray, low: np.ndarray, high: np.ndarray,
               right: bool) -> tuple[np.ndarray, np.ndarray]:
    """(A token, B token) that end together, found from A token i on: the nearest one to the right, or to
    the left; -1 where tokens low .. high of A hold none. a and b are sorted ends."""
    found_i, found_j = np.full(len(i), -1, np.int64), np.full(len(i), -1, np.int64)
    side, back = ("left", 0) if right else ("right", 1)
    live = np.flatnonzero((low <= i) & (i <= high))
    i, low, high = i[live], low[live], high[live]
    while len(live):
        j = np.searchsorted(b, a[i], side) - back
        at = b[np.maximum(j, 0)]
        hit = (j >= 0) & (at == a[i])
        found_i[live[hit]], found_j[live[hit]] = i[hit], j[hit]
        go = np.flatnonzero(~hit & (j >= 0))
        live, low, high, at = live[go], low[go], high[go], at[go]
        i = np.searchsorted(a, at, side) - back
        inside = np.flatnonzero((low <= i) & (i <= high))
        live, i, low, high = live[inside], i[inside], low[inside], high[inside]
    return found_i, found_j


def shared_groups(a: np.ndarray, b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray) -> np.ndarray:
    """Sorted ends of the groups of all texts: intervals of tokens divided at shared cuts.

    a, b: sorted token ends in one numbering of bytes; text t has the tokens first_a[t] .. first_a[t + 1]
    of A and likewise of B, none of both or some of both, ending together.
    """
    some = first_a[1:] > first_a[:-1]
    al, ah, bl, bh = (x[some] for x in (first_a[:-1], first_a[1:], first_b[:-1], first_b[1:]))
    leaves = []
    while len(al):
        wide = (ah - al > 1) & (bh - bl > 1)
        leaves.append(a[ah[~wide] - 1])
        al, ah, bl, bh = al[wide], ah[wide], bl[wide], bh[wide]
        middle = (al + ah - 2) // 2
        i, j = common_end(a, b, middle, al, ah - 2, True)
        none = np.flatnonzero(i < 0)
        i[none], j[none] = common_end(a, b, middle[none] - 1, al[none], ah[none] - 2, False)
        leaves.append(a[ah[i < 0] - 1])
        cut = i >= 0
        al, ah, bl, bh, i, j = (x[cut] for x in (al, ah, bl, bh, i, j))
        halves = [np.empty(2 * len(i), np.int64) for _ in range(4)]  # both halves of each, in order
        for half, left, right in zip(halves, (al, i + 1, bl, j + 1), (i + 1, ah, j + 1, bh)):
            half[0::2], half[1::2] = left, right
        al, ah, bl, bh = halves
    return np.sort(np.concatenate(leaves)) if leaves else np.empty(0, np.int64)


class Sides:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, bytes_path: str, pieces_path: str):
        self.a, self.b = ByteTokens(bytes_path, plain=True), PieceTokens(pieces_path)
        self.words, self.sizes, self.texts = [], [], []
        for side, marks in ((self.a, ",|"), (self.b, ",;")):
            words = side.token_bytes()
            self.words.append(pa.array(words, pa.large_binary()))
            self.sizes.append(np.array([len(w) for w in words], np.int64))
            # the text of an id and what stands behind it: inside its side of a group, and at its end
            self.texts.append(pa.array([f"{i}{m}".encode() for i in range(len(words)) for m in marks], pa.large_binary()))

    def _ids(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of each text by A and B, empty where either does not give back the bytes of blank + text."""
        some = [i for i, t in enumerate(texts) if t]
        out = [[np.empty(0, "<u4")] * len(texts) for _ in range(2)]
        a, b = self.a.encode([" " + texts[i] for i in some]), self.b.encode([texts[i] for i in some])
        for i, x, y in zip(some, a, b):
            want = (" " + texts[i]).encode()
            if all(_joined(words, ids) == want for words, ids in zip(self.words, (x, y))):
                out[0][i], out[1][i] = x, y
        return out[0], out[1]

    def align(self, texts: list[str]) -> "Aligned":
        return Aligned(self, *self._ids(texts))


def _joined(words: pa.Array, ids: np.ndarray) -> bytes:
    """Bytes of all tokens, one behind the other."""
    taken = words.take(pa.array(ids))
    offsets = np.frombuffer(taken.buffers()[1], np.int64)
    data = taken.buffers()[2]
    return b"" if data is None else data.to_pybytes()[offsets[taken.offset]:offsets[taken.offset + len(taken)]]


class Aligned:
    """A batch of texts: tokens, groups and links. Bytes, tokens, groups and links are numbered through all texts."""

    def __init__(self, sides: Sides, a: list[np.ndarray], b: list[np.ndarray]):
        self.sides = sides
        self.n = [np.array([len(x) for x in side], np.int64) for side in (a, b)]
        self.first = [np.concatenate([[0], np.cumsum(n)]) for n in self.n]  # first token of each text
        self.ids = [np.concatenate([np.empty(0, "<u4"), *side]).astype(np.int64) for side in (a, b)]
        self.ends = [np.cumsum(size[ids]) for size, ids in zip(sides.sizes, self.ids)]
        self.bounds = np.concatenate([[0], self.ends[0]])[self.first[0]]  # bytes of each text
        self.groups = shared_groups(*self.ends, *self.first)
        self.n_groups = np.diff(np.searchsorted(self.groups, self.bounds, side="right"))
        # every stretch between neighbouring ends, of either side, is the overlap of one pair of tokens
        end_here = np.zeros(self.bounds[-1] + 1, bool)
        end_here[self.ends[0]] = end_here[self.ends[1]] = True
        meets = np.flatnonzero(end_here)
        self.links = [ids[np.searchsorted(e, meets)] for ids, e in zip(self.ids, self.ends)]
        self.first_link = np.searchsorted(meets, self.bounds, side="right")

    def digests(self) -> list[str]:
        """SHA-256 of each text's groups; '' for a text without tokens."""
        if not len(self.groups):
            return [""] * len(self.n[0])
        of = [np.searchsorted(self.groups, e) for e in self.ends]  # group of each token
        last = [np.append(g[1:] != g[:-1], True) for g in of]
        before = [np.searchsorted(of[1], of[0], side="left"), np.searchsorted(of[0], of[1], side="right")]
        total = len(self.ids[0]) + len(self.ids[1])
        at = [np.arange(len(g)) + other for g, other in zip(of, before)]
        code = np.empty(total, np.int64)
        shift = len(self.sides.texts[0])
        code[at[0]] = self.ids[0] * 2 + last[0]
        code[at[1]] = self.ids[1] * 2 + last[1] + shift
        texts = pa.concat_arrays(self.sides.texts).take(pa.array(code))
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:]
        data = memoryview(texts.buffers()[2])
        start = offsets[self.first[0] + self.first[1]]
        return [hashlib.sha256(data[s:e - 1]).hexdigest() if e > s else "" for s, e in zip(start, start[1:])]

    def text_groups(self) -> list[list[dict]]:
        """Groups of each text: its A and its B ids."""
        cut = [np.searchsorted(e, self.groups, side="right") for e in self.ends]
        starts = [np.concatenate([[0], c])[:-1] for c in cut]
        every = [{"a": self.ids[0][i:j].tolist(), "b": self.ids[1][k:m].tolist()}
                 for i, j, k, m in zip(starts[0], cut[0], starts[1], cut[1])]
        at = np.concatenate([[0], np.cumsum(self.n_groups)])
        return [every[i:j] for i, j in zip(at, at[1:])]


class Block:
    """Distinct pairs of the texts of one block, numbered as they come, with their links counted."""

    def __init__(self):
        self.pairs = np.empty(0, np.int64)    # sorted
        self.number = np.empty(0, np.int64)   # of each of them
        self.count = np.empty(0, np.int64)    # by number
        self.links = 0

    def add(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of the links' pairs."""
        pairs, where, count = np.unique(keys, return_inverse=True, return_counts=True)
        at = np.searchsorted(self.pairs, pairs)
        old = at < len(self.pairs)
        old[old] = self.pairs[at[old]] == pairs[old]
        number = np.empty(len(pairs), np.int64)
        number[old] = self.number[at[old]]
        new = np.flatnonzero(~old)
        number[new] = len(self.count) + np.arange(len(new))
        self.count = np.concatenate([self.count, np.zeros(len(new), np.int64)])
        self.count[number] += count
        self.pairs = np.insert(self.pairs, at[new], pairs[new])
        self.number = np.insert(self.number, at[new], number[new])
        self.links += len(keys)
        return number[where]

    def rows(self) -> tuple[np.ndarray, np.ndarray]:
        """(pairs, counts) by number."""
        pairs = np.empty(len(self.count), np.int64)
        pairs[self.number] = self.pairs
        return pairs, self.count


def aligned_texts(docs: DataFrame, bytes_path: str, pieces_path: str, key: str = "doc_id", text: str = "text",
                  with_groups: bool = False) -> DataFrame:
    """Rows of texts (k, n_a, n_b, n_groups, n_links, groups_sha256, links[, groups], block) and of blocks
    (block, pairs, counts). Written once."""
    kind = dict(docs.dtypes)[key]
    columns = [("k", kind), ("n_a", "long"), ("n_b", "long"), ("n_groups", "long"), ("n_links", "long"),
               ("groups_sha256", "string"), ("links", "binary"),
               *[("groups", "array<struct<a:array<long>,b:array<long>>>")] * with_groups,
               ("block", "long"), ("pairs", "array<long>"), ("counts", "array<long>")]
    schema = ", ".join(f"{c} {t}" for c, t in columns)

    def run(batches):
        sides, task = Sides(bytes_path, pieces_path), TaskContext.get().partitionId()
        block, number, target = Block(), 0, None

        def name():
            return (task << 32) + number

        def close():
            pairs, counts = block.rows()
            cols = {"block": pa.array([name()], pa.int64()), "pairs": pa.array([pairs], pa.list_(pa.int64())),
                    "counts": pa.array([counts], pa.list_(pa.int64()))}
            return pa.RecordBatch.from_arrays([cols.get(f.name, pa.nulls(1, f.type)) for f in target], schema=target)

        for b in batches:
            if target is None:
                names = [c for c, _ in columns]
                kinds = {"k": b.schema.field(0).type, "groups_sha256": pa.string(), "links": pa.binary(),
                         "groups": pa.list_(pa.struct([("a", pa.list_(pa.int64())), ("b", pa.list_(pa.int64()))])),
                         "pairs": pa.list_(pa.int64()), "counts": pa.list_(pa.int64())}
                target = pa.schema([(c, kinds.get(c, pa.int64())) for c in names])
            texts, at = texts_of(b.column(1)), 0
            while at < len(texts):  # slices of a bounded number of bytes, one text at least
                size, to = 0, at
                while to < len(texts) and (to == at or size + len(texts[to]) <= 2_000_000):
                    size, to = size + len(texts[to]), to + 1
                got = sides.align(texts[at:to])
                links = block.add((got.links[0] << 32) | got.links[1]).astype("<u4")
                cuts = got.first_link
                cols = {"k": b.column(0).slice(at, to - at), "n_a": got.n[0], "n_b": got.n[1], "n_groups": got.n_groups,
                        "n_links": np.diff(cuts), "groups_sha256": got.digests(),
                        "links": [links[i:j].tobytes() for i, j in zip(cuts, cuts[1:])],
                        "block": np.full(to - at, name(), np.int64)}
                if with_groups:
                    cols["groups"] = got.text_groups()
                arrays = [cols[f.name] if f.name == "k" else pa.array(cols[f.name], f.type) if f.name in cols
                          else pa.nulls(to - at, f.type) for f in target]
                yield pa.RecordBatch.from_arrays(arrays, schema=target)
                at = to
                if block.links >= BLOCK_LINKS or len(block.count) >= BLOCK_PAIRS:
                    yield close()
                    block, number = Block(), number + 1
        if block.links:
            yield close()

    return written(docs.select(key, text).mapInArrow(run, schema), "aligned-texts")


def pair_counts(rows: DataFrame) -> DataFrame:
    """(owner: a block, number, count, best) of each block's pairs: how many links of the corpus hold the pair, and
    whether no other pair of its B id has more."""
    each = rows.where("pairs IS NOT NULL").select("block", F.explode(F.arrays_zip("pairs", "counts")).alias("p"))
    pairs = rows.where("pairs IS NOT NULL").select("block", F.posexplode("pairs").alias("number", "pair"))
    total = each.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.counts").alias("count"))
    total = written(total, "pair-counts")
    b_id = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    most = total.groupBy(b_id.alias("b")).agg(F.max("count").alias("most"))
    known = total.withColumn("b", b_id).join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    return pairs.join(known, "pair").select(F.col("block").alias("owner"), "number", "count", "best")


def align_texts(docs: DataFrame, bytes_path: str | None = None, pieces_path: str | None = None, key: str = "doc_id",
                text: str = "text", with_groups: bool = False) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256[, groups]) of every text."""
    rows = aligned_texts(docs, bytes_path or tokenizer_path(), pieces_path or tokenizer_path("piece_bpe_32k.model"),
                         key, text, with_groups)
    own = ["k", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"] + ["groups"] * with_groups
    texts = rows.where("pairs IS NULL")
    empty = texts.where("n_links = 0").select(*own, F.lit(0).cast("long").alias("n_best"), F.lit(0).cast("long").alias("count_sum"))
    linked = texts.where("n_links > 0").select("block", *own, "links")

    def look_up(mine: pa.Table, counts: pa.Table) -> pa.Table:
        number = counts.column("number").to_numpy()
        count, best = np.zeros(len(number), np.int64), np.zeros(len(number), bool)
        count[number] = counts.column("count").to_numpy()
        best[number] = counts.column("best").to_numpy()
        links = [np.frombuffer(x, "<u4") for x in mine.column("links").to_pylist()]
        return mine.drop_columns(["block", "links"]) \
            .append_column("n_best", pa.array([int(best[x].sum()) for x in links], pa.int64())) \
            .append_column("count_sum", pa.array([int(count[x].sum()) for x in links], pa.int64()))

    found = linked.groupBy("block").cogroup(pair_counts(rows).groupBy("owner")).applyInArrow(look_up, empty.schema)
    return empty.union(found).withColumnRenamed("k", key)


def op13_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract digest of align_texts over all documents."""
    docs = table(prepare(spark), sf_dir, "documents")
    return align_texts(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links",
                                    "n_best", "count_sum", "groups_sha256")
