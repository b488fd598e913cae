"""Embedding near-duplicates by iterative quantisation and multi-index Hamming tables.

1. Equal vectors are one class. On a bounded sample of classes, unit vectors
   are centred and turned to their principal axes. Iterative quantisation then
   learns a rotation that brings them close to balanced binary codes: signs
   and rotation are fitted in turns. Several rotations, from different starts,
   give longer codes. Each length of vector has a model of its own.
2. Each code is cut into substrings. A substring is the key of one Hamming
   table, so every class stands in each table once. Classes in one bucket are
   candidates if their whole codes differ in at most `radius` bits. Substrings
   start at the width that the number of classes asks for; rotations are added,
   and then substrings shortened, until pairs at exactly the threshold, drawn
   around vectors that were not fitted, meet with the wanted recall. The radius
   holds all of these pairs. Few classes are one bucket, compared whole.
3. Candidates are reranked by the cosine of the original vectors in double
   precision; a pair that shares several buckets counts in the first only.

Large buckets are cut into chunks, and each pair of chunks is a tile of its
own. Tiles are dealt to tasks; a vector travels once to each task that holds
any of its tiles. A task hands on link counts, and one link per class for the
components, not all pairs.

Defined cases: NULL and zero vectors, and vectors with NULL or non-finite
components link with nothing; vectors of different lengths do not link. A NULL id takes part, but names a component only if all its members
are NULL. Repeated rows link with each other. An empty table gives an empty
result. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.llm.common import Shared, hashed_sample, prepare, table, written
from tillflow.llm.components import label_components, star_edges
from tillflow.operators.ordering import default_partitions

THRESHOLD = 0.9
#: Classes the rotations are fitted on (those with the smallest hash).
SAMPLE_ROWS = 20_000
BITS = 64
#: Fewest rotations, and the most code bits that all rotations together may have.
ROTATIONS = 3
MOST_BITS = 1024
ITERATIONS = 30
#: Recall wanted for pairs of exactly the threshold, and the pairs drawn to measure it.
RECALL = 0.98
DRAWN_PAIRS = 4000
#: Classes in a bucket that the first substring width aims at.
OCCUPANCY = 32
#: Share of all code bits in which a candidate may differ at least.
RADIUS_SHARE = 1 / 3
CHUNK = 256
#: Places of the table's number and the vector's length in a bucket key.
TABLE_SHIFT = 24
LENGTH_SHIFT = 40
PAIRS = 1 << 18


def fit_itq(x: np.ndarray, bits: int, seed: int, iterations: int = ITERATIONS) -> np.ndarray:
    """Rotation of centred principal coordinates x for which sign codes lose least."""
    r = np.linalg.qr(np.random.default_rng(seed).standard_normal((bits, bits)))[0]
    for _ in range(iterations):
        codes = np.where(x @ r >= 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(codes.T @ x)
        r = (left @ right).T
    return r


def drawn_pairs(unit: np.ndarray, threshold: float, count: int = DRAWN_PAIRS) -> tuple[np.ndarray, np.ndarray]:
    """Unit rows and partners of exactly the threshold cosine: even rows towards other rows, odd ones anywhere."""
    rng = np.random.default_rng(0)
    x, other, third = (unit[rng.integers(len(unit), size=count)] for _ in range(3))
    way = other - third
    way[1::2] = rng.standard_normal(way[1::2].shape)
    way -= (way * x).sum(axis=1, keepdims=True) * x
    size = np.linalg.norm(way, axis=1, keepdims=True)
    c = min(threshold, 1.0)
    return x, np.where(size > 1e-9, c * x + np.sqrt(1 - c * c) * way / np.maximum(size, 1e-9), x)


class ItqModel:
    """Mean and projections of the fitted rotations for vectors of one length: a few small matrices.

    `rows` is the number of classes; up to CHUNK of them are one bucket without codes.
    """

    def __init__(self, sample: np.ndarray, rows: int, threshold: float = THRESHOLD, bits: int = BITS):
        self.maps, self.bits, self.width, self.tables, self.radius = [], 0, 0, 1, 0
        if rows <= CHUNK:
            return
        unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
        held = np.arange(len(unit)) % 10 == 0
        fitted = unit[~held]
        self.mean = fitted.mean(axis=0)
        centred = fitted - self.mean
        _, axes = np.linalg.eigh(centred.T @ centred)
        self.bits = min(bits, sample.shape[1])
        axes = axes[:, ::-1][:, :self.bits]
        x = centred @ axes
        first, second = drawn_pairs(unit[held], threshold)
        maps, differ = [], []

        def rotation(k):
            if k == len(maps):
                m = axes @ fit_itq(x, self.bits, k)
                maps.append(m)
                differ.append(((first - self.mean) @ m >= 0) != ((second - self.mean) @ m >= 0))
            return differ[k]

        most = max(ROTATIONS, MOST_BITS // self.bits)
        start = min(self.bits, TABLE_SHIFT, max(1, int(np.log2(rows / OCCUPANCY))))
        for self.width in range(start, 0, -1):
            per, met = self.bits // self.width, np.zeros(len(first), bool)
            for used in range(1, most + 1):
                parts = rotation(used - 1)[:, :per * self.width].reshape(len(first), per, self.width)
                met |= ~parts.any(axis=2).all(axis=1)
                enough = min(met[::2].mean(), met[1::2].mean()) >= RECALL
                if enough and used >= ROTATIONS:
                    break
            if enough:
                break
        if not enough:  # no tables within MOST_BITS reach the recall: one bucket, every pair compared in tiles
            return
        self.maps, self.tables = maps[:used], used * per
        self.radius = max(int(self.bits * used * RADIUS_SHARE), int(sum(d.sum(axis=1) for d in differ[:used]).max()))

    def codes(self, x: np.ndarray) -> np.ndarray:
        """Boolean code bits, all rotations side by side."""
        if not self.maps:
            return np.zeros((len(x), 0), bool)
        unit = x / np.linalg.norm(x, axis=1, keepdims=True) - self.mean
        return np.hstack([unit @ m >= 0 for m in self.maps])

    def substrings(self, bits: np.ndarray) -> np.ndarray:
        """Keys of the Hamming tables (rows x tables)."""
        if not self.maps:
            return np.zeros((len(bits), 1), np.int32)
        per = self.bits // self.width
        power = 1 << np.arange(self.width, dtype=np.int32)
        return np.stack([bits[:, r * self.bits + s * self.width:r * self.bits + (s + 1) * self.width] @ power
                         for r in range(len(self.maps)) for s in range(per)], axis=1).astype(np.int32)


def storage_type(vectors: DataFrame, column: str) -> str:
    """numpy type in which vectors travel: that of the column's elements (cosines are computed in double)."""
    return "<f4" if dict(vectors.dtypes)[column] == "array<float>" else "<f8"


def vector_rows(vectors: DataFrame, key: str, column: str) -> DataFrame:
    """(k, vec, dim): the raw bytes of each valid vector, NULL for one that links with nothing."""
    kind = storage_type(vectors, column)

    def run(batches):
        for b in batches:
            out, dims = [], []
            for v in b.column(1).to_pylist():
                x = np.array(v, kind) if v and None not in v else np.zeros(0)
                good = bool(len(x)) and bool(np.isfinite(x).all()) and bool(x.any())
                out.append(x.tobytes() if good else None)
                dims.append(len(x) if good else None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary()), pa.array(dims, pa.int32())],
                                             names=["k", "vec", "dim"])
    return vectors.select(key, column).mapInArrow(run, f"k {dict(vectors.dtypes)[key]}, vec binary, dim int")


def stacked(rows: list[bytes], kind: str) -> np.ndarray:
    """Vectors as rows of a double matrix."""
    return np.frombuffer(b"".join(rows), kind).reshape(len(rows), -1).astype(np.float64)


def hamming_rows(classes: DataFrame, shared, kind: str) -> DataFrame:
    """(uid, code, keys): the code of each class, and its bucket in each Hamming table."""
    def run(batches):
        models = shared.value
        for b in batches:
            dim, vecs = b.column("dim").to_numpy(), b.column("vec").to_pylist()
            for d in np.unique(dim):
                at, model = np.nonzero(dim == d)[0], models[int(d)]
                bits = model.codes(stacked([vecs[k] for k in at], kind))
                keys = model.substrings(bits) + (np.arange(model.tables) << TABLE_SHIFT) + (int(d) << LENGTH_SHIFT)
                code = [r.tobytes() for r in np.packbits(bits, axis=1, bitorder="little")]
                yield pa.RecordBatch.from_arrays([b.column("uid").take(pa.array(at)), pa.array(code, pa.binary()),
                                                  pa.array(list(keys), pa.list_(pa.int64()))], names=["uid", "code", "keys"])
    return classes.select("uid", "dim", "vec").mapInArrow(run, "uid long, code binary, keys array<long>")


def task_numbers(spark: SparkSession, parts: int):
    """Column function: the k-th of `parts` numbers that a hash partitioning into `parts` deals to different partitions."""
    found = spark.range(20 * parts + 100).select(F.pmod(F.hash("id"), F.lit(parts)).alias("p"), "id").groupBy("p").agg(F.min("id").alias("id"))
    names = F.array(*[F.lit(r["id"]) for r in found.orderBy("p").collect()])
    return lambda k: F.element_at(names, (F.pmod(k, F.size(names)) + 1).cast("int"))


def compare_buckets(dealt: DataFrame, shared, kind: str, threshold: float) -> DataFrame:
    """(a, b, links): link counts of class a (b NULL), and links a-b that connect each task's groups."""
    def run(batches):
        models = shared.value
        names, parts = ("key", "i", "j", "chunk"), ("uid", "n", "dim")
        cols, tiles, vecs, codes, held = [[] for _ in parts], [[] for _ in names], [], [], []
        for b in batches:
            for c, name in zip(cols, parts):
                c.append(b.column(name).to_numpy())
            flat = b.column("tiles").flatten()
            for c, name in zip(tiles, names):
                c.append(flat.field(name).to_numpy())
            held.append(np.repeat(np.arange(len(vecs), len(vecs) + b.num_rows), b.column("tiles").value_lengths().to_numpy()))
            vecs += b.column("vec").to_pylist()
            codes += b.column("code").to_pylist()
        if not vecs:
            return
        uid, n, dim = (np.concatenate(c) for c in cols)
        key, i, j, chunk = (np.concatenate(c) for c in tiles)
        row = np.concatenate(held)
        links, ends = np.zeros(len(uid), np.int64), []
        for d in np.unique(dim):
            model, mine = models[int(d)], np.nonzero(dim == d)[0]
            x = stacked([vecs[k] for k in mine], kind)
            norm = np.linalg.norm(x, axis=1)
            code = np.frombuffer(b"".join([codes[k] for k in mine]), np.uint8).reshape(len(mine), -1)
            words = np.zeros((len(mine), max(1, -(-code.shape[1] // 8))), "<u8")
            words.view(np.uint8)[:, :code.shape[1]] = code
            strings = model.substrings(np.unpackbits(code, axis=1, bitorder="little")[:, :model.bits * len(model.maps)])
            t = np.nonzero(dim[row] == d)[0]
            t = t[np.lexsort((chunk[t], j[t], i[t], key[t]))]
            inner = np.searchsorted(mine, row[t])
            table = key[t] >> TABLE_SHIFT & (1 << LENGTH_SHIFT - TABLE_SHIFT) - 1
            for p, q in candidates(key[t], i[t], j[t], chunk[t], words, inner, model.radius):
                a, b = inner[p], inner[q]
                at = (strings[a] == strings[b]).argmax(axis=1) == table[p]
                a, b = a[at], b[at]
                near = np.einsum("ij,ij->i", x[a], x[b]) / (norm[a] * norm[b]) >= threshold
                a, b = mine[a[near]], mine[b[near]]
                if len(a):
                    np.add.at(links, a, n[b])
                    np.add.at(links, b, n[a])
                    # classes, not rows: a class may stand in this task more than once
                    ends.append(star_edges(uid[a], uid[b]))
        some = links > 0
        who, at = np.unique(uid[some], return_inverse=True)
        total = np.bincount(at, links[some], len(who)).astype(np.int64)
        if len(who):
            yield pa.RecordBatch.from_arrays([pa.array(who), pa.nulls(len(who), pa.int64()), pa.array(total)], names=["a", "b", "links"])
        if ends:
            a, b = star_edges(np.concatenate([e[0] for e in ends]), np.concatenate([e[1] for e in ends]))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.nulls(len(a), pa.int64())], names=["a", "b", "links"])

    return dealt.mapInArrow(run, "a long, b long, links long")


def candidates(key, i, j, chunk, words, row, radius):
    """Entry pairs of each tile whose rows' codes differ in at most radius bits, in parts of bounded size."""
    n = len(key)
    new = np.ones(n, bool)
    new[1:] = (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
    start = np.nonzero(new)[0]
    tile = np.cumsum(new) - 1
    last = np.append(start[1:], n)[tile]
    cross = i != j
    second = (start + np.bincount(tile[chunk == i], minlength=len(start)))[tile]
    first = np.where(cross, second, np.arange(n) + 1)
    last = np.where(cross & (chunk == j), first, last)
    rows = np.nonzero(last > first)[0]
    size = (last - first)[rows]
    done = np.concatenate([[0], np.cumsum(size)])
    at = 0
    while at < len(rows):
        end = max(at + 1, int(np.searchsorted(done, done[at] + PAIRS, side="right")) - 1)
        a = np.repeat(rows[at:end], size[at:end])
        b = np.arange(len(a)) - np.repeat(done[at:end] - done[at], size[at:end]) + np.repeat(first[rows[at:end]], size[at:end])
        near = np.bitwise_count(words[row[a]] ^ words[row[b]]).sum(axis=1, dtype=np.int32) <= radius
        if near.any():
            yield a[near], b[near]
        at = end


def near_vectors(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", threshold: float = THRESHOLD,
                 sample_rows: int = SAMPLE_ROWS, chunk: int = CHUNK) -> DataFrame:
    """(k, n_links, component) of every row: direct links, and the smallest key reachable by links."""
    spark = vectors.sparkSession
    rows = written(vector_rows(vectors, key, column), "vectors")
    valid = F.col("dim").isNotNull()
    classes = written(rows.where(valid).groupBy("vec", "dim").agg(F.count("*").alias("n"), F.min("k").alias("rep")).withColumn(
        "uid", F.monotonically_increasing_id()), "classes")
    kind, models = storage_type(vectors, column), {}
    for r in classes.groupBy("dim").count().collect():
        sample = [] if r["count"] <= CHUNK else hashed_sample(
            classes.where(F.col("dim") == r["dim"]).select("vec"), sample_rows, "vec").collect()
        models[r["dim"]] = ItqModel(stacked([bytes(x.vec) for x in sample], kind) if sample else None, r["count"], threshold)
    shared = Shared(spark, models)
    coded = written(hamming_rows(classes, shared, kind), "hamming")
    keyed = coded.select("uid", F.explode("keys").alias("key"))
    sizes = written(keyed.groupBy("key").agg(F.count("*").alias("m")).where("m > 1"), "sizes")
    chunked = keyed.join(sizes, "key").withColumn("chunks", F.ceil(F.col("m") / chunk).cast("int")).withColumn(
        "chunk", F.pmod(F.xxhash64("uid"), F.col("chunks")).cast("int"))
    tiles = chunked.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(
        "uid", "key", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "chunk")
    parts = default_partitions(classes)
    numbered = tiles.withColumn("task", task_numbers(spark, parts)(F.xxhash64("key", "i", "j")))
    lists = numbered.groupBy("uid", "task").agg(F.collect_list(F.struct("key", "i", "j", "chunk")).alias("tiles"))
    dealt = lists.join(classes.select("uid", "n", "dim", "vec"), "uid").join(coded.select("uid", "code"), "uid").repartition(parts, "task")
    found = written(compare_buckets(dealt.select("uid", "n", "dim", "vec", "code", "tiles"), shared, kind, threshold), "links")
    labels = label_components(classes.select(F.col("uid").alias("node"), F.col("rep").alias("name")),
                              found.where("b IS NOT NULL").select("a", "b"))
    counts = found.where("b IS NULL").groupBy(F.col("a").alias("u")).agg(F.sum("links").alias("links"))
    result = written(classes.join(labels, F.col("uid") == F.col("node")).join(counts, F.col("uid") == F.col("u"), "left").select(
        F.col("vec").alias("v"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).cast("long").alias("n_links"),
        F.col("label").alias("component")), "classes")
    linked = rows.where(valid).join(result, F.col("vec") == F.col("v")).select("k", "n_links", "component")
    rest = rows.where(~valid).select("k", F.lit(0).cast("long").alias("n_links"), F.col("k").alias("component"))
    return linked.unionByName(rest)


def op3_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract result of near_vectors over all embeddings."""
    found = near_vectors(table(prepare(spark), sf_dir, "embeddings"))
    return found.select(F.col("k").alias("vec_id"), "n_links", F.col("component").cast("long").alias("component_id"),
                        F.coalesce(F.col("k") == F.col("component"), F.lit(True)).alias("kept"))
