"""Quality classifier by positive-unlabelled learning with the non-negative risk.

Trusted positives are documents labelled good; everything else, labelled or
not, is unlabelled web text. For a class prior pi and logistic loss l the risk

    pi * E_pos[l(g)] + max(0, E_unl[l(-g)] - pi * E_pos[l(-g)])

is minimised over an additive model g of binned text statistics, by full-batch
gradient steps: every step is one Spark job over the feature table of all
training rows, whose tasks run side by side; their partial sums are added by a
few tasks before the driver takes them. The class prior is estimated from the
same two samples: two classifiers of trusted against unlabelled rows are fitted
first, each on one half of the rows, and every row is scored by the one that has
not seen it; pi is the smallest ratio of unlabelled to positive mass among the
top scores, with a confidence margin.

Defined cases: NULL and empty texts have the statistics of an empty text.
NULL ids are unlabelled and not held out. An id labelled both ways counts as
good. Without any trusted positive every score is 0.5. Extra columns are
ignored; repeated rows are scored alike.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.llm.common import hashed_sample, held_out, prepare, table, written

FEATURE_NAMES = ("log_bytes", "upper", "digit", "space", "newline", "other_punct", "stop_punct", "non_ascii",
                 "bar", "bang", "word_len", "long_words", "distinct_words", "top_word", "repeat_next",
                 "upper_words", "symbol_words", "lines", "distinct_lines", "line_words", "zstd", "distinct_pairs")
BINS = 16
STEPS_PRIOR, STEPS_RISK = 12, 28
SCORE_BINS = 1000
RATE = 0.4
#: Up to so many tasks send their sums straight to the driver.
FEW_TASKS = 64
RIDGE = 1e-4

_LETTERS = set(range(65, 91)) | set(range(97, 123))
_UPPER = np.array([65 <= c <= 90 for c in range(256)], float)
_DIGIT = np.array([48 <= c <= 57 for c in range(256)], float)
_STOP = np.array([c in b".,;:?'\"()-" for c in range(256)], float)
_PUNCT = np.array([33 <= c < 127 and c not in _LETTERS and not 48 <= c <= 57 and c not in b".,;:?'\"()-|!"
                   for c in range(256)], float)


def text_statistics(text: str | None, squeeze) -> list[float]:
    """The raw statistics of one whole text, by FEATURE_NAMES. squeeze: bytes -> compressed bytes."""
    data = (text or "").encode("utf-8", "surrogatepass")
    n = len(data)
    if not n:
        return [0.0] * len(FEATURE_NAMES)
    hist = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    words = data.split()
    count = max(1, len(words))
    seen = Counter(words)
    pairs = Counter(zip(words, words[1:])) if len(words) > 1 else {}
    lines = [x for x in data.split(b"\n") if x]
    tail = sum(w.rstrip(b".,;:?'\")(").isalnum() or w[:1] >= b"\x80" or w[-1:] >= b"\x80" for w in seen) / max(1, len(seen))
    return [
        np.log1p(n), hist @ _UPPER / n, hist @ _DIGIT / n, hist[32] / n, hist[10] / n, hist @ _PUNCT / n,
        hist @ _STOP / n, hist[128:].sum() / n, hist[124] / n, hist[33] / n,
        sum(map(len, words)) / count, sum(len(w) > 20 for w in seen) / max(1, len(seen)),
        np.log((len(seen) + 1.0) / (count + 1.0)), (max(seen.values()) if seen else 0) / count,
        sum(map(bytes.__eq__, words, words[1:])) / count, sum(w.isupper() for w in seen) / max(1, len(seen)),
        1.0 - tail, np.log1p(len(lines)), len(set(lines)) / max(1, len(lines)), np.log1p(count / max(1, len(lines))),
        len(squeeze(data)) / n, np.log((len(pairs) + 1.0) / (count + 1.0))]


def feature_table(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, stats): float32 statistics of every whole text, the only pass over the texts."""
    width = len(FEATURE_NAMES)

    def run(batches):
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for b in batches:
            x = np.array([text_statistics(t, squeeze) for t in b.column(text).to_pylist()],
                         np.float32).reshape(-1, width)
            yield pa.RecordBatch.from_arrays([b.column(key), pa.array([r.tobytes() for r in x], pa.binary())],
                                             names=["k", "stats"])
    return docs.select(key, text).mapInArrow(run, f"k {dict(docs.dtypes)[key]}, stats binary")


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(-1, len(FEATURE_NAMES))


def bin_edges(features: DataFrame, sample_rows: int = 20_000) -> np.ndarray:
    """Inner bin edges per statistic: quantiles of a key-hash sample of at most sample_rows rows.

    The sample only places the edges; every row takes part in the risk.
    """
    rows = hashed_sample(features.select("stats"), sample_rows, "stats").collect()
    width = len(FEATURE_NAMES)
    if not rows:
        return np.zeros((width, BINS - 1), np.float32)
    x = np.frombuffer(b"".join(bytes(r.stats) for r in rows), np.float32).reshape(-1, width)
    return np.quantile(x, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T.astype(np.float32)


def binned(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Column numbers of the active indicator of each statistic (rows x statistics)."""
    out = np.empty(x.shape, np.int32)
    for j in range(x.shape[1]):
        out[:, j] = np.searchsorted(edges[j], x[:, j], side="right") + j * BINS
    return out


def margins(x, edges, weights):
    """g of each row: intercept plus the weights of its active indicators."""
    return weights[-1] + weights[binned(x, edges)].sum(axis=1)


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def added_up(rows: DataFrame, task_sum: Callable[[Iterator[pa.RecordBatch]], np.ndarray], shape: tuple) -> np.ndarray:
    """Sum over all tasks of task_sum (an array of this shape).

    The tasks run side by side. Their sums are added by about the square root of their number of tasks,
    so few rows reach the driver at every size, and always in the order of the tasks.
    """
    def first(batches):
        got = np.asarray(task_sum(batches), float)
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()),
                                          pa.array([got.tobytes()], pa.binary())], names=["task", "s"])

    def second(batches):
        got = [(k, s) for b in batches for k, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
        if got:
            total = sum((np.frombuffer(s) for _, s in sorted(got)), 0.0)
            yield pa.RecordBatch.from_arrays([pa.array([min(got)[0]], pa.int64()), pa.array([total.tobytes()], pa.binary())],
                                             names=["task", "s"])

    parts = rows.mapInArrow(first, "task long, s binary")
    tasks = rows.rdd.getNumPartitions()
    if tasks > FEW_TASKS:
        parts = parts.repartition(math.ceil(math.sqrt(tasks)), "task").mapInArrow(second, "task long, s binary")
    found = sorted((r.task, bytes(r.s)) for r in parts.collect())
    return sum((np.frombuffer(s) for _, s in found), np.zeros(int(np.prod(shape)))).reshape(shape)


def _half(column) -> np.ndarray:
    """Which half of the rows each belongs to, by its statistics."""
    return np.fromiter((zlib.crc32(s) & 1 for s in column.to_pylist()), np.int64, len(column))


def _sums(rows: DataFrame, edges, weights: list[np.ndarray]) -> list[dict[str, np.ndarray]]:
    """Loss and gradient sums by class, for each model: one model over all rows, or one for each half."""
    size, models = len(FEATURE_NAMES) * BINS + 1, len(weights)

    def run(batches):
        total = np.zeros((models, 3, size + 2))
        for b in batches:
            if not b.num_rows:
                continue
            every = binned(_matrix(b.column("stats")), edges)
            good = np.array(b.column("good").to_pylist(), bool)
            half = _half(b.column("stats")) if models > 1 else np.zeros(len(good), np.int64)
            for m, w in enumerate(weights):
                cols, pos = every[half == m], good[half == m]
                g = w[-1] + w[cols].sum(axis=1)
                # l(g) for positives; l(-g) for positives and for all rows
                for k, (mask, sign) in enumerate(((pos, 1.0), (pos, -1.0), (np.ones(len(pos), bool), -1.0))):
                    if mask.any():
                        gm = sign * g[mask]
                        slope = -sign * _sigmoid(-gm)
                        total[m, k, :size - 1] += np.bincount(cols[mask].ravel(), np.repeat(slope, cols.shape[1]), size - 1)
                        total[m, k, size - 1] += slope.sum()
                        total[m, k, size] += np.logaddexp(0, -gm).sum()
                        total[m, k, size + 1] += mask.sum()
        return total

    total = added_up(rows, run, (models, 3, size + 2))
    return [dict(zip(("pos_loss", "pos_neg", "unl_neg"), t)) for t in total]


class _Adam:
    def __init__(self, size):
        self.m, self.v, self.t = np.zeros(size), np.zeros(size), 0

    def step(self, grad):
        self.t += 1
        self.m = 0.8 * self.m + 0.2 * grad
        self.v = 0.95 * self.v + 0.05 * grad * grad
        return RATE * (self.m / (1 - 0.8 ** self.t)) / (np.sqrt(self.v / (1 - 0.95 ** self.t)) + 1e-8)


def estimate_prior(rows: DataFrame, edges, weights: list[np.ndarray]) -> float:
    """Smallest unlabelled-to-positive ratio of mass above a score, with a deviation margin.

    weights: the models of both halves; a row is scored by that of the other half.
    """
    def run(batches):
        hist = np.zeros((2, SCORE_BINS))
        for b in batches:
            if b.num_rows:
                x, half = _matrix(b.column("stats")), _half(b.column("stats"))
                g = np.where(half == 0, margins(x, edges, weights[1]), margins(x, edges, weights[0]))
                at = np.minimum((_sigmoid(g) * SCORE_BINS).astype(int), SCORE_BINS - 1)
                pos = np.array(b.column("good").to_pylist(), bool)
                hist[0] += np.bincount(at[pos], minlength=SCORE_BINS)
                hist[1] += np.bincount(at, minlength=SCORE_BINS)
        return hist

    hist = added_up(rows, run, (2, SCORE_BINS))
    above = hist[:, ::-1].cumsum(axis=1)
    n_pos, n_unl = above[:, -1]
    p, u = above[0] / n_pos, above[1] / n_unl
    spread_u, spread_p = (np.sqrt(np.log(4 / 0.1) / (2 * n)) for n in (n_unl, n_pos))
    ok = p > 0
    best = int(np.argmin((u[ok] + spread_u + spread_p) / p[ok]))
    # the lower end of what the unlabelled rows tell: a prior above the true one lets every row pass for good
    return float(np.clip((u[ok][best] - spread_u) / p[ok][best], 0.05, 0.95))


def trusted_against_rest(train: DataFrame, edges) -> list[np.ndarray] | None:
    """Weights of a classifier of trusted against unlabelled rows, classes weighing alike, for each half of
    the rows; None where a half has no trusted row."""
    size = len(FEATURE_NAMES) * BINS + 1
    weights, adam = [np.zeros(size), np.zeros(size)], [_Adam(size), _Adam(size)]
    for _ in range(STEPS_PRIOR):
        for m, s in enumerate(_sums(train, edges, weights)):
            if not s["pos_loss"][-1]:
                return None
            grad = 0.5 * s["pos_loss"][:size] / s["pos_loss"][-1] + 0.5 * s["unl_neg"][:size] / s["unl_neg"][-1]
            weights[m] = weights[m] - adam[m].step(grad + RIDGE * weights[m])
    return weights


def fit_quality(train: DataFrame) -> dict:
    """Model (edges, weights, prior) from train(stats, good): all training rows, good marking trusted ones.

    With a single trusted row, or none in a half, the prior cannot be estimated and is 0.5.
    """
    edges = bin_edges(train)
    size = len(FEATURE_NAMES) * BINS + 1
    halves = trusted_against_rest(train, edges)
    prior = estimate_prior(train, edges, halves) if halves else 0.5
    weights, adam, best = np.zeros(size), _Adam(size), None
    for _ in range(STEPS_RISK):
        s, = _sums(train, edges, [weights])
        n_pos, n_unl = s["pos_loss"][-1], s["unl_neg"][-1]
        if not n_pos:
            return {"edges": edges, "weights": None, "prior": None}
        pos, pos_neg, unl = s["pos_loss"] / n_pos, s["pos_neg"] / n_pos, s["unl_neg"] / n_unl
        rest = unl[size] - prior * pos_neg[size]
        risk = prior * pos[size] + max(0.0, rest)
        if best is None or risk < best[0]:
            best = (risk, weights.copy())
        # where the estimated negative risk falls below zero, step back from it
        grad = prior * pos[:size] + (unl[:size] - prior * pos_neg[:size]) if rest >= 0 else \
            prior * pos_neg[:size] - unl[:size]
        weights = weights - adam.step(grad + RIDGE * weights)
    return {"edges": edges, "weights": best[1], "prior": prior}


def score_quality(features: DataFrame, model: dict) -> DataFrame:
    """(k, quality) of every feature row."""
    edges, weights = model["edges"], model["weights"]
    kind = dict(features.dtypes)["k"]

    def run(batches):
        for b in batches:
            if weights is None:
                s = np.full(b.num_rows, 0.5)
            else:
                s = _sigmoid(margins(_matrix(b.column("stats")), edges, weights))
            yield pa.RecordBatch.from_arrays([b.column("k"), pa.array(s, pa.float64())], names=["k", "quality"])
    return features.select("k", "stats").mapInArrow(run, f"k {kind}, quality double")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract digest: quality score of every document; labels learned off the held-out fold."""
    docs = table(prepare(spark), sf_dir, "documents").select("doc_id", "text")
    features = written(feature_table(docs), "stats")
    known = (table(spark, sf_dir, "labels").where("doc_id IS NOT NULL AND quality IS NOT NULL")
             .groupBy(F.col("doc_id").alias("id")).agg((F.max("quality") == 1).alias("label")))
    train = written(features.where(~held_out(F.col("k"))).join(known, F.col("k") == F.col("id"), "left").select(
        "stats", F.coalesce("label", F.lit(False)).alias("good")), "train")
    return score_quality(features, fit_quality(train)).select(
        F.col("k").alias("doc_id"), held_out(F.col("k")).alias("held_out"), F.col("quality").alias("score"),
        (F.col("quality") >= 0.3).cast("int").alias("predicted"))
