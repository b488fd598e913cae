"""Risk, gradient and prior of the quality classifier against numpy, and its score on a small table."""

import zlib

import numpy as np
import pandas as pd
import pytest

from tillflow.llm import quality as Q

WIDTH = len(Q.FEATURE_NAMES)
SIZE = WIDTH * Q.BINS + 1


def table(spark, x, good, parts):
    rows = [(bytearray(r.astype(np.float32).tobytes()), bool(g)) for r, g in zip(x, good)]
    return spark.createDataFrame(rows, "stats binary, good boolean").repartition(parts)


def active(x, edges):
    """Indicator matrix with an intercept column."""
    out = np.zeros((len(x), SIZE))
    for i, r in enumerate(x.astype(np.float32)):
        for j, v in enumerate(r):
            out[i, j * Q.BINS + int((edges[j] <= v).sum())] = 1
        out[i, -1] = 1
    return out


def plain_sums(z, good, w):
    """(loss gradient, loss, rows) of l(g) on positives, l(-g) on positives, l(-g) on all, by their formulas."""
    g, out = z @ w, []
    for mask, sign in ((good, 1), (good, -1), (np.ones(len(good), bool), -1)):
        m = sign * g[mask]
        slope = -sign / (1 + np.exp(m))
        out.append(np.concatenate([z[mask].T @ slope, [np.log1p(np.exp(-m)).sum(), mask.sum()]]))
    return out


@pytest.mark.parametrize("parts,few", [(3, 64), (9, 2)])
def test_sums_equal_numpy_for_one_model_and_for_halves(spark, monkeypatch, parts, few):
    monkeypatch.setattr(Q, "FEW_TASKS", few)
    rng = np.random.default_rng(parts)
    x = rng.standard_normal((120, WIDTH)).astype(np.float32)
    good = rng.random(120) < 0.4
    edges = np.sort(rng.standard_normal((WIDTH, Q.BINS - 1)), axis=1).astype(np.float32)
    w = [rng.standard_normal(SIZE) * 0.1 for _ in range(2)]
    half = np.array([zlib.crc32(r.tobytes()) & 1 for r in x])
    z, df = active(x, edges), table(spark, x, good, parts)
    cases = [([w[0]], [np.ones(120, bool)]), (w, [half == 0, half == 1])]
    for models, picks in cases:
        for got, pick, weights in zip(Q._sums(df, edges, models), picks, models):
            for k, want in zip(("pos_loss", "pos_neg", "unl_neg"), plain_sums(z[pick], good[pick], weights)):
                np.testing.assert_allclose(got[k], want, rtol=1e-9, atol=1e-9)
    # the gradient is that of the loss
    step = np.zeros(SIZE)
    step[-1] = 1e-5
    up, down = (Q._sums(df, edges, [w[0] + d * step])[0]["pos_loss"] for d in (1, -1))
    assert (up[SIZE] - down[SIZE]) / 2e-5 == pytest.approx(Q._sums(df, edges, [w[0]])[0]["pos_loss"][SIZE - 1], rel=1e-5)


def test_prior_equals_numpy(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((400, WIDTH)).astype(np.float32)
    good = rng.random(400) < 0.3
    edges = np.quantile(x, np.linspace(0, 1, Q.BINS + 1)[1:-1], axis=0).T.astype(np.float32)
    w = [rng.standard_normal(SIZE) * 0.2 for _ in range(2)]
    half = np.array([zlib.crc32(r.tobytes()) & 1 for r in x])
    z = active(x, edges)
    score = 1 / (1 + np.exp(-np.where(half == 0, z @ w[1], z @ w[0])))
    at = np.minimum((score * Q.SCORE_BINS).astype(int), Q.SCORE_BINS - 1)
    spread = [np.sqrt(np.log(40) / (2 * n)) for n in (400, good.sum())]
    options = []
    for cut in range(Q.SCORE_BINS - 1, -1, -1):
        u, p = (at >= cut).mean(), (at[good] >= cut).mean()
        if p > 0:
            options.append(((u + sum(spread)) / p, (u - spread[0]) / p))
    want = min(options, key=lambda o: o[0])[1]
    assert Q.estimate_prior(table(spark, x, good, 4), edges, w) == pytest.approx(np.clip(want, 0.05, 0.95), abs=1e-9)


def test_small_given_table(spark):
    """1,000 documents: good ones of the held-out fold pass the contract's cut, and the score orders both classes."""
    found = Q.op2_quality(spark, "/root/testdata/sf0.01").toPandas()
    labels = pd.read_parquet("/root/testdata/sf0.01/labels.parquet").dropna(subset=["quality"])
    m = found[found.held_out].merge(labels, on="doc_id")
    good, bad = m[m.quality == 1], m[m.quality == 0]
    assert (good.predicted == 1).mean() >= 0.85
    assert (good.score.values[:, None] > bad.score.values[None, :]).mean() >= 0.9
    assert (m.predicted == m.quality).mean() >= 0.8
