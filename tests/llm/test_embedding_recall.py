"""Embeddings: recall of links just above the threshold, and tables with vectors of several lengths."""

import numpy as np
import pytest
from llm_fixtures import save
from test_duplicates import brute_links, vectors

from tillflow.llm import embeddings as E


def planted(pairs, mean, seed, dim=64, low=0.90, high=0.95):
    """Pairs of cosine low to high around a common mean of the given length (deviations have length 1)."""
    rng = np.random.default_rng(seed)
    centre = rng.standard_normal(dim)
    x = rng.standard_normal((pairs, dim))
    x = x / np.linalg.norm(x, axis=1, keepdims=True) + mean * centre / np.linalg.norm(centre)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    way = rng.standard_normal((pairs, dim))
    way -= (way * x).sum(axis=1, keepdims=True) * x
    way /= np.linalg.norm(way, axis=1, keepdims=True)
    c = rng.uniform(low, high, (pairs, 1))
    return x.astype(np.float32), (c * x + np.sqrt(1 - c * c) * way).astype(np.float32), c[:, 0]


def links_of(x):
    """Number of other rows of cosine 0.9 or more, by comparing all."""
    unit = x.astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    return np.concatenate([(unit[k:k + 500] @ unit.T >= E.THRESHOLD).sum(axis=1) - 1 for k in range(0, len(unit), 500)])


@pytest.mark.parametrize("mean", [0, 1, 2])
def test_recall_by_cosine_band(spark, tmp_path, mean):
    x, y, c = planted(3000, mean, 17)
    both = np.concatenate([x, y])
    save(vectors(spark, [(i, v.tolist(), 0) for i, v in enumerate(both)]), tmp_path, "embeddings")
    found = {r["vec_id"]: r["n_links"] for r in E.op3_embeddings(spark, str(tmp_path)).collect()}
    got, want = np.array([found[i] for i in range(len(both))]), links_of(both)
    assert (got <= want).all()
    for low, high in ((0.90, 0.92), (0.92, 0.95)):
        band = np.nonzero((c >= low) & (c < high))[0]
        band = np.concatenate([band, band + len(c)])
        recall = got[band].sum() / want[band].sum()
        print(f"mean {mean}, cosine {low} to {high}: recall {recall:.4f} of {want[band].sum()}")
        assert recall >= 0.95


def test_each_length_is_compared_whole(spark, tmp_path):
    rows = []
    for dim, pairs in ((16, 200), (24, 400), (5, 20)):
        x, y, _ = planted(pairs, 0, dim, dim, 0.95, 0.999)
        rows += [(len(rows) + k, [float(f) for f in v]) for k, v in enumerate(np.concatenate([x, y]))]
    rows += [(9000, [1.0] * 7), (9001, [1.0] * 7), (9002, [1.0] * 8)]
    save(vectors(spark, [(i, v, 1) for i, v in rows]), tmp_path, "embeddings")
    found = {r["vec_id"]: r["n_links"] for r in E.op3_embeddings(spark, str(tmp_path)).collect()}
    assert len(found) == len(rows)
    for dim in (5, 7, 8, 16, 24):
        ids = [i for i, v in rows if len(v) == dim]
        want = links_of(np.array([v for _, v in rows if len(v) == dim], np.float32))
        got = np.array([found[i] for i in ids])
        assert (got <= want).all() and got.sum() >= 0.95 * want.sum()
        if len(ids) <= E.CHUNK:
            assert (got == want).all()


def test_few_vectors_are_compared_whole(spark, tmp_path):
    x, y, _ = planted(100, 2, 3, 16)
    rows = [(i, [float(f) for f in v]) for i, v in enumerate(np.concatenate([x, y]))]
    save(vectors(spark, [(i, v, 1) for i, v in rows]), tmp_path, "embeddings")
    found = {r["vec_id"]: r["n_links"] for r in E.op3_embeddings(spark, str(tmp_path)).collect()}
    ids, near = brute_links(rows)
    assert [found[i] for i in ids] == near.sum(axis=1).tolist()
