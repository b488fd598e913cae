"""SimHash, embeddings, suffix de-duplication and components, against brute force."""

import hashlib
import random

import numpy as np
import xxhash
from llm_fixtures import awkward, documents, save

from tillflow.llm import embeddings as E
from tillflow.llm import simhash as H
from tillflow.llm import suffix_dedup as R
from tillflow.llm.components import connected_components


class Groups:
    def __init__(self, items):
        self.up = {i: i for i in items}

    def find(self, x):
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def link(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


def test_components_equal_union_find(spark):
    rng = random.Random(2)
    for edges in ([(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 60)], [],
                  [(rng.randrange(200), rng.randrange(200)) for _ in range(150)]):
        got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
        nodes = {x for a, b in edges if a != b for x in (a, b)}
        g = Groups(nodes)
        for a, b in edges:
            if a != b:
                g.link(a, b)
        assert got == {x: g.find(x) for x in nodes}


# ------------------------------------------------------------------- simhash

def brute_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in words.replace("\t", " ").replace("\n", " ").replace("\v", " ").replace("\f", " ").replace("\r", " ").split(" ") if w]
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def near_texts(n=120):
    rng = random.Random(7)
    base = [[f"w{rng.randrange(400)}" for _ in range(rng.randrange(1, 250))] for _ in range(n)]
    rows = [" ".join(b) for b in base]
    for b in base[:40]:
        c = list(b)
        for _ in range(rng.randrange(0, 3)):
            c[rng.randrange(len(c))] = "novo"
        rows.append(" ".join(c))
    return list(enumerate(rows, 10))


def brute_components(rows):
    fp = [(i, brute_fingerprint(t)) for i, t in rows]
    g = Groups({f for _, f in fp})
    all_ = sorted({f for _, f in fp})
    for k, a in enumerate(all_):
        for b in all_[k + 1:]:
            if (a ^ b).bit_count() <= 4:
                g.link(a, b)
    least = {}
    for i, f in fp:
        if i is not None:
            r = g.find(f)
            least[r] = min(least.get(r, i), i)
    return sorted((str(i), f"{f:016x}", str(least.get(g.find(f)))) for i, f in fp)


def test_simhash_equals_brute_force(spark, tmp_path, monkeypatch):
    rows = near_texts() + awkward(2000) + [(3000, "A  B\tc\nD e"), (3001, "a b c d E")]
    save(documents(spark, rows, extra="fp, k, h"), tmp_path, "documents")
    got = sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"]))
                 for r in H.op1_simhash(spark, str(tmp_path)).collect())
    assert got == brute_components(rows)
    save(documents(spark, []), tmp_path, "documents")
    assert H.op1_simhash(spark, str(tmp_path)).count() == 0


def test_bit_sliced_distances_equal_popcount():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 2 ** 63, 8, dtype=np.uint64)
    flips = rng.integers(0, 64, (300, 9))
    values = base[rng.integers(0, 8, 300)]
    for k in range(9):
        values = np.where(rng.random(300) < 0.5, values ^ (np.uint64(1) << flips[:, k].astype(np.uint64)), values)
    first, last = np.arange(300) + 1, np.full(300, 300)
    for radius in (0, 1, 4, 7):
        got = {(int(a), int(b)) for x, y in H.linked_rows(values, first, last, radius) for a, b in zip(x, y)}
        assert got == {(i, j) for i in range(300) for j in range(i + 1, 300)
                       if int(values[i] ^ values[j]).bit_count() <= radius}


def test_hot_bucket_in_chunks(spark):
    """Many fingerprints that share most blocks: chunked tiles lose no link."""
    rng = random.Random(9)
    base = rng.getrandbits(63)
    values = {base}
    while len(values) < 300:
        values.add(rng.choice(sorted(values)) ^ 1 << rng.randrange(63))
    values |= {rng.getrandbits(63) for _ in range(200)}
    df = spark.createDataFrame([(v,) for v in sorted(values)], "fp long")
    g = Groups(values)
    for a in values:
        for b in values:
            if a < b and (a ^ b).bit_count() <= 4:
                g.link(a, b)
    want = {x: g.find(x) for x in values}
    for chunk in (16, 512):
        got = {r["node"]: r["root"] for r in connected_components(H.link_fingerprints(df, chunk=chunk)).collect()}
        assert {x: got.get(x, x) for x in values} == want


def test_one_document_of_each_group_stays(spark):
    rows = near_texts(30) + awkward(100) + [(500, "só este texto aqui"), (500, "só este texto aqui")]
    docs = documents(spark, rows, extra="h, root, chosen")
    kept = H.keep_one(docs)
    assert kept.columns == docs.columns and kept.exceptAll(docs).isEmpty()
    found = {(str(r["k"]), r["h"], r["fp"], r["root"]) for r in H.near_duplicates(docs).collect()}
    assert kept.count() == len({x[3] for x in found})
    assert {r["doc_id"] for r in kept.collect()} >= {500, 4, 6, 7}
    assert H.keep_one(documents(spark, [])).count() == 0


# ---------------------------------------------------------------- embeddings

def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def brute_links(rows, threshold=0.9):
    good = [(i, np.array(v, float)) for i, v in rows
            if v and None not in v and np.isfinite(v).all() and any(v) and len(v) == 16]
    unit = np.array([x / np.linalg.norm(x) for _, x in good])
    near = unit @ unit.T >= threshold
    np.fill_diagonal(near, False)
    return [i for i, _ in good], near


def test_embeddings_equal_brute_force(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(5)
    centre = rng.standard_normal((12, 16))
    rows = [(i, [float(np.float32(x)) for x in rng.standard_normal(16)]) for i in range(200)]
    rows += [(1000 + i, [float(np.float32(x)) for x in centre[i % 12] + 0.05 * rng.standard_normal(16)]) for i in range(120)]
    rows += [(2000 + i, rows[0][1]) for i in range(5)]                       # exact copies
    odd = [(3000, None), (3001, []), (3002, [0.0] * 16), (3003, [float("nan")] + [1.0] * 15), (3004, [1.0] * 15),
           (3005, [None] + [1.0] * 15), (None, None)]
    monkeypatch.setattr(E, "CHUNK", 8)
    save(vectors(spark, [(i, v, 1) for i, v in rows + odd]), tmp_path, "embeddings")
    found = E.op3_embeddings(spark, str(tmp_path)).collect()
    assert len(found) == len(rows) + len(odd)
    by = {r["vec_id"]: r for r in found}
    ids, near = brute_links(rows)
    g = Groups(ids)
    for a, b in zip(*np.nonzero(near)):
        g.link(ids[a], ids[b])
    links = sum(by[i]["n_links"] for i in ids)
    assert links <= near.sum() and links >= 0.99 * near.sum()                # none below the threshold, recall
    assert sum(by[i]["component_id"] == g.find(i) for i in ids) >= 0.99 * len(ids)
    assert all(by[i]["kept"] == (by[i]["component_id"] == i) for i in ids)
    assert all((by[i]["n_links"], by[i]["component_id"], by[i]["kept"]) == (0, i, True) for i, _ in odd if i)


def test_embeddings_recall_near_the_threshold(spark, tmp_path):
    """Pairs of cosine 0.9 to 0.95 in 64 dimensions, the hardest to retrieve."""
    rng = np.random.default_rng(6)
    rows = []
    for i in range(400):
        x = rng.standard_normal(64)
        x /= np.linalg.norm(x)
        y = rng.standard_normal(64)
        y -= (x @ y) * x
        c = rng.uniform(0.97, 0.995)
        rows += [(2 * i, x.tolist(), 0), (2 * i + 1, (c * x + np.sqrt(1 - c * c) * y / np.linalg.norm(y)).tolist(), 0)]
    save(vectors(spark, rows), tmp_path, "embeddings")
    found = E.op3_embeddings(spark, str(tmp_path)).collect()
    assert sum(r["n_links"] for r in found) >= 0.9 * 800


def test_embeddings_empty_and_single(spark, tmp_path):
    save(vectors(spark, []), tmp_path, "embeddings")
    assert E.op3_embeddings(spark, str(tmp_path)).count() == 0
    save(vectors(spark, [(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0)]), tmp_path, "embeddings")
    found = E.op3_embeddings(spark, str(tmp_path)).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in found) == \
        [(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False)]


# -------------------------------------------------------------- suffix dedup

def brute_removed(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    seen = {}
    for b in texts:
        for p in range(len(b) - length + 1):
            w = b[p:p + length]
            seen[w] = seen.get(w, 0) + 1
    out = []
    for (i, _), b in zip(rows, texts):
        gone = np.zeros(len(b) + 1, bool)
        for p in range(len(b) - length + 1):
            if seen[b[p:p + length]] > 1:
                gone[p:p + length] = True
        gone = gone[:len(b)]
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((str(i), len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def shared_passages(n=60):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 8)))
    text = lambda k: " ".join(word() for _ in range(k))
    common = [text(60) for _ in range(6)]
    rows = []
    for i in range(n):
        t = text(rng.randrange(5, 200))
        for _ in range(rng.randrange(0, 3)):
            p = rng.choice(common)
            a, b = sorted((rng.randrange(len(p)), rng.randrange(len(p))))
            at = rng.randrange(len(t))
            t = t[:at] + p[a:b] + t[at:]
        rows.append((i, t))
    return rows + [(100, rows[0][1]), (100, rows[0][1]), (101, "ab" * 400), (102, "x" * 199), (103, "x" * 201),
                   (104, rows[5][1][10:])]


def test_suffix_dedup_equals_brute_force(spark, tmp_path, monkeypatch):
    rows = shared_passages() + awkward(300)
    want = brute_removed(rows, 200)
    save(documents(spark, rows, extra="k1, t, spans").repartition(7), tmp_path, "documents")

    def run():
        return sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
                      for r in R.op5_suffix_dedup(spark, str(tmp_path)).collect())
    assert run() == want
    # groups in tiny chunks, and texts hashed in tiny overlapping pieces
    monkeypatch.setattr(R.rank_windows, "__defaults__", (2,))
    monkeypatch.setattr(R, "SEGMENT", 300)
    assert run() == want


def test_suffix_dedup_empty(spark, tmp_path):
    save(documents(spark, []), tmp_path, "documents")
    assert R.op5_suffix_dedup(spark, str(tmp_path)).count() == 0
