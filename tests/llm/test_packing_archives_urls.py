"""Packing, WARC archives, URL filters and the pipeline."""

import hashlib
import random
import re
import zlib
from itertools import combinations

import numpy as np
import pytest
from llm_fixtures import awkward, documents, save
from pyspark.sql import functions as F

import corpus_pipeline
from tillflow.llm import packing as P
from tillflow.llm import urls as U
from tillflow.llm import warc as W
from tillflow.session import scratch_path

SF = "/root/testdata/sf0.001"


# ------------------------------------------------------------------- packing

@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(P.tokenizer_path())
    t.encode_special_tokens = True
    return t


def test_word_tokenizer_equals_whole_encoding(tokenizer):
    rng = random.Random(1)
    parts = ["a", " ", "Word", "ñé", "?!", "ª", "²", "x.", "  ", "\n", "Olá,", "it's", "<|endoftext|>", "12", "\u00a0", "中文", "\x1c", "!!", "\t", "é's"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(0, 30))) for _ in range(400)] + ["", " ", "a b", " a"]
    got = P.WordTokenizer(P.tokenizer_path()).encode(texts)
    for t, ids in zip(texts, got):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def test_fullest_equals_exhaustive_search():
    rng = random.Random(2)
    for _ in range(200):
        lengths = [rng.randrange(1, 30) for _ in range(rng.randrange(1, 9))]
        seed = rng.randrange(1, 40)
        counts = {n: lengths.count(n) for n in lengths}
        got = P.fullest(seed, counts, sorted(counts, reverse=True), 50)
        best = max(sum(c) for k in range(len(lengths) + 1) for c in combinations(lengths, k) if sum(c) <= 50 - seed)
        assert sum(got) == best and all(got.count(n) <= counts[n] for n in got)


def check_packing(rows, docs, tokenizer, capacity):
    ids = {}
    for i, t in docs:
        ids.setdefault(i, []).append([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0])
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        whole = [x for x in ids[r["doc_id"]]
                 if zlib.crc32(np.array(x[r["start"]:r["start"] + r["length"]], "<u4").tobytes()) == r["ids_crc32"]]
        assert whole and (r["piece"] == 0 or r["length"] == capacity)
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(len(x) for v in ids.values() for x in v)
    assert sum(r["length"] for r in rows) == total
    return len(sequences), -(-total // capacity)


def test_packing_round_trip(spark, tokenizer):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()] + awkward(3000)
    rows = P.pack_documents(documents(spark, docs, extra="uid, g, length")).collect()
    used, bound = check_packing(rows, docs, tokenizer, P.CAPACITY)
    assert used <= bound + 2
    # many small groups cost at most about a bin each
    pieces = P.tokenized_pieces(documents(spark, docs), P.tokenizer_path())
    many = P.pack_pieces(pieces, group_pieces=40).collect()
    groups = -(-pieces.where(F.col("length") < P.CAPACITY).count() // 40)
    assert len({r["sequence_id"] for r in many}) <= bound + 2 * groups
    assert P.pack_documents(documents(spark, [])).count() == 0


def test_pieces():
    ids = lambda n: b"\0\0\0\0" * n
    assert P.pieces_of(ids(5), 5) == [(0, 5)]
    assert P.pieces_of(ids(11), 5) == [(0, 1), (1, 5), (6, 5)]
    assert P.pieces_of(ids(10), 5) == [(0, 5), (5, 5)]


# ---------------------------------------------------------------------- warc

def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest string")


def test_archives_round_trip(spark, tmp_path):
    big = "ä<b>" * 20_000
    rows = [(1, "http://a/", "x" * 2000), (2, "http://b/\r\nWARC/1.1", "x" * 2000), (9, None, "x" * 2000), (3, "u", "y" * 999),
            (4, "u", "y" * 999), (5, "u", None), (6, "u", ""), (7, "u", big), (8, "u", big), (None, "u", "x" * 2000),
            (10, "u", "WARC/1.1\r\nContent-Length: 5\r\n\r\n0\r\n\r\n" * 100), (11, "u", "z" * 60_000), (11, "u", "z" * 60_000)]
    save(pages(spark, [(*r, "clash") for r in rows]), tmp_path, "pages")
    found = W.op8_warc(spark, str(tmp_path)).collect()
    assert all(r["intact"] for r in found)
    got = sorted((str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], str(r["refers_to"])) for r in found)
    largest = {}
    for i, _, h in rows:
        if i is not None:
            largest[h] = max(largest.get(h, i), i)
    want = []
    for i, _, h in rows:
        b = (h or "").encode()
        back = i is not None and len(b) >= 1000 and largest[h] != i
        want.append((str(i), len(b), hashlib.sha1(b).hexdigest(), "revisit" if back else "response", str(largest[h] if back else None)))
    assert got == sorted(want)


def test_archives_of_no_pages(spark, tmp_path):
    save(pages(spark, []), tmp_path, "pages")
    assert W.op8_warc(spark, str(tmp_path)).count() == 0


def test_segments_are_verified():
    block = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n" + W.chunked(b"abc" * 100, 7)
    parts = [{"segment": k + 1, "total": None, "block": block[at:at + 50]} for k, at in enumerate(range(0, len(block), 50))]
    parts[-1]["total"] = len(block)
    random.Random(0).shuffle(parts)
    assert W.decoded(W.reassemble(parts)) == W.decoded(block)
    assert W.reassemble(parts + parts) == block                                # repeated segments
    assert W.reassemble([p for p in parts if p["segment"] != 2]) is None       # one is missing
    assert W.reassemble([{**p, "total": p["total"] and p["total"] + 1} for p in parts]) is None
    assert W.reassemble([{**p, "total": None} for p in parts]) is None
    assert W.reassemble(parts + [{**parts[0], "block": b"?"}]) is None


def test_chunked_framing():
    assert W.dechunked(b"4;x=1\r\nWiki\r\n0\r\nTrailer: 1\r\n\r\n") == b"Wiki"
    for n in (0, 1, 4095, 4096, 4097):
        assert W.dechunked(W.chunked(b"q" * n)) == b"q" * n
    with pytest.raises(ValueError):
        W.dechunked(b"9\r\nshort\r\n0\r\n\r\n")


def test_records_survive_any_read_size():
    import gzip
    records = b"".join(r + b"\r\n" for i in range(5) for r in W.page_records(i, "u", b"p" * 40_000, "00" * 20, None))
    data = gzip.compress(records[:30_000]) + gzip.compress(records[30_000:])
    for step in (100, 1 << 20):
        found = list(W.parse_records(W.inflate(data, step)))
        assert len(found) == 15 and sum(f["warc-type"] == "response" for f, _ in found) == 5
    with pytest.raises(ValueError):
        list(W.parse_records([records[:-10]]))


# ---------------------------------------------------------------------- urls

URLS = ["HTTP://A.Net/x", "http://x.example.net/en/1?q", "http://example.net/en", "http://example.com/de/9#a", "http://b.org/fr/",
        "http://notnet/fr", "https://sub.b.ORG/fr/x?y", "ftp://org", "mailto:x", "", None, "http://É.net/é", "://net/", "a://b://c/d",
        "http://example.com?/de/", "http://u.net/\n/x", "http://net"]


def brute_rule(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = []
    for rule, verdict in U.RULES:
        domain, _, rest = rule.partition("/")
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + rest):
            fits.append((len(rule), rule, verdict))
    return host, path, *(max(fits)[1:] if fits else (None, None))


def test_rules_equal_brute_force(spark):
    df = spark.createDataFrame([(i, u, 1) for i, u in enumerate(URLS)] + [(None, URLS[0], 1)], "page_id long, url string, host long")
    got = {r["page_id"]: r for r in U.filter_urls(df).collect()}
    assert len(got) == len(URLS) + 1
    for i, u in enumerate(URLS):
        host, path, rule, verdict = brute_rule(u)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule), u
        assert got[i]["verdict"] == (verdict or "allow")
    assert U.filter_urls(df.where("false")).count() == 0


def test_template_tree_generalises_and_rejects(spark):
    rows, labels = [], []
    for i in range(300):
        rows.append((i, f"http://h.xyz/shop/item{i}/buy"))
        rows.append((1000 + i, f"http://h.xyz/news/slug-{chr(97 + i % 26)}{chr(97 + i // 26)}"))
        if i % 2:
            labels.append((f"http://h.xyz/shop/item{i}/buy", "block"))
            labels.append((f"http://h.xyz/news/slug-{chr(97 + i % 26)}{chr(97 + i // 26)}", "allow"))
    df = spark.createDataFrame(rows, "page_id long, url string")
    found = {r["page_id"]: r for r in U.filter_urls(df, labels=spark.createDataFrame(labels, "url string, label string")).collect()}
    assert {found[i]["template"] for i in range(300)} == {"/shop/item<n>/buy"}
    assert {found[1000 + i]["template"] for i in range(300)} == {"/news/*"}
    assert {found[i]["verdict"] for i in range(300)} == {"block"}
    assert {found[1000 + i]["verdict"] for i in range(300)} == {"allow"}


def test_similar_branches_merge(spark):
    rows = [(100 * b + i, f"http://h.xyz/{lang}/{tail}") for b, lang in enumerate(["en", "de", "fr"])
            for i, tail in enumerate(["a/1", "b/2", "c/3"] * 10)]
    rows += [(1000 + i, "http://h.xyz/admin/login") for i in range(30)]
    found = U.filter_urls(spark.createDataFrame(rows, "page_id long, url string")).collect()
    names = {r["template"].split("/")[1] for r in found if r["page_id"] < 1000}
    assert names in ({"{}"}, {"en", "de", "fr"})
    assert {r["template"] for r in found if r["page_id"] >= 1000} == {"/admin/login"}


# ------------------------------------------------------------------ pipeline

def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = scratch_path(spark, f"pipe-{random.random()}")
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert docs.count() <= before
        before = docs.count()
    assert 100 < before < 200
    out = corpus_pipeline.run(spark, SF)
    assert out.select("doc_id").distinct().count() == before


def test_stages_on_awkward_rows(spark, tmp_path):
    labels = spark.createDataFrame([(None, 1, 1), (4, 1, 0)], "doc_id long, quality int, toxic int")
    save(labels, tmp_path, "labels")
    save(spark.createDataFrame([(None, None), (1, "um dois tres quatro cinco")], "item_id long, text string"), tmp_path, "benchmark")
    for rows in (awkward(500), []):
        save(documents(spark, rows, extra="h, found, toxicity"), tmp_path, "documents")
        out = corpus_pipeline.run(spark, str(tmp_path)).collect()
        # NULL, empty and blank texts share a fingerprint; so do the copies of a text
        assert len({(r["doc_id"], r["piece"]) for r in out}) == len(out)
        assert {r["doc_id"] for r in out} == ({1, 4, 6, 7, None} if rows else set())
