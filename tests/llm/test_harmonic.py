"""Harmonic packing: round trip of ids, contract columns, padding, awkward tables."""

import zlib

import numpy as np
import pytest

from llm_fixtures import awkward, documents, save
from tillflow.llm import harmonic as H
from tillflow.llm.tokens import tokenizer_path


def ids_of(texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_path())
    return [np.array([*e.ids, 0], "<u4") for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def padding(fill, capacity):
    return sum(0 if n & (n - 1) == 0 else capacity - n for n in fill)


def check(rows, documents_ids, capacity=1024, most_padding=None):
    """Every id in one piece, gapless documents and sequences; returns the share of padding."""
    docs, seqs = {}, {}
    for r in rows:
        docs.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
        seqs.setdefault(r["sequence_id"], []).append(r)
    for pieces in seqs.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= capacity
    made = sorted((str(r["doc_id"]), r["doc_tokens"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    cuts = H.cut_table(capacity, H.SLACK)
    want = []
    for key, ids in documents_ids:
        at = 0
        for n in (*[capacity] * (len(ids) // capacity), *cuts[len(ids) % capacity]):
            want.append((str(key), len(ids), at, n, zlib.crc32(ids[at:at + n].tobytes())))
            at += n
        assert at == len(ids)
    assert made == sorted(want)
    fill = [sum(r["length"] for r in p) for p in seqs.values()]
    return padding(fill, capacity) / max(1, sum(fill))


def test_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    rows = H.op12_harmonic(spark, "/root/testdata/sf0.01").collect()
    assert list(rows[0].asDict()) == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert check(rows, list(zip([r["doc_id"] for r in docs], ids_of([r["text"] for r in docs])))) < 0.004


@pytest.mark.parametrize("extra", [None, "k, task, number, length, before, all, nth, g"])
def test_awkward_tables(spark, tmp_path, extra):
    rows = awkward() + [(50, "<|endoftext|> a"), (51, "x"), (51, "x")]
    folder = save(documents(spark, rows, extra), tmp_path, "documents")
    got = H.op12_harmonic(spark, folder).collect()
    check(got, list(zip([r[0] for r in rows], ids_of([r[1] for r in rows]))))


def test_empty_table(spark, tmp_path):
    assert H.op12_harmonic(spark, save(documents(spark, []), tmp_path, "documents")).collect() == []


@pytest.mark.parametrize("capacity,slack", [(1024, 4), (1024, 0), (100, 3), (7, 0), (2, 0), (1, 0)])
def test_cut_table_is_least(capacity, slack):
    """Fewest pieces of top lengths, against every combination by breadth-first search."""
    tops = H.top_lengths(capacity, slack)
    assert all(capacity - capacity // n * n <= slack for n in tops) and tops[-1] == 1
    least, level, steps = {0: 0}, {0}, 0
    while level:
        steps += 1
        level = {s + n for s in level for n in tops if s + n < capacity} - set(least)
        least.update((s, steps) for s in level)
    cuts = H.cut_table(capacity, slack)
    assert [sum(c) for c in cuts] == list(range(capacity)) and all(n in tops for c in cuts for n in c)
    assert [len(c) for c in cuts] == [least[r] for r in range(capacity)]


def test_bins_are_filled_over_all_tasks(spark):
    """Full bins hold a fixed number of pieces of one length; only the rest's bins differ."""
    rows = [(i, "palavra " * (i % 37)) for i in range(3000)]
    docs = documents(spark, rows).repartition(13)
    out = H.pack_harmonic(docs, capacity=64, slack=2).collect()
    tops, seqs = H.top_lengths(64, 2), {}
    for r in out:
        seqs.setdefault(r["sequence_id"], []).append(r["length"])
    rest = [s for s, n in seqs.items() if len(set(n)) > 1 or len(n) < 64 // n[0]]
    assert all(s % (len(tops) + 1) == len(tops) for s in rest)
    assert len(rest) <= len(tops) < len(seqs) / 10


def test_ids_travel_on_request(spark):
    docs = documents(spark, [(1, "um dois três"), (2, "quatro " * 3000)])
    want = dict(zip([1, 2], ids_of(["um dois três", "quatro " * 3000])))
    for r in H.pack_harmonic(docs, with_ids=True).collect():
        assert r["ids"] == want[r["doc_id"]][r["start"]:r["start"] + r["length"]].tobytes()
