"""Cross-tokenizer alignment against a plain walk over both token lists."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from llm_fixtures import awkward, documents, save
from tillflow.llm import align as A
from tillflow.llm.tokens import ByteTokens, PieceTokens, byte_letters, tokenizer_path

BYTES, PIECES = tokenizer_path(), tokenizer_path("piece_bpe_32k.model")


def plain_tokens(texts):
    """[(A ids, B ids, A bytes, B bytes)] by the libraries alone."""
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(BYTES)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    back = {c: x for x, c in byte_letters().items()}
    out = []
    for t in texts:
        if not t:
            out.append(([], [], [], []))
            continue
        ia, ib = a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)
        ba = [bytes(back[c] for c in a.id_to_token(i)) for i in ia]
        bb = [bytes([int(b.id_to_piece(i)[1:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
              for i in ib]
        same = b"".join(ba) == b"".join(bb) == (" " + t).encode()
        out.append((ia, ib, ba, bb) if same else ([], [], [], []))
    return out


def walk(ia, ib, ba, bb):
    """(groups, links) by one walk along both lists."""
    groups, links, i, j, end_a, end_b, ga, gb = [], [], 0, 0, 0, 0, [], []
    if ia:
        end_a, end_b = len(ba[0]), len(bb[0])
        ga, gb = [ia[0]], [ib[0]]
    while i < len(ia) and j < len(ib):
        links.append((ia[i], ib[j]))
        step_a, step_b = end_a <= end_b, end_b <= end_a
        if step_a and step_b:
            groups.append((ga, gb))
            ga, gb = [], []
        if step_a:
            i += 1
            if i < len(ia):
                end_a += len(ba[i])
                ga.append(ia[i])
        if step_b:
            j += 1
            if j < len(ib):
                end_b += len(bb[j])
                gb.append(ib[j])
    return groups, links


def brute(texts):
    found = [(t, *walk(*t)) for t in plain_tokens(texts)]
    count = Counter(x for _, _, links in found for x in links)
    most = {}
    for (_, b), n in count.items():
        most[b] = max(most.get(b, 0), n)
    out = []
    for (ia, ib, _, _), groups, links in found:
        digest = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((len(ia), len(ib), len(groups), len(links), sum(count[x] == most[x[1]] for x in links),
                    sum(count[x] for x in links), hashlib.sha256(digest.encode()).hexdigest() if digest else ""))
    return out


def compare(spark, df, folder):
    rows = df.select("doc_id", "text").collect()
    got = A.op13_align(spark, save(df, folder, "documents")).collect()
    assert got[0].asDict().keys() == {"doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"}
    order = lambda r: (str(r[0]), r[1:])
    want = sorted([(r["doc_id"], *w) for r, w in zip(rows, brute([r["text"] for r in rows]))], key=order)
    assert sorted([tuple(r) for r in got], key=order) == want
    return want


def test_given_table(spark, tmp_path):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = compare(spark, df, tmp_path)
    assert all(w[4] == w[1] + w[2] - w[3] for w in want) and any(w[5] > w[4] / 5 for w in want if w[4])


def test_awkward_texts_many_blocks_and_clashing_columns(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(A, "BLOCK_LINKS", 500)
    rows = awkward() + [(20, "x▁y"), (21, "um  dois\n\n três\t."), (22, "<0x41> <s> </s><|endoftext|>"), (23, " a　b \r\n"),
                        (24, "日本語 の テキスト 한국어 Ελληνικά кириллица"), (25, "😀😀 \U0001f9d1‍\U0001f680"), (26, "\n"), (27, " "),
                        (28, "\x00\x01\x7f"), (29, "é ͅ Ꟑ᷵")]
    rows += [(100 + i, "igual a todos os outros") for i in range(60)]
    want = compare(spark, documents(spark, rows, extra="k, block, links, pairs, number, count, best"), tmp_path)
    zeros = [w for w in want if w[0] == 20]
    assert zeros == [(20, 0, 0, 0, 0, 0, 0, "")]


def test_empty_table(spark, tmp_path):
    assert A.op13_align(spark, save(documents(spark, []), tmp_path, "documents")).collect() == []


def test_groups_are_the_operators_output(spark):
    df = documents(spark, [(1, "Hello wörld, não!"), (2, None)])
    got = {r["doc_id"]: r["groups"] for r in A.align_texts(df, with_groups=True).collect()}
    (ia, ib, ba, bb), = plain_tokens(["Hello wörld, não!"])
    assert [(g["a"], g["b"]) for g in got[1]] == walk(ia, ib, ba, bb)[0] and not got[2]


@pytest.mark.parametrize("seed", range(30))
def test_division_finds_every_shared_cut(seed):
    """Random cuts of several texts, few or many of them shared, long stretches without any."""
    rng = random.Random(seed)
    a, b, want, at = [], [], [], 0
    first = [[0], [0]]
    for _ in range(rng.randint(1, 6)):
        n = rng.choice([0, 1, 2, 5, 40, 400])
        if n:
            share = rng.choice([0.0, 0.02, 0.3, 0.9])
            cuts = [set(), set()]
            for x in range(1, n):
                if rng.random() < share:
                    cuts[0].add(x), cuts[1].add(x)
                elif rng.random() < 0.6:
                    cuts[rng.randint(0, 1)].add(x)
            ends = [sorted(c) + [n] for c in cuts]
            a += [at + x for x in ends[0]]
            b += [at + x for x in ends[1]]
            want += [at + x for x in sorted(set(ends[0]) & set(ends[1]))]
            at += n
        first[0].append(len(a))
        first[1].append(len(b))
    got = A.shared_groups(*[np.array(x, np.int64) for x in (a, b, *first)])
    assert got.tolist() == want


def test_block_numbers_and_counts():
    rng = np.random.default_rng(3)
    block, seen, keys = A.Block(), [], []
    for _ in range(20):
        k = rng.integers(0, 60, rng.integers(0, 50))
        keys += k.tolist()
        seen += block.add(k).tolist()
    pairs, counts = block.rows()
    assert [int(pairs[n]) for n in seen] == keys and dict(zip(pairs.tolist(), counts.tolist())) == dict(Counter(keys))


def test_ids_equal_the_libraries(spark):
    import unicodedata
    from tokenizers import Tokenizer
    texts = [r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    rng = random.Random(1)
    letters = [chr(c) for c in range(0x3200) if unicodedata.category(chr(c)) != "Cs"] + ["가", "힣", "一", "龥", "😀"]
    texts += ["".join(rng.choice(letters) + rng.choice(["", "", " ", "a", "'s", "\n"]) for _ in range(40)) for _ in range(400)]
    texts += ["a <|endoftext|> b", "<|endoftext|>"]
    for plain in (False, True):
        whole = Tokenizer.from_file(BYTES)
        whole.encode_special_tokens = plain
        got = ByteTokens(BYTES, plain=plain).encode(texts)
        assert [g.tolist() for g in got] == [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]
    assert [len(x) for x in PieceTokens(PIECES).encode(["", "a"])] == [0, 1]
