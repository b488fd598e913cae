"""Packing: ids are those of the tokenizer as it is read from its file, also for texts that hold its added token."""

import random
import zlib

import numpy as np
from llm_fixtures import documents
from tokenizers import Tokenizer

from tillflow.llm import packing as P

PARTS = ["a", " ", "Word", "ñé", "?!", "  ", "\n", "it's", "<|endoftext|>", "<|endoftext|", "|>", "12", " ", "中文", "x."]


def texts():
    rng = random.Random(4)
    return ["foo <|endoftext|> bar", "<|endoftext|>", " <|endoftext|>x", "<|ENDOFTEXT|>", "", "a b"] + [
        "".join(rng.choice(PARTS) for _ in range(rng.randrange(0, 30))) for _ in range(300)]


def test_words_equal_the_untouched_tokenizer():
    tokenizer = Tokenizer.from_file(P.tokenizer_path())
    got = P.WordTokenizer(P.tokenizer_path(), added=True).encode(texts())
    for t, ids in zip(texts(), got):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def test_packed_ids_equal_the_untouched_tokenizer(spark):
    tokenizer = Tokenizer.from_file(P.tokenizer_path())
    rows = P.pack_documents(documents(spark, list(enumerate(texts())))).collect()
    assert len(rows) == len(texts())
    for r in rows:
        ids = [*tokenizer.encode(texts()[r["doc_id"]], add_special_tokens=False).ids, P.SEPARATOR]
        assert (r["start"], r["length"], r["ids_crc32"]) == (0, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
