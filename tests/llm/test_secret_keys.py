"""Secrets: a private key is found and masked whole, not only its first line."""

import time

from llm_fixtures import documents

from tillflow.llm import secrets as S
from tillflow.session import scratch_path

BODY = ["MIIEowIBAAKCAQEA" + "Zx9/+Q" * 8, "Ab3+" * 16, "k7Qz/w=="]


def key(kind="RSA PRIVATE KEY", end="\n", close=True):
    return end.join([f"-----BEGIN {kind}-----", *BODY, *[f"-----END {kind}-----"] * close])


def test_pem_spans_hold_the_whole_key():
    kinds = ("RSA PRIVATE KEY", "PRIVATE KEY", "EC PRIVATE KEY")
    for k in [key(x, end, close) for x in kinds for end in ("\n", "\r\n", "\\n", " ") for close in (True, False)] + [
            "-----BEGIN RSA PRIVATE KEY-----\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,00FF\n\n" + "\n".join(BODY)]:
        for after in ("", "\nand the text goes on", " fim."):
            spans = [x for x in S.find_secrets(f"ä text {k}{after}") if x[0] == "pem"]
            assert spans == [("pem", 7, 7 + len(k))], (k, after)
    # a first line alone, two keys, and an END line of another kind
    first = "-----BEGIN PRIVATE KEY-----"
    assert S.find_secrets(f"{first} only words\nhere")[0] == ("pem", 0, len(first))
    two = f"{key(close=False)}\n{key()}"
    assert [x[1:] for x in S.find_secrets(two) if x[0] == "pem"] == [
        (0, len(key(close=False))), (len(key(close=False)) + 1, len(two))]
    other = key(close=False) + "\n-----END EC PRIVATE KEY-----"
    assert [x[1:] for x in S.find_secrets(other) if x[0] == "pem"] == [(0, len(key(close=False)))]


def test_long_texts_take_linear_time():
    began = time.time()
    for t in ("-----BEGIN PRIVATE KEY-----" * 20_000, "-----BEGIN PRIVATE KEY-----" + " \n" * 200_000, "-----BEGIN PRIVATE KEY-----\n" + "A" * 500_000):
        S.find_secrets(t)
    assert time.time() - began < 20


def test_masked_documents_hold_no_part_of_the_key(spark):
    docs = documents(spark, [(1, f"antes {key()} depois"), (2, f"antes {key(close=False)}\nmais texto"), (3, "nada"), (4, None)])
    out = {r["doc_id"]: r["text"] for r in S.mask_secrets(docs, scratch_path(spark, "ledger-keys")).collect()}
    assert out == {1: "antes [secret] depois", 2: "antes [secret]\nmais texto", 3: "nada", 4: None}
