"""BPE against the tokenizers library."""

import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tabulon.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
EDGE = [None, "", " ", "  a\n\n b <|endoftext|> x", "<|endoftext|>", "a" * 5000, "ab" * 3000, " " * 300, "'s'S 'LL don't", "x\x1c\x1d\x85y  z",
        "日本語 \U0001f389 é" * 40, "﻿a�b", "tie tie tie", "tie tie tie"]


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(PATH)


def random_texts(n):
    rnd = random.Random(3)
    pick = [lambda: rnd.randrange(32, 127), lambda: rnd.randrange(128, 0x3000), lambda: rnd.randrange(0x3000, 0xD800),
            lambda: rnd.randrange(0xE000, 0x110000), lambda: rnd.choice([32, 10, 9])]
    return ["".join(chr(rnd.choice(pick)()) for _ in range(60)) for _ in range(n)]


def test_equals_library(reference):
    texts = [t or "" for t in EDGE] + random_texts(400)
    v = bpe.Vocabulary(PATH)
    for t, ids in zip(texts, v.encode(texts)):
        want = reference.encode(t, add_special_tokens=False).ids
        assert ids.tolist() == want
        assert v.decode(ids.tolist()) == reference.decode(want, skip_special_tokens=False)


def test_forgetting_changes_nothing(monkeypatch):
    texts = random_texts(60)
    whole = [x.tolist() for x in bpe.Vocabulary(PATH).encode(texts)]
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    v = bpe.Vocabulary(PATH)
    assert [v.encode([t])[0].tolist() for t in texts] == whole


def test_query_columns(spark, reference):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(EDGE)], "doc_id bigint, text string, ids string")
    out = bpe.bpe_decode(bpe.bpe_encode(df, PATH), PATH).select("doc_id", "ids", *bpe.digests()).collect()
    assert len(out) == len(EDGE)
    for r in out:
        want = reference.encode(EDGE[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(want)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(reference.decode(want, skip_special_tokens=False).encode()).hexdigest()


def test_one_pass_equals_two(spark):
    texts = EDGE + random_texts(60)
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, n_tokens string")
    two = bpe.bpe_decode(bpe.bpe_encode(df.drop("n_tokens"), PATH), PATH).select("doc_id", *bpe.digests()).collect()
    one = bpe.bpe_round_trip(df, lambda: PATH).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, two)) and len(one) == len(texts)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert bpe.bpe_round_trip(df, PATH).count() == 0
    assert bpe.bpe_decode(bpe.bpe_encode(df, PATH), PATH).count() == 0


def test_unknown_ids_are_left_out(spark):
    df = spark.createDataFrame([(1, [64, 10**8, 65]), (2, None)], "doc_id bigint, ids array<int>")
    assert [r["decoded"] for r in bpe.bpe_decode(df, PATH).orderBy("doc_id").collect()] == ["ab", ""]
