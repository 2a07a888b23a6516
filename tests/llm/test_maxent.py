"""Language-model scores: base columns against brute force, probabilities
that sum to one, held-out gain, rare words by the join, edge rows."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabulon.llm import maxent, queries
from tabulon.llm.maxent import Codes, Learner, Reader, fit, history, language_scores, rows_for, score_texts, shares, strung, tokens

SF = "/root/testdata/sf0.001"


def brute_base(rows):
    held = [i is None or zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows]
    told = [[*tokens((t or "").encode()), "end"] for _, t in rows]
    c = Counter(w for h, ws in zip(held, told) for w in ws if not h)
    total = sum(c.values())
    norm = total + 0.1 * (len(c) + 1)
    return [(i, h, len(ws), sum(c[w] > 0 for w in ws), total, sum(math.log10((c[w] + 0.1) / norm) for w in ws))
            for (i, _), h, ws in zip(rows, held, told)]


def same(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert all(g[5] == pytest.approx(w[5], rel=1e-9, abs=1e-9) for g, w in zip(got, want))


def test_query_base_equals_brute_force_and_model_gains(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op13_maxent(spark, SF).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()
    same([tuple(r)[:6] for r in got], brute_base(rows))
    held = [r for r in got if r["held_out"]]
    assert held and sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


@pytest.mark.parametrize("shortlist", [0, 1, 3, 10_000])
def test_rare_words_by_the_join(spark, shortlist):
    r = random.Random(3)
    rows = [(i, " ".join(r.choice(["a", "B", "c", "é", f"w{r.randint(0, 60)}"]) for _ in range(r.randint(0, 30)))) for i in range(120)]
    got = language_scores(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), shortlist=shortlist, bits=8)
    same([tuple(x)[:6] for x in got.collect()], brute_base(rows))


def test_codes_hold_the_unigram_shares():
    w = np.array([5.0, 1, 1, 0.1, 30, 2, 7] * 9)
    codes = Codes(w)
    at, node, digit = codes.events(np.arange(len(w)))
    assert np.bincount(at, codes.bias[node, digit]) == pytest.approx(np.log(w / w.sum()), abs=1e-4)
    assert len({tuple(zip(node[at == i], digit[at == i])) for i in range(len(w))}) == len(w)
    two = Codes(np.array([1.0, 3.0]))
    at, node, digit = two.events(np.array([0, 1]))
    assert np.exp(two.bias[node, digit]) == pytest.approx([0.25, 0.75])


def test_probabilities_sum_to_one():
    """Over all next tokens after a history, rare words shared out by counts."""
    r = np.random.default_rng(1)
    weights = np.concatenate([r.integers(1, 50, 40).astype(float), [7.3, 12.0]])
    codes = Codes(weights)
    table = r.normal(size=(256, maxent.WAYS)).astype(np.float32)
    given = np.array([3, 9, 20])
    total = 0.0
    for leaf in range(len(weights)):
        seq = np.append(given, leaf)
        keys = history(seq, np.zeros(4, np.int64))
        at, node, digit = codes.events(seq[-1:])
        total += shares(table, codes.bias, node, rows_for(keys[:, 3:][:, at], node, 8))[np.arange(len(at)), digit].prod()
    assert total == pytest.approx(1.0, abs=1e-4)


def test_history_stops_at_the_text():
    leaf = np.array([1, 2, 3, 1, 2, 3])
    _, first = strung(leaf, np.array([3, 6]))
    keys = history(leaf, first)
    assert (keys[:, :3] == keys[:, 3:]).all() and len({tuple(k) for k in keys[:, :3].T.tolist()}) == 3


def test_learner_learns_an_order():
    reader = Reader([b"a", b"b", b"c", b"d"])
    _, leaf, ends = reader.batch([b"a b c d"] * 200)
    _, first = strung(leaf, ends)
    keys, codes = history(leaf, first), Codes(np.array([200.0, 200, 200, 200, 0.1, 200]))
    zero = np.zeros((1 << 10, maxent.WAYS), np.float32)
    learner = Learner(zero, np.zeros(1 << 10, np.int64), codes)
    for a in range(0, len(leaf), 50):
        learner.learn(leaf[a:a + 50], keys[:, a:a + 50])
    at, node, digit = codes.events(leaf[:5])

    def chance(w):
        return np.log(shares(w, codes.bias, node, rows_for(keys[:, :5][:, at], node, 10))[np.arange(len(at)), digit]).sum()
    assert chance(learner.w) > chance(zero) + 4
    assert (learner.start == 0).all()


def test_block_updates_equal_plain_sums():
    """Softmaxes are made in chunks that stay in the cache, and the events of
    a row of weights (few, or hundreds) are added in blocks."""
    r = np.random.default_rng(5)
    codes = Codes(r.integers(1, 90, 60).astype(float))
    leaf = np.minimum(r.geometric(0.08, 3_000), 59)
    keys = history(leaf, np.zeros(len(leaf), np.int64))
    learner = Learner(r.normal(size=(1 << 9, maxent.WAYS)).astype(np.float32), np.arange(1 << 9), codes)
    start, squares = learner.w.copy(), learner.squares.copy()
    learner.learn(leaf, keys)
    at, node, digit = codes.events(leaf)
    rows = rows_for(keys[:, at], node, 9)
    z = start[rows].sum(0) + codes.bias[node]
    slope = -np.exp(z) / np.exp(z).sum(1, keepdims=True)
    slope[np.arange(len(at)), digit] += 1
    sums, n = np.zeros(start.shape), np.bincount(rows.ravel(), minlength=1 << 9)
    for x in rows:
        np.add.at(sums, x, slope)
    squares = squares + (sums ** 2).sum(1)
    assert (n > 100).any() and (n == 1).any()
    assert (learner.touched == n).all() and np.allclose(learner.squares, squares, rtol=1e-4)
    assert np.allclose(learner.w, start + learner.rate * sums / np.sqrt(squares)[:, None], atol=1e-4)
    assert len(at) > 2 * maxent.CHUNK >= len(learner.scratch.held["c"])


def test_edges(spark):
    long = "x y z " * 20_000
    rows = [(1, "A a b"), (2, None), (2, None), (3, ""), (4, " \t"), (None, "a b"), (5, long), (6, "é É a"), (6, "é É a"), (7, "end")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for c in ("word", "c", "row", "rare", "known", "round"):
        docs = docs.withColumn(c, F.lit(1))
    got = [tuple(r) for r in language_scores(docs, bits=8).collect()]
    same([r[:6] for r in got], brute_base(rows))
    assert all(r[6] <= 1e-6 for r in got)
    assert language_scores(docs.where("false"), bits=8).collect() == []
    alone = language_scores(docs.where("doc_id is null"), bits=8).collect()
    assert [(r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in alone] == [(True, 3, 0, 0, 0.0, 0.0)]


def test_general_interface(spark):
    docs = spark.createDataFrame([("a", "one two"), ("b", "two one")], "name string, body string")
    model, rare = fit(docs, F.lit(True), "body", bits=6, rounds=1)
    out = score_texts(docs, model, rare, "name", "body")
    assert out.columns == ["doc_id", "n_tokens", "n_known", "base_score", "score"] and out.count() == 2
