"""Periodic runs against a brute-force search."""

import hashlib
import random
import zlib
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabulon.llm import queries
from tabulon.llm.runs import collapse, find_runs, periodic_runs

SF = "/root/testdata/sf0.001"


def brute(words, least=24, exponent=3):
    """Maximal stretches of every period, shortest period first."""
    n, out, seen = len(words), [], set()
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - s >= 2 * q and (s, i + q) not in seen:
                seen.add((s, i + q))
                if i + q - s >= max(least, exponent * q):
                    out.append((s, i + q - s, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=80), st.sampled_from([(2, 2), (4, 2), (6, 3), (24, 3)]))
def test_runs_equal_brute_force(words, limits):
    assert find_runs(words, *limits) == brute(words, *limits)


def test_periodic_and_fibonacci_words():
    r = random.Random(1)
    a, b = "a", "ab"
    while len(b) < 400:
        a, b = b, b + a
    texts = [list(b), ["x"] * 300, list("ab" * 100 + "c" + "ab" * 100), list("abcab" * 30 + "abc" * 20)]
    for _ in range(40):
        p = [r.choice("abcd") for _ in range(r.randint(1, 30))]
        texts.append([r.choice("abcd") for _ in range(r.randint(0, 40))] + (p * 20)[:r.randint(1, 200)] + [r.choice("abcd") for _ in range(r.randint(0, 40))])
    for t in texts:
        for limits in ((24, 3), (4, 2)):
            assert find_runs(t, *limits) == brute(t, *limits)


def test_one_long_run_is_quick():
    assert find_runs(["x"] * 50_000) == [(0, 50_000, 1)]


def rows_of(texts):
    return {r["doc_id"]: r for r in texts.collect()}


def test_edges(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    rep = "one two three " * 12
    data = [(1, None), (2, ""), (3, " \t\n "), (4, rep), (4, rep), (None, rep), (5, long), (6, "é x " * 30), (7, "a b")]
    docs = spark.createDataFrame(data, "doc_id bigint, text string").withColumn("runs", F.lit(9)).withColumn("best", F.lit("x"))
    got = [(r["doc_id"], [tuple(x) for x in r["runs"]], r["best"] and tuple(r["best"]), r["collapsed"]) for r in periodic_runs(docs).collect()]
    three = [(0, 36, 3)]
    want = [(1, [], None, ""), (2, [], None, ""), (3, [], None, ""), (4, three, three[0], "one two three"), (4, three, three[0], "one two three"),
            (None, three, three[0], "one two three"), (5, [], None, long), (6, [(0, 30, 1)], (0, 30, 1), "é x"), (7, [], None, "a b")]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert periodic_runs(docs.where("false")).collect() == []
    with pytest.raises(ValueError):
        periodic_runs(docs, min_exponent=1)


def contract(doc_id, text):
    words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", text or "")]
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = brute(words) if n < 1500 else find_runs(words)
    top = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    return {"n_runs": len(runs), "start": top and top[0], "length": top and top[1], "period": top and top[2],
            "exponent_milli": top and 1000 * top[1] // top[2],
            "runs_sha256": hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
            "collapsed_sha256": hashlib.sha256(" ".join(collapse(words, runs)).encode()).hexdigest()}


def test_query_equals_contract(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = rows_of(queries.op11_runs(spark, SF))
    assert len(got) == len(docs)
    for d in docs:
        want = contract(d["doc_id"], d["text"])
        assert {k: got[d["doc_id"]][k] for k in want} == want
    assert any(r["n_runs"] for r in got.values())
