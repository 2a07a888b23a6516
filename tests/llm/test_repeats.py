"""Repeated substrings against a count of all substrings."""

import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabulon.llm import repeats as R


def brute(rows, n):
    seen = collections.Counter()
    for _, t in rows:
        b = (t or "").encode()
        seen.update(b[k:k + n] for k in range(len(b) - n + 1))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - n + 1):
            if seen[b[k:k + n]] > 1:
                gone[k:k + n] = True
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(b) else 0
        out.append((d, len(b), int(gone.sum()), spans, hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest()))
    return out


def check(spark, rows, n, monkeypatch, crowd=None):
    if crowd:
        monkeypatch.setattr(R.repeats, "__defaults__", (*R.repeats.__defaults__[:-1], crowd))
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, at int")
    out = R.remove_repeats(df, length=n).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("h")).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[4])
    assert sorted([tuple(r) for r in out], key=key) == sorted(brute(rows, n), key=key)


@pytest.mark.parametrize("alphabet, n, crowd", [("ab", 12, None), ("abcd", 10, 2), ("ab", 25, 3)])
def test_random(spark, monkeypatch, alphabet, n, crowd):
    rnd = random.Random(n)
    base = ["".join(rnd.choice(alphabet) for _ in range(60)) for _ in range(5)]
    rows = [(i, "".join(rnd.choice(base)[rnd.randrange(30):][:rnd.randrange(5, 30)] + rnd.choice(["", "q", "é"]) for _ in range(rnd.randrange(0, 6)))) for i in range(60)]
    check(spark, rows, n, monkeypatch, crowd)


def test_edges(spark, monkeypatch):
    rnd = random.Random(8)
    text = lambda k: "".join(rnd.choice("abcdefgh é") for _ in range(k))
    p, q = text(700), text(400)
    rows = [(1, None), (2, ""), (3, "x" * 400), (4, "x" * 399), (5, "ab" * 700), (6, p), (7, "é" + p[:500] + q), (8, q + text(50)), (9, p + text(900) + p),
            (10, text(20000)), (11, text(1500)), (11, text(1500)), (12, "z"), (12, "z"), (None, text(600))]
    dup = text(450)
    rows += [(13, dup), (13, dup), (None, q)]
    check(spark, rows, 400, monkeypatch)


@pytest.mark.parametrize("crowd", [None, 1])
def test_strings_with_one_hash_modulo_a_power_of_two(spark, monkeypatch, crowd):
    """Two letters patterns whose difference is a polynomial that vanishes
    modulo 2^64 at every odd base: they are different strings."""
    d = np.array([1])
    for e in [2, *(2 * k for k in range(1, 9) for _ in "ab")]:
        d = np.convolve(d, np.r_[1, np.zeros(e - 1, int), -1])
    assert abs(d).max() < 60 and sum(int(c) * pow(12345678901234567891, i, 1 << 64) for i, c in enumerate(d)) % (1 << 64) == 0
    low = np.maximum(0, -d)
    a, b = ("".join(chr(40 + c) for c in x) for x in (low, low + d))
    rnd = random.Random(21)
    rows = []
    for i in range(8):
        left, right = ("".join(rnd.choice("abcdefgh") for _ in range(900)) for _ in "lr")
        rows += [(2 * i, left + a + right), (2 * i + 1, left + b + right)]
    check(spark, rows, 400, monkeypatch, crowd)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert R.remove_repeats(df).count() == 0


def test_scan_reaches_every_partner():
    """One gram, members that share left and right contexts with different
    partners: the reach is that of the pairs."""
    rnd = random.Random(6)
    rows = sorted(("g" * 8 + "".join(rnd.choice("ab") for _ in range(12)), "".join(rnd.choice("ab") for _ in range(12))) for _ in range(60))
    rows = [(a.encode(), b.encode()) for a, b in rows]
    scan = R.Scan(20)
    scan.run(rows)
    for i, (r, l) in enumerate(rows):
        reach = [(R.common(l, l2), R.common(r, r2)) for j, (r2, l2) in enumerate(rows) if j != i]
        good = [(a, b) for a, b in reach if a + b >= 20]
        assert (scan.left[i], scan.right[i]) == (max([a for a, _ in good], default=0), max([b for _, b in good], default=0))


def test_each_window_is_settled_by_one_anchor(spark):
    """Neighbourhoods hold no byte beyond the windows that their anchors
    settle, and each window of a text lies in exactly one."""
    rnd = random.Random(4)
    n, k = 50, R.gram_size(50)
    texts = ["".join(rnd.choice("abc") for _ in range(3_000)), "ab" * 300, "x" * 200, "abc" * 16 + "ab", "y" * 49]
    df = spark.createDataFrame([(i, 0, t) for i, t in enumerate(texts)], "doc_id bigint, th bigint, text string")
    rows = R.find_anchors(df, n).collect()
    for i, t in enumerate(texts):
        starts = []
        for r in (r for r in rows if r["doc_id"] == i):
            assert 0 <= r["before"] <= n - k and k <= r["after"] <= n
            starts += range(r["at"] - r["before"], r["at"] + r["after"] - n + 1)
        assert sorted(starts) == list(range(len(t) - n + 1))


def test_one_edit_leaves_few_edges(spark):
    """Texts that differ in one byte ship only the neighbourhoods with a
    window that holds it."""
    rnd = random.Random(6)
    text = "".join(rnd.choice("abcdefgh ") for _ in range(20_000))
    rows = [(1, 0, text), (2, 0, text[:10_000] + "#" + text[10_001:])]
    found = R.find_anchors(spark.createDataFrame(rows, "doc_id bigint, th bigint, text string"), 400).collect()
    seen = collections.Counter((r["gram"], r["ctx"]) for r in found)
    alone = [r for r in found if seen[r["gram"], r["ctx"]] == 1]
    assert alone and all(r["at"] - r["before"] <= 10_000 < r["at"] + r["after"] for r in alone)
    assert sum(r["before"] + r["after"] - 399 for r in found) == 2 * 19_601
