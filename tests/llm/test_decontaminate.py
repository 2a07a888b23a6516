"""Decontamination against brute force."""

import random
import re

import pytest

from tabulon.llm.decontaminate import decontaminate

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, bench):
    windows = {}
    for i, t in bench:
        w = words(t)
        if 0 < len(w) < 10:
            windows.setdefault(tuple(w), set()).add(i)
        for k in range(len(w) - 9):
            windows.setdefault(tuple(w[k:k + 10]), set()).add(i)
    out = []
    for d, t in docs:
        w, hit, items = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if got := windows.get(tuple(w[k:k + n])):
                    hit |= set(range(k, k + n))
                    items |= got
        out.append((d, len(w), len(hit), sorted(str(x) for x in items if x is not None), bool(hit)))
    return out


def case():
    rnd = random.Random(1)
    vocab = [f"w{i}" for i in range(400)] + ["Été", "été", "K", "K"]
    text = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    bench = [(i, text(rnd.randrange(10, 60))) for i in range(12)] + [(20, "Short item, only FIVE words"), (21, "x1"), (22, ""), (23, None), (24, text(10)), (None, text(15))]
    bench += [(30, bench[0][1]), (31, bench[0][1][:80])]
    docs = [(i, text(rnd.randrange(0, 80))) for i in range(40)]
    for k, (_, t) in enumerate(bench[:12]):
        w = words(t)
        a = rnd.randrange(0, max(1, len(w) - 10))
        docs.append((100 + k, text(20) + " ~ " + ", ".join(w[a:a + rnd.choice([8, 9, 10, 11, 30])]).upper().replace("É", "é") + "! " + text(9)))
    docs += [(200, "we say short ITEM only-five words here and x1 x1"), (201, None), (202, ""), (203, "..."), (204, " ".join(words(bench[3][1]) * 40)), (205, text(3000)),
             (206, "É" + bench[1][1]), (207, bench[2][1]), (207, bench[4][1]), (208, bench[2][1]), (208, bench[2][1]), (None, bench[5][1])]
    return docs, bench


@pytest.mark.parametrize("rows", ["all", "no_bench", "no_docs", "long_only"])
def test_equals_brute_force(spark, rows):
    docs, bench = case()
    bench = [] if rows == "no_bench" else [b for b in bench if len(words(b[1])) >= 10] if rows == "long_only" else bench
    docs = [] if rows == "no_docs" else docs
    d = spark.createDataFrame([(*x, 7) for x in docs], "doc_id bigint, text string, item_id int")
    b = spark.createDataFrame([(*x, "z") for x in bench], "item_id bigint, text string, doc_id string")
    out = decontaminate(d, b).select("doc_id", "n_words", "n_hit", "item_ids", "contaminated").collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    assert sorted([tuple(r) for r in out], key=key) == sorted(brute(docs, bench), key=key)


def test_letters_beyond_ascii_are_left_alone(spark):
    """Final sigma, dotted I and the Kelvin sign: only A-Z is lower-cased, so
    words agree wherever their letters do, whatever separates them."""
    bench = [(1, "\u039f\u0394\u039f\u03a3 \u0391\u0392\u0393"), (2, "\u0130x KEL\u212a"), (3, "\u039f\u0394\u039f\u03a3 " + " ".join(f"w{i}" for i in range(9)))]
    docs = [(i, f"A {m}\u039f\u0394\u039f\u03a3{m}\u0391\u0392\u0393{m} z") for i, m in enumerate(["'", ":", " ", "--"])]
    docs += [(10, "\u0130X'kel\u212a"), (11, "i\u0307x kelk"), (12, "\u039f\u0394\u039f\u03c3 \u0391\u0392\u0393"),
             (13, "\u039f\u0394\u039f\u03a3'" + "'".join(f"W{i}" for i in range(9)))]
    out = decontaminate(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(bench, "item_id bigint, text string"))
    got = sorted(tuple(r) for r in out.select("doc_id", "n_words", "n_hit", "item_ids", "contaminated").collect())
    assert got == sorted(brute(docs, bench)) and [r[2] for r in got] == [2, 2, 2, 2, 2, 0, 0, 10]


def test_without_broadcast(spark, monkeypatch):
    import tabulon.llm.decontaminate as module
    monkeypatch.setattr(module, "BROADCAST_ROWS", 0)
    docs, bench = case()
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    b = spark.createDataFrame(bench, "item_id bigint, text string")
    out = decontaminate(d, b).select("doc_id", "n_words", "n_hit", "item_ids", "contaminated").collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    assert sorted([tuple(r) for r in out], key=key) == sorted(brute(docs, bench), key=key)
