"""Hard negatives against a brute-force search."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tabulon.llm import negatives
from tabulon.llm.negatives import hard_negatives

TYPE = "vec_id bigint, label int, embedding array<float>"


def brute(rows, positives=5, k=5, share=(80, 100), every=100):
    best = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        best[i] = min(best.get(i, (str(label), v)), (str(label), v))
    q = {i: (label, [math.floor(256 * x) for x in v]) for i, (label, v) in best.items()}
    out = set()
    for a in (i for i in q if i % every == 0):
        sc = {i: sum(x * y for x, y in zip(q[a][1], v)) for i, (_, v) in q.items() if i != a}
        same = sorted((i for i in sc if q[i][0] == q[a][0]), key=lambda i: (-sc[i], i))[:positives]
        for p in same:
            found = sorted((i for i in sc if q[i][0] != q[a][0] and share[0] * sc[p] <= share[1] * sc[i] <= share[1] * sc[p]),
                           key=lambda i: (-sc[i], i))[:k]
            out |= {(a, p, n, i, sc[p], sc[i]) for n, i in enumerate(found, 1)}
    return out


def found(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def sample(n, dim, seed, values=None):
    r = random.Random(seed)
    pick = (lambda: r.choice(values)) if values else (lambda: r.uniform(-1, 1))
    return [(i, r.randint(0, 3), [pick() for _ in range(dim)]) for i in range(n)]


@pytest.mark.parametrize("rows", [sample(700, 6, 1), sample(500, 3, 2, [0.0, 0.25, 0.5]), sample(400, 2, 3, [-0.5, 0.5])])
def test_equals_brute_force(spark, rows):
    got = found(hard_negatives(spark.createDataFrame(rows, TYPE).repartition(5)))
    as_float = [tuple(r) for r in spark.createDataFrame(rows, TYPE).collect()]
    assert got == brute(as_float) and got


def test_blocks_and_many_tasks(spark, monkeypatch):
    rows = sample(900, 4, 5, [0.1, 0.2, 0.3, 0.7])
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 20)
    monkeypatch.setattr(negatives, "PART_ROWS", 70)
    df = spark.createDataFrame(rows, TYPE)
    got = found(hard_negatives(df, anchor=F.col("vec_id") % 10 == 0, positives=3, negatives=2, share=(50, 100)))
    assert got == brute([tuple(r) for r in df.collect()], 3, 2, (50, 100), 10) and got


def test_one_vector_in_a_third_of_the_rows(spark):
    rows = sample(900, 4, 7)
    rows = [(i, label, [0.5, 0.5, 0.5, 0.5] if i % 3 == 0 else v) for i, label, v in rows]
    df = spark.createDataFrame(rows, TYPE)
    assert found(hard_negatives(df)) == brute([tuple(r) for r in df.collect()])


def test_edges(spark):
    v = [1.0, 0.5]
    rows = [(0, 1, v), (0, 1, v), (1, 1, v), (2, 2, v), (2, 2, v), (3, 2, [0.9, 0.5]), (None, 1, v), (4, None, v), (5, 2, None),
            (6, 2, [None, 1.0]), (7, 2, [float("nan"), 1.0]), (8, 2, [float("inf"), 1.0]), (9, 2, []), (10, 2, [1.0]), (11, 2, [1.0, 0.5, 9.0]),
            (100, 3, v), (200, 1, [1e30, 1e30]), (300, 1, [-1.0, -1.0])]
    df = spark.createDataFrame(rows, TYPE).withColumn("r", F.lit(1)).withColumn("score", F.lit("x")).withColumn("id", F.lit(2))
    got = found(hard_negatives(df))
    small = [tuple(r) for r in df.select("vec_id", "label", "embedding").collect()]
    want = brute(small)
    cap = negatives.LIMIT
    assert got == {(*r[:4], min(r[4], cap), min(r[5], cap)) for r in want if max(r[4], r[5]) < cap} | {r for r in got if max(r[4], r[5]) >= cap}
    assert {r[:4] for r in got if r[0] == 0 and r[4] < cap} == {r[:4] for r in want if r[0] == 0 and r[4] < cap}
    assert hard_negatives(df.where("false")).collect() == []
    assert hard_negatives(df.where("vec_id = 100")).collect() == []
    with pytest.raises(ValueError):
        hard_negatives(df, share=(101, 100))


def test_exact_in_every_type():
    import numpy as np
    for size in (1.0, 1e5, 1e9):
        a, b = np.floor(np.random.default_rng(1).normal(size=(3, 5)) * size * 256), np.floor(np.random.default_rng(2).normal(size=(4, 5)) * size * 256)
        want = [[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a]
        assert [[max(-negatives.LIMIT, min(negatives.LIMIT, w)) for w in r] for r in want] == [[int(x) for x in r] for r in negatives.scores(a, b)]
