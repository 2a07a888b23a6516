"""Fits and graph jobs that keep disk, memory and time in proportion."""

import threading

import numpy as np
from pyspark.ml.recommendation import ALS
from pyspark.sql import functions as F

from tabulon import session
from tabulon.operators import ml as ML


def ratings_of(spark):
    return spark.createDataFrame([(u, i, float((u * i) % 5 + 1)) for u in range(30) for i in range(20) if (u + 3 * i) % 4],
                                 "user_id BIGINT, item_id BIGINT, rating DOUBLE")


def test_als_lets_go_of_each_iteration_and_fits_the_same(spark, monkeypatch):
    """the iterations before are cut off by checkpoints. F9: a block is bounded."""
    seen = {}

    def kept(**kw):
        seen.update(kw)
        return ALS(**kw)

    monkeypatch.setattr(ML, "ALS", kept)
    r = ratings_of(spark)
    got = {x["item_id"]: x["features"] for x in ML.factors(ML.als_fit(r, rank=4, max_iter=3, reg=0.1, alpha=2.0), "item", "item_id").collect()}
    assert seen["checkpointInterval"] == 1 and seen["numUserBlocks"] == seen["numItemBlocks"] == 10
    assert spark.sparkContext.getCheckpointDir()
    plain = ALS(rank=4, maxIter=3, regParam=0.1, alpha=2.0, implicitPrefs=True, seed=42, userCol="user_id", itemCol="item_id", ratingCol="rating")
    want = {x["id"]: x["features"] for x in plain.fit(r).itemFactors.collect()}
    assert got.keys() == want.keys()
    for k in want:
        np.testing.assert_allclose(got[k], want[k], rtol=1e-3, atol=1e-5)
    monkeypatch.setattr(ML, "RATINGS_A_BLOCK", 10)
    ML.als_fit(r, rank=2, max_iter=1)
    assert seen["numUserBlocks"] == seen["numItemBlocks"] == -(-r.count() // 10)


def test_swept_asks_the_driver_for_garbage_while_it_lasts(spark, monkeypatch):
    asked = threading.Event()

    class Jvm:
        class System:
            gc = staticmethod(asked.set)

    monkeypatch.setattr(type(spark.sparkContext), "_jvm", Jvm)
    with session.swept(spark, 0.01):
        assert asked.wait(10)
    asked.clear()
    assert not asked.wait(0.1)


def test_trees_share_the_cores_and_keep_the_order(spark):
    """two fits that wait for each other end, which they never did one after the other. F2: a task's statistics are bounded."""
    from tabulon.plans import classify as C

    both = threading.Barrier(2, timeout=60)

    def job(n):
        both.wait()
        return [(n, 0), (n, 1)]

    small = spark.range(0, 1000, 1, 1)  # one task holds the rows
    assert C.in_order(spark, small, [lambda n=n: job(n) for n in (4, 2, 9, 7)]) == [(n, i) for n in (4, 2, 9, 7) for i in (0, 1)]
    assert C.PASSES["maxMemoryInMB"] <= 256


def cliques(spark, n, seed):
    g = np.random.default_rng(seed)
    pairs = {(int(min(x)), int(max(x))) for x in g.integers(0, n, (n * 6, 2)) if x[0] != x[1]}
    return pairs, spark.createDataFrame(sorted(pairs), "src BIGINT, dst BIGINT")


def brute_triangles(pairs, n):
    a = np.zeros((n, n), "int64")
    for x, y in pairs:
        a[x, y] = a[y, x] = 1
    return np.diag(a @ a @ a) // 2


def test_a_list_goes_to_a_row_and_a_column_of_cells(spark, monkeypatch):
    """copies of the out-neighbours grow with the root of the edges, not with the edges."""
    from tabulon.operators import graph as G

    pairs, e = cliques(spark, 60, 5)
    numbers = spark.range(60).select("id", F.col("id").alias("v"))
    monkeypatch.setattr(G, "EDGES_A_CELL", len(pairs) // 25)
    monkeypatch.setattr(G, "WEDGES_AT_ONCE", 7)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")  # lists of a centre lie in two batches
    try:
        got = {r["id"]: r["triangles"] for r in G.triangle_count(numbers, e, numbers, once=True).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = brute_triangles(pairs, 60)
    assert [got[i] for i in range(60)] == want.tolist() and want.sum()


def test_copies_grow_with_the_root_of_the_edges():
    """they grew with the edges."""
    from tabulon.operators import graph as G

    for size in (1, 10**6, 7 * 10**7, 42 * 10**7, 10**10):
        side, slices = G.cell_square(size, 12)
        assert side**2 * G.EDGES_A_CELL >= size and side**2 * slices >= 12
        assert 2 * side - 1 + slices <= 8 + 2 * (size / G.EDGES_A_CELL) ** 0.5


def test_triplets_carry_what_a_join_would_bring(spark):
    """the topics and counts of an edge's ends come with its pair."""
    from tabulon.operators import graph as G

    d = spark.createDataFrame([(x, f"t{y}") for x in range(12) for y in range(9) if (x * y + x) % 3 == 0], "doc_id BIGINT, topic STRING")
    v = d.groupBy(F.md5("topic").alias("id"), "topic").agg(F.count(F.lit(1)).alias("cnt"))
    plain = G.triplets(G.build_edges(G.cooccurrence(d)), v)
    carried = G.triplets(G.build_edges(G.cooccurrence(d.join(v.select("topic", "cnt"), "topic"), carry="cnt")), v.limit(0))
    assert plain.columns == carried.columns
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, carried.collect())) and plain.count()


def test_products_go_document_by_document(spark, monkeypatch):
    """no array of a task holds the products of more than one document (or some 2 MB of them)."""
    from tabulon.operators import text as T

    rng = np.random.default_rng(4)
    a = rng.random((300, 40)) * (rng.random((300, 40)) > 0.4)
    cells = [(i, j, float(a[i, j])) for i in range(300) for j in range(40) if a[i, j]]
    v = T.doc_vectors(spark.createDataFrame(cells, "doc_id BIGINT, term_id INT, w DOUBLE"), "doc_id", "term_id", "w")
    q = rng.random((40, 6))
    assert np.allclose(T.gram_times(v, q), a.T @ (a @ q))
    most = max(len(part) for b in v.toArrow().to_batches() for part, _sizes, _rows in T._products()(b, q))
    assert 1 < most <= 2_000 // 20
