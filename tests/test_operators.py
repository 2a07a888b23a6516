"""Point-in-polygon, evaluation, sampling, text and model invariants."""

import numpy as np

from conftest import SF001
from pyspark.sql import functions as F

from tabulon.operators import evaluate as EV
from tabulon.operators import ml as ML
from tabulon.operators.geo import point_in_polygon
from tabulon.operators.sampling import random_split, sample_negatives
from tabulon.plans import fixtures as fx


def test_point_in_polygon_priority_and_misses(spark):
    pts = spark.createDataFrame([(1, 2.0, 2.0), (2, 0.5, 9.5), (3, 7.0, 1.0), (4, 6.0, 7.5), (5, 8.5, 8.5),
                                 (6, 4.5, 4.5), (7, 6.9, 8.6)], "id INT, lon DOUBLE, lat DOUBLE")
    r = point_in_polygon(pts, "lon", "lat", fx.regions(spark), [F.col("code"), -F.col("area")])
    got = {x["id"]: x["region"] for x in r.collect()}
    assert got == {1: "west", 2: "west", 3: "triangle", 4: "ell", 5: "ell", 6: None, 7: None}
    for cell in (None, 0.3, 7.0):
        r2 = point_in_polygon(pts, "lon", "lat", fx.regions(spark), [F.col("code"), -F.col("area")], cell=cell)
        assert {x["id"]: x["region"] for x in r2.collect()} == got


def test_ranking_auc_ties_are_not_wins(spark):
    pos = spark.createDataFrame([(1, 0.9), (1, 0.5), (2, 0.3)], "user_id INT, score DOUBLE")
    neg = spark.createDataFrame([(1, 0.5), (1, 0.1), (3, 0.2)], "user_id INT, score DOUBLE")
    per = {r["user_id"]: r["auc"] for r in EV.ranking_auc(pos, neg).collect()}
    assert per == {1: 0.75}  # pairs: .9>.5, .9>.1, .5=.5 (no), .5>.1


def test_entropy_counts_labels_not_runs(spark):
    df = spark.createDataFrame([(0, "a"), (0, "b"), (0, "a"), (1, "c")], "cluster INT, label STRING")
    e = EV.cluster_label_entropy(df).first()[0]
    p = np.array([2 / 3, 1 / 3])
    assert abs(e - 3 * -(p * np.log(p)).sum() / 4) < 1e-12


def test_standardize_zero_stdev_only_centres(spark):
    df = spark.createDataFrame([([1.0, 5.0],), ([3.0, 5.0],)], "x ARRAY<DOUBLE>")
    m, s = ML.column_moments_literal(df, "x")
    assert m == [2.0, 5.0] and s == [1.0, 0.0]
    got = sorted(r[0] for r in df.select(ML.standardize("x", m, s)).collect())
    assert got == [[-1.0, 0.0], [1.0, 0.0]]


def test_cluster_assign_ties_lowest_index(spark):
    df = spark.createDataFrame([([0.0, 0.0],), ([2.0, 0.0],)], "x ARRAY<DOUBLE>")
    a = ML.cluster_assign(df, "x", [[1.0, 0.0], [1.0, 0.0], [5.0, 5.0]]).collect()
    assert [r["cluster"] for r in a] == [0, 0] and all(r["distance"] == 1.0 for r in a)


def test_split_is_deterministic_and_weighted(spark):
    df = spark.range(20000).withColumnRenamed("id", "k")
    a = random_split(df, [0.8, 0.1, 0.1], 3, ["k"]).groupBy("part").count().collect()
    shares = {r["part"]: r["count"] / 20000 for r in a}
    assert abs(shares[0] - 0.8) < 0.02 and abs(shares[1] - 0.1) < 0.02
    b = random_split(df.repartition(7), [0.8, 0.1, 0.1], 3, ["k"])
    c = random_split(df.repartition(2), [0.8, 0.1, 0.1], 3, ["k"])
    assert sorted(map(tuple, b.collect())) == sorted(map(tuple, c.collect()))


def test_negatives_avoid_positives_and_match_counts(spark):
    pos = spark.createDataFrame([(1, i) for i in range(5)] + [(2, 3)], "user_id BIGINT, item_id BIGINT")
    items = spark.createDataFrame([(i,) for i in range(8)], "item_id BIGINT")
    neg = sample_negatives(pos, items, 11).collect()
    by_user = {}
    for r in neg:
        by_user.setdefault(r["user_id"], []).append(r["item_id"])
    assert len(by_user[2]) == 1 and by_user[2][0] != 3
    assert len(by_user[1]) <= 5 and all(i >= 5 for i in by_user[1])
    # brute force: all N draws per user, first p valid ones
    from pyspark.sql.window import Window
    from tabulon.functions.rng import uniform
    d = spark.createDataFrame([(1, 5), (2, 1)], "user_id BIGINT, p BIGINT").select(
        "user_id", "p", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("_j"))
    d = d.withColumn("item_id", F.floor(uniform(11, "user_id", "_j") * 8).cast("bigint"))
    d = d.join(pos, ["user_id", "item_id"], "left_anti")
    d = d.withColumn("r", F.row_number().over(Window.partitionBy("user_id").orderBy("_j"))).where("r <= p")
    assert sorted((r["user_id"], r["item_id"], r["_j"]) for r in d.collect()) == \
        sorted((r["user_id"], r["item_id"], r["_j"]) for r in neg)


def test_svd_rebuilds_matrix(spark):
    from tabulon.operators.text import svd
    rng = np.random.default_rng(0)
    a = rng.random((12, 6)) * (rng.random((12, 6)) > 0.5)
    rows = [(i, j, float(a[i, j])) for i in range(12) for j in range(6) if a[i, j]]
    s, v, u = svd(spark.createDataFrame(rows, "doc_id BIGINT, term_id INT, w DOUBLE"), 6, 6)
    um = np.zeros((12, 6))
    for r in u.collect():
        um[r["doc_id"], r["concept"]] = r["weight"]
    assert np.allclose(um @ np.diag(s) @ v.T, a, atol=1e-8)
    assert np.allclose(v.T @ v, np.eye(6), atol=1e-8)


def test_svd_of_a_larger_matrix(spark):
    """Leading values and spaces against numpy, with restarts, a block of
    zeros and fewer independent columns than asked for."""
    from tabulon.operators.text import svd
    rng = np.random.default_rng(4)
    a = rng.random((60, 40)) * (rng.random((60, 40)) > 0.7) * np.linspace(3, 0.5, 40)
    a[:, 30:] = 0
    cells = [(i, j, float(a[i, j])) for i in range(60) for j in range(40) if a[i, j]]
    df = spark.createDataFrame(cells, "doc_id BIGINT, term_id INT, w DOUBLE")
    want = np.linalg.svd(a)
    s, v, u = svd(df, 40, 3, tol=1e-9, extra=2, max_basis=12)
    assert np.allclose(s, want[1][:3], atol=1e-7) and np.allclose(np.abs(np.diag(v.T @ want[2][:3].T)), 1, atol=1e-6)
    assert all(v[np.abs(v[:, c]).argmax(), c] > 0 for c in range(3))
    um = np.zeros((60, 3))
    for r in u.collect():
        um[r["doc_id"], r["concept"]] = r["weight"]
    assert np.allclose(um.T @ um, np.eye(3), atol=1e-6) and np.allclose(a @ v, um * s, atol=1e-8)
    s, v, u = svd(df, 40, 40)
    assert len(s) == 30 and np.allclose(s, want[1][:30], atol=1e-7)
    s, v, u = svd(df.where("w < 0"), 40, 2)
    assert len(s) == 0 and u.count() == 0


def test_gram_times_in_one_pass(spark, monkeypatch):
    """A'A q by slices and slabs smaller than the matrix, with a document met
    twice in the cells, and without a join of the cells with the block."""
    from tabulon.operators import text as T
    rng = np.random.default_rng(9)
    a = rng.random((40, 30)) * (rng.random((40, 30)) > 0.6)
    a[3] = 0
    cells = [(i, j, float(a[i, j]) / 2) for i in range(40) for j in range(30) if a[i, j]] * 2 + [(5, None, 1.0), (5, 2, None)]
    monkeypatch.setattr(T, "SLAB", 7)
    monkeypatch.setattr(T, "CELLS_A_TASK", 50)
    v = T.doc_vectors(spark.createDataFrame(cells, "doc_id BIGINT, term_id INT, w DOUBLE"), "doc_id", "term_id", "w")
    q = rng.random((30, 5))
    assert v.count() == 39 and np.allclose(T.gram_times(v, q), a.T @ (a @ q))
    got = {r["doc_id"]: r["c"] for r in T.times_block(v, spark.sparkContext.broadcast(q), "doc_id").collect()}
    assert all(r["at"] == sorted(r["at"]) for r in v.collect())  # equal documents tie exactly
    assert set(got) == set(range(40)) - {3} and all(np.allclose(c, a[i] @ q) for i, c in got.items())


def test_lsa_concepts_fits_once(spark, monkeypatch):
    from tabulon.plans import text as P
    fits = []
    u = spark.createDataFrame([(1, 0, 0.5), (2, 0, 0.25)], "doc_id BIGINT, concept INT, weight DOUBLE")
    vocab = spark.createDataFrame([(0, "apple"), (1, "pear")], "term_id BIGINT, term STRING")
    monkeypatch.setattr(P, "lsa", lambda *a, **k: fits.append(1) or (vocab, np.ones(1), np.array([[0.8], [0.6]]), u))
    rows = [(r["kind"], r["rank"], r["item"]) for r in P.q_lsa_concepts(spark, SF001).collect()]
    assert len(fits) == 1 and sorted(rows) == [("doc", 1, "Doc 1"), ("doc", 2, "Doc 2"), ("term", 1, "apple"), ("term", 2, "pear")]


def test_one_hot_rows_keep_features_once(spark, monkeypatch):
    """What the last checkpoint of the connection rows holds of the features
    is ``z``, and the anomalies' checkpoint holds none."""
    from tabulon.plans import clusters as C
    from tabulon.session import cut
    kept = []
    monkeypatch.setattr(C, "cut", lambda d: kept.append(d.columns) or cut(d))
    monkeypatch.setattr(C, "ANOMALY_K", 3)
    monkeypatch.setattr(C, "ANOMALY_RANK", 5)
    rows = C.q_anomaly_fitted(spark, SF001).collect()
    wide = {"x", "z", "features"}
    assert len(kept) == 3 and wide & set(kept[1]) == {"z"} and not wide & set(kept[2])
    assert 0 < len(rows) < 5 and all(r["line"].count(",") == 9 for r in rows)


def test_tfidf_formula(spark):
    from tabulon.operators import text as T
    docs = spark.createDataFrame([(1, "apple banana apple zzz"), (2, "banana cherry")], "doc_id BIGINT, text STRING")
    tf = T.term_freq(T.tokenize_terms(docs))
    vocab = T.vocabulary(T.doc_freq(tf), 2)  # banana (df 2), apple (df 1, ties by term)
    w = {(r["doc_id"], r["term"]): r["w"] for r in T.tfidf(tf, T.idf(vocab, 2)).collect()}
    assert set(w) == {(1, "apple"), (1, "banana"), (2, "banana")}
    assert abs(w[(1, "apple")] - np.log(2 / 1) * 2 / 4) < 1e-12 and w[(1, "banana")] == 0.0


def test_dense_index(spark):
    from tabulon.operators.windows import dense_index
    ids = [10**15 - 7 * i * i for i in range(300)] + [5, 5, -3]
    df = spark.createDataFrame([(i,) for i in ids] + [(None,)], "id BIGINT").repartition(7)
    got = {r["id"]: r["n"] for r in dense_index(df, "id", "n").collect()}
    assert got == {v: k for k, v in enumerate(sorted(set(ids)))}


def test_vocabulary_threshold_and_ties(spark):
    from tabulon.operators.text import vocabulary
    rows = [(f"t{i:02d}", d) for i, d in enumerate([9, 1, 5, 5, 5, 5, 2, 9])]
    df = spark.createDataFrame(rows, "term STRING, df BIGINT")
    for k in (1, 2, 4, 6, 7, 8, 50):
        want = sorted(rows, key=lambda r: (-r[1], r[0]))[:k]
        got = vocabulary(df, k).orderBy("term_id").collect()
        assert [(r["term"], r["df"]) for r in got] == want and [r["term_id"] for r in got] == list(range(len(want)))


def test_als_wide_ids(spark):
    from tabulon.operators import ml as ML
    rows = [(2**40 + u, -5 - i, 1.0 + (u * i) % 3) for u in range(12) for i in range(9) if (u + i) % 3]
    m = ML.als_fit(spark.createDataFrame(rows, "user_id BIGINT, item_id BIGINT, rating DOUBLE"), rank=3, max_iter=2)
    users = {r["user_id"] for r in ML.factors(m, "user", "user_id").collect()}
    items = {r["item_id"] for r in ML.factors(m, "item", "item_id").collect()}
    assert users == {r[0] for r in rows} and items == {r[1] for r in rows}


def test_checkpoint_folder_is_needed_on_a_cluster():
    import pytest
    from tabulon.session import checkpoint_dir

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(dict)

    class Session:
        sparkContext, conf = Context, {}

    with pytest.raises(ValueError):
        checkpoint_dir(Session)


def test_forest_on_nominal_features_and_one_vector(spark):
    """The class depends on a set of categories that no threshold separates;
    a forest that knows the feature as nominal finds it and scores a vector."""
    from pyspark.ml.classification import RandomForestClassifier
    from tabulon.operators import evaluate as EV
    from tabulon.operators import ml as ML
    r = np.random.default_rng(3)
    odd = {0, 3, 5, 8, 11}
    rows = [(int(c), float(x), float((c in odd) != (x > 0.8))) for c, x in zip(r.integers(0, 12, 600), r.random(600))]
    df = ML.nominal_vector(spark.createDataFrame(rows, "cat INT, x DOUBLE, y DOUBLE"), {"cat": 12}, ["x"])
    attrs = df.schema["features"].metadata["ml_attr"]
    assert attrs["num_attrs"] == 2 and len(attrs["attrs"]["nominal"][0]["vals"]) == 12
    train, test = df.where("x < 0.3 or x > 0.4"), df.where("x >= 0.3 and x <= 0.4")
    forest = RandomForestClassifier(numTrees=20, impurity="entropy", maxDepth=5, maxBins=40, seed=7, labelCol="y", featureSubsetStrategy="all").fit(train)
    assert EV.accuracy(forest.transform(test), "y").first()["accuracy"] > 0.95 > EV.random_guess_accuracy(train, test, "y").first()[0]
    assert ML.score_vector(forest, [3.0, 0.35])["prediction"] == 1.0 and ML.score_vector(forest, [4.0, 0.35])["prediction"] == 0.0
    assert 0.5 < ML.score_vector(forest, [3.0, 0.95])["share"] <= 1.0
    import pytest
    with pytest.raises(ValueError):
        ML.score_vector(forest, [1.0])
