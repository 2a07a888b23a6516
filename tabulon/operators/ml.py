"""Model fitting and scoring with Spark ML, plus the feature steps around it.

Fitting is Spark ML's distributed training (ALS, decision trees, random
forests, k-means). Scoring against small model state (centres, moments,
category lists) uses that state as literals inside column expressions --
no cross join with a centre table, no per-row Python."""

from __future__ import annotations

import json

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.recommendation import ALS
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.functions.vectors import as_double_array, euclidean_distance
from tabulon.operators.windows import dense_index
from tabulon.session import checkpoint_dir, swept

INT_MAX = 2**31 - 1
RATINGS_A_BLOCK = 4_000_000  # of a block of ALS, whose task holds the factors they meet


# ---------------------------------------------------------------- features
def to_vector(df: DataFrame, array_col: str, out: str = "features") -> DataFrame:
    return df.withColumn(out, array_to_vector(as_double_array(array_col)))


def to_array(df: DataFrame, vec_col: str, out: str | None = None) -> DataFrame:
    return df.withColumn(out or vec_col, vector_to_array(F.col(vec_col)))


def number_literal(values, kind: str) -> Column:
    """Nested lists of finite numbers as one literal of type ``kind``: a text
    that the optimizer folds, not a node of the plan for each number."""
    return F.from_json(F.lit(json.dumps(values, allow_nan=False)), kind)


def column_moments_literal(df: DataFrame, arr: str) -> tuple[list[float], list[float]]:
    """Per position mean and population stdev of an array column (the
    sqrt(n*ss - s^2)/n form); one partially aggregated pass, 2d numbers out."""
    from tabulon.operators.aggs import column_moments
    rows = column_moments(df, arr).select("pos", "mean", "stdev").collect()
    rows = sorted(rows, key=lambda r: r["pos"])
    return [float(r["mean"]) for r in rows], [float(r["stdev"]) for r in rows]


def standardize(arr, means: list[float], stdevs: list[float]) -> Column:
    """(x - mean) / stdev per position; only centred where stdev <= 0."""
    a = F.col(arr) if isinstance(arr, str) else arr
    m, s = (number_literal([float(x) for x in v], "array<double>") for v in (means, stdevs))
    return F.transform(a, lambda x, i: F.when(s[i] > 0, (x - m[i]) / s[i]).otherwise(x - m[i]))


def category_lists(df: DataFrame, categoricals: list[str]) -> dict:
    """Distinct values of each categorical, ascending (model state: its size
    is the number of categories). One partially aggregated pass for all."""
    r = df.agg(*[F.array_sort(F.collect_set(c)).alias(c) for c in categoricals]).first()
    return {c: list(r[c]) for c in categoricals}


def one_hot_features(df: DataFrame, first_numeric: list[str], categoricals: list[str],
                     rest_numeric: list[str], out: str = "features") -> tuple[DataFrame, dict]:
    """Numeric columns with one-hot blocks inserted after ``first_numeric``:
    each categorical becomes a 0/1 block over its distinct values in
    ascending order (what StringIndexer(alphabetAsc) + OneHotEncoder
    (dropLast=False) produce), built as one array expression. Returns the
    table with an ARRAY<DOUBLE> ``out`` and the category lists."""
    cats = category_lists(df, categoricals)
    parts = [F.col(c).cast("double") for c in first_numeric]
    for c in categoricals:
        parts += [F.when(F.col(c) == F.lit(v), F.lit(1.0)).otherwise(F.lit(0.0)) for v in cats[c]]
    parts += [F.col(c).cast("double") for c in rest_numeric]
    return df.withColumn(out, F.array(*parts)), cats


def un_one_hot(arr, start: int, length: int) -> Column:
    """0-based index of the 1.0 inside the block [start, start + length) of an
    array (-1 when the block holds no 1.0)."""
    a = F.col(arr) if isinstance(arr, str) else arr
    return (F.array_position(F.slice(a, start + 1, length), F.lit(1.0)) - 1).cast("int")


def nominal_vector(df: DataFrame, nominal: dict[str, int], numeric: list[str], out: str = "features") -> DataFrame:
    """``df`` with the vector ``out`` of the ``nominal`` columns (category
    numbers from 0; name to count of categories) and the ``numeric`` ones,
    marked so that trees split the former by sets of categories. The mark is
    metadata of the column: set it after a checkpoint (``mark_nominal``)."""
    parts = [F.col(c).cast("double") for c in [*nominal, *numeric]]
    return mark_nominal(df.withColumn(out, array_to_vector(F.array(*parts))), nominal, numeric, out)


def mark_nominal(df: DataFrame, nominal: dict[str, int], numeric: list[str], out: str = "features") -> DataFrame:
    attrs = {"nominal": [{"idx": i, "name": c, "vals": [str(v) for v in range(n)]} for i, (c, n) in enumerate(nominal.items())],
             "numeric": [{"idx": len(nominal) + i, "name": c} for i, c in enumerate(numeric)]}
    meta = {"ml_attr": {"attrs": attrs, "num_attrs": len(nominal) + len(numeric)}}
    return df.withColumn(out, F.col(out).alias(out, metadata=meta))


def score_vector(model, values: list[float]) -> dict:
    """A fitted classifier's class for one given feature vector, and the
    share of its votes."""
    from pyspark.ml.linalg import Vectors

    if len(values) != model.numFeatures:
        raise ValueError(f"the model has {model.numFeatures} features")
    v = Vectors.dense([float(x) for x in values])
    cls = float(model.predict(v))
    return {"prediction": cls, "share": float(model.predictProbability(v)[int(cls)])}


# ---------------------------------------------------------------- ALS
def int_ids(df: DataFrame, *cols: str) -> tuple[DataFrame, dict, int]:
    """``df`` with ids that fit ALS's 32-bit range: columns outside it are
    re-indexed densely, and returned with their (id, idx) table by name. Last
    the number of rows."""
    r = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.max(c).alias(c) for c in cols], *[F.min(c).alias(f"min_{c}") for c in cols]).first()
    tables = {}
    for c in cols:
        if r[c] is not None and (r[c] > INT_MAX or r[f"min_{c}"] < 0):
            tables[c] = dense_index(df, c, "_idx")
            df = df.join(tables[c], c).drop(c).withColumnRenamed("_idx", c)
    return df, tables, r["_rows"]


def als_fit(ratings: DataFrame, rank: int = 10, max_iter: int = 5, reg: float = 0.01, alpha: float = 1.0,
            seed: int = 42, user: str = "user_id", item: str = "item_id", rating: str = "rating"):
    """Implicit-feedback ALS (blocked, distributed). Ids outside the 32-bit
    range are re-indexed; ``factors`` gives them back.

    Every iteration shuffles all factors to the blocks that need them. The
    item factors are checkpointed each time, so that the iterations before are
    let go and their shuffle files deleted while the fit goes on. Blocks hold
    ``RATINGS_A_BLOCK`` ratings on average at most (ten blocks at least)."""
    ratings, tables, rows = int_ids(ratings.select(user, item, rating), user, item)
    data = ratings.select(F.col(user).cast("int").alias(user), F.col(item).cast("int").alias(item),
                          F.col(rating).cast("float").alias(rating))
    blocks = max(10, -(-rows // RATINGS_A_BLOCK))
    als = ALS(rank=rank, maxIter=max_iter, regParam=reg, alpha=alpha, implicitPrefs=True, seed=seed, numUserBlocks=blocks, numItemBlocks=blocks,
              userCol=user, itemCol=item, ratingCol=rating, coldStartStrategy="drop", checkpointInterval=1)
    checkpoint_dir(data.sparkSession)
    with swept(data.sparkSession):
        model = als.fit(data)
    model.id_tables = tables
    return model


def factors(model, kind: str, col: str) -> DataFrame:
    """(col, features) of the model's 'user' or 'item' factors, under the
    original ids."""
    f = (model.userFactors if kind == "user" else model.itemFactors).select(F.col("id").cast("bigint").alias(col), "features")
    table = model.id_tables.get(col)
    if table is None:
        return f
    return f.withColumnRenamed(col, "_idx").join(table, "_idx").select(col, "features")


def recommend_top_n(model, users: DataFrame, n: int, user: str = "user_id", item: str = "item_id") -> DataFrame:
    """(user, rank, item, score): top n items for every user in ``users`` --
    one batch job for all of them."""
    recs = model.recommendForUserSubset(users.select(F.col(user).cast("int").alias(user)).distinct(), n)
    e = recs.select(user, F.posexplode("recommendations").alias("pos", "r"))
    return e.select(F.col(user).cast("bigint").alias(user), (F.col("pos") + 1).alias("rank"),
                    F.col(f"r.{item}").cast("bigint").alias(item), F.col("r.rating").alias("score"))


def als_scores(model, pairs: DataFrame, user: str = "user_id", item: str = "item_id",
               out: str = "score") -> DataFrame:
    """Score (user, item) pairs with the factor dot product; pairs with an
    unknown user or item are dropped."""
    p = pairs.select("*", F.col(user).cast("int").alias("_u"), F.col(item).cast("int").alias("_i"))
    pred = model.transform(p.withColumnRenamed(user, "_user_orig").withColumnRenamed(item, "_item_orig")
                           .withColumnRenamed("_u", user).withColumnRenamed("_i", item))
    pred = pred.drop(user, item).withColumnRenamed("_user_orig", user).withColumnRenamed("_item_orig", item)
    return pred.withColumnRenamed("prediction", out)


# ---------------------------------------------------------------- k-means
def kmeans_fit(df: DataFrame, k: int, features: str = "features", max_iter: int = 20, tol: float = 1e-4,
               seed: int = 1):
    return KMeans(k=k, maxIter=max_iter, tol=tol, seed=seed, featuresCol=features).fit(df)


def centres_of(model) -> list[list[float]]:
    return [[float(x) for x in c] for c in model.clusterCenters()]


def cluster_assign(df: DataFrame, arr: str, centres: list[list[float]], cluster: str = "cluster",
                   distance: str = "distance") -> DataFrame:
    """Nearest centre (lowest index on ties) and the Euclidean distance to it.
    Centres are model state (k x d numbers), one literal."""
    cs = number_literal([[float(x) for x in c] for c in centres], "array<array<double>>")
    a = F.col(arr)
    d2 = F.transform(cs, lambda c: F.aggregate(F.zip_with(a, c, lambda x, y: (x - y) * (x - y)),
                                               F.lit(0.0), lambda s, v: s + v))
    best = F.array_min(F.transform(d2, lambda d, i: F.struct(d.alias("d"), i.alias("i"))))
    return df.withColumn("_best", best).withColumn(cluster, F.col("_best.i")) \
             .withColumn(distance, F.sqrt(F.col("_best.d"))).drop("_best")


def assign_with(model, df: DataFrame, arr: str, features: str = "features") -> DataFrame:
    """Cluster and distance under a fitted model: the model's own transform
    (no literal per centre in the plan), then one distance per row to the
    centre it chose, looked up in a table of k rows."""
    spark = df.sparkSession
    table = spark.createDataFrame(list(enumerate(centres_of(model))), "cluster INT, _centre ARRAY<DOUBLE>")
    p = model.transform(df).withColumnRenamed("prediction", "cluster")
    p = p.join(F.broadcast(table), "cluster")  # k rows, a parameter
    return p.withColumn("distance", euclidean_distance(arr, F.col("_centre"))).drop("_centre")


def clustering_score(assigned: DataFrame, distance: str = "distance") -> DataFrame:
    """Mean distance to the nearest centre."""
    return assigned.agg(F.avg(distance).alias("score"))
