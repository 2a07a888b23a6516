"""Implicit-feedback recommendation (fixtures F-ratings, F-items, F-alias)."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.functions.rng import duck_uniform_sql
from tabulon.operators import evaluate as EV
from tabulon.operators import ml as ML
from tabulon.operators.aggs import group_lists
from tabulon.operators.joins import canonicalize, lookup, popularity_score
from tabulon.operators.sampling import random_split, sample_negatives
from tabulon.operators.topk import top_k
from tabulon.plans import duck
from tabulon.plans import fixtures as fx
from tabulon.session import cut, submitted, written
from tabulon.sources.text import parse_alias, parse_id_name, parse_ratings

SPLIT_SEED, NEG_SEED = 7, 17
TRAIN_SHARE = 0.9
TOP_N, N_USERS = 5, 100
FITS_AT_ONCE = 2


def rating_lines(spark, sf_dir) -> DataFrame:
    r = fx.ratings(spark, sf_dir)
    u, i, c = (F.col(x).cast("string") for x in ("user_id", "item_id", "rating"))
    return r.select(F.explode(F.array(F.concat_ws(" ", u, i, c), F.concat_ws(" ", u, i),
                                      F.concat_ws(" ", F.concat(F.lit("u"), u), i, c))).alias("value"))


def item_lines(spark, sf_dir) -> DataFrame:
    it = fx.items(spark, sf_dir)
    i, n = F.col("item_id").cast("string"), F.col("name")
    return it.select(F.explode(F.array(F.concat(i, F.lit("\t "), n, F.lit(" ")), F.concat(n, F.lit("\t"), i), i))
                     .alias("value"))


def alias_lines(spark, sf_dir) -> DataFrame:
    a = fx.aliases(spark, sf_dir)
    x, y = F.col("alias_id").cast("string"), F.col("item_id").cast("string")
    return a.select(F.explode(F.array(F.concat_ws("\t", x, y), x, F.concat_ws("\t", F.lit("id"), x),
                                      F.concat_ws("\t", x, F.lit("")))).alias("value"))


def canonical_ratings(spark, sf_dir) -> DataFrame:
    return canonicalize(fx.ratings(spark, sf_dir), "item_id", fx.aliases(spark, sf_dir))


def split(spark, sf_dir) -> DataFrame:
    return random_split(canonical_ratings(spark, sf_dir), [TRAIN_SHARE, 1 - TRAIN_SHARE], SPLIT_SEED,
                        ["user_id", "item_id"])


def first_user(spark, sf_dir):
    return fx.ratings(spark, sf_dir).agg(F.min("user_id")).scalar()


def negatives(spark, sf_dir) -> DataFrame:
    return negatives_of(cut(split(spark, sf_dir)))


def negatives_of(s: DataFrame) -> DataFrame:
    """Negative pairs for the held-out part of a split."""
    cv = s.where("part = 1").select("user_id", "item_id")
    all_items = s.select("item_id").distinct()
    return sample_negatives(cv, all_items, NEG_SEED)


def q_scan_ratings(spark, sf_dir):
    return parse_ratings(rating_lines(spark, sf_dir))


def q_scan_id_name(spark, sf_dir):
    return parse_id_name(item_lines(spark, sf_dir))


def q_scan_alias(spark, sf_dir):
    return parse_alias(alias_lines(spark, sf_dir))


def q_filter_valid_int(spark, sf_dir):
    lines = item_lines(spark, sf_dir)
    head = F.split("value", "\t")[0]
    return lines.where(head.try_cast("bigint").isNotNull()).select(head.cast("bigint").alias("id")).groupBy("id") \
                .agg(F.count(F.lit(1)).alias("n"))


def q_canonicalize_alias(spark, sf_dir):
    return canonical_ratings(spark, sf_dir)


def q_random_split(spark, sf_dir):
    return split(spark, sf_dir).select("user_id", "item_id", "part")


def q_popularity_score(spark, sf_dir):
    s = split(spark, sf_dir)
    train, cv = s.where("part = 0"), s.where("part = 1").select("user_id", "item_id")
    return popularity_score(train, cv)


def q_filter_user(spark, sf_dir):
    return fx.ratings(spark, sf_dir).where(F.col("user_id") == first_user(spark, sf_dir)).select("item_id", "rating")


def q_known_items_of_user(spark, sf_dir):
    mine = fx.ratings(spark, sf_dir).where(F.col("user_id") == first_user(spark, sf_dir))
    return lookup(fx.items(spark, sf_dir), mine, "item_id")


def q_lookup_key(spark, sf_dir):
    key = fx.aliases(spark, sf_dir).agg(F.min("alias_id")).scalar()
    return fx.items(spark, sf_dir).where(F.col("item_id") == key)


def q_join_inner_pairs(spark, sf_dir):
    r = fx.ratings(spark, sf_dir)
    return r.join(fx.items(spark, sf_dir), "item_id").select("user_id", "item_id", "name")


def q_group_lists(spark, sf_dir):
    g = group_lists(fx.ratings(spark, sf_dir), "user_id", "item_id")
    return g.select("user_id", "chunk", F.col("n").alias("n_items"), F.col("values").alias("items"))


def q_key_value_views(spark, sf_dir):
    # keys / values / flatMapValues of (user, item) pairs are projections
    r = fx.ratings(spark, sf_dir)
    return r.select(F.col("user_id").alias("key"), F.col("item_id").alias("value"))


def q_take_n(spark, sf_dir):
    return top_k(fx.ratings(spark, sf_dir), TOP_N, [F.desc("rating"), "user_id", "item_id"])


def q_sample_negatives(spark, sf_dir):
    return negatives(spark, sf_dir).select("user_id", "item_id", F.col("_j").alias("draw"))


def q_ranking_auc(spark, sf_dir):
    s = cut(split(spark, sf_dir))
    train, cv = s.where("part = 0"), s.where("part = 1").select("user_id", "item_id")
    neg = negatives_of(s).select("user_id", "item_id")
    per_user = EV.ranking_auc(popularity_score(train, cv), popularity_score(train, neg))
    return EV.mean_auc(per_user).select("users", F.round("auc", 6).alias("auc"))


def _als(spark, sf_dir, **kw):
    return ML.als_fit(canonical_ratings(spark, sf_dir), **kw)


def q_als_fit(spark, sf_dir):
    m = _als(spark, sf_dir)
    return ML.factors(m, "item", "item_id")


def q_user_factors(spark, sf_dir):
    m = _als(spark, sf_dir)
    return ML.factors(m, "user", "user_id")


def q_als_recommend_topn(spark, sf_dir):
    m = _als(spark, sf_dir, rank=50, max_iter=10, reg=1.0, alpha=40.0)
    users = top_k(fx.ratings(spark, sf_dir).select("user_id").distinct(), N_USERS, ["user_id"])
    recs = ML.recommend_top_n(m, users, TOP_N)
    return recs.join(fx.items(spark, sf_dir), "item_id", "left")


def q_als_grid(spark, sf_dir):
    """Every (rank, reg, alpha) of the grid scored by AUC on held-out pairs."""
    s = written(split(spark, sf_dir).select("user_id", "item_id", "rating", "part"))
    train, cv = s.where("part = 0"), s.where("part = 1").select("user_id", "item_id")
    neg = cut(negatives_of(s).select("user_id", "item_id"))

    def scored(rank, reg, alpha):
        m = ML.als_fit(train, rank=rank, max_iter=10, reg=reg, alpha=alpha)
        per_user = EV.ranking_auc(ML.als_scores(m, cv), ML.als_scores(m, neg))
        auc = EV.mean_auc(per_user).first()["auc"]
        return rank, reg, alpha, float(auc) if auc is not None else None

    grid = [(rank, reg, alpha) for rank in (10, 50) for reg in (1.0, 0.001) for alpha in (1.0, 40.0)]
    # a fit of ALS's ten blocks leaves cores idle where there are more, and at the end of every step
    rows = submitted(spark, [partial(scored, *p) for p in grid], FITS_AT_ONCE)
    return spark.createDataFrame(rows, "rank INT, reg DOUBLE, alpha DOUBLE, auc DOUBLE").orderBy(F.desc("auc"))


QUERIES = {
    "scan_ratings": q_scan_ratings,
    "scan_id_name": q_scan_id_name,
    "scan_alias": q_scan_alias,
    "filter_valid_int": q_filter_valid_int,
    "canonicalize_alias": q_canonicalize_alias,
    "random_split": q_random_split,
    "popularity_score": q_popularity_score,
    "filter_user": q_filter_user,
    "known_items_of_user": q_known_items_of_user,
    "lookup_key": q_lookup_key,
    "join_inner_pairs": q_join_inner_pairs,
    "group_lists": q_group_lists,
    "key_value_views": q_key_value_views,
    "take_n": q_take_n,
    "sample_negatives": q_sample_negatives,
    "ranking_auc": q_ranking_auc,
    "als_fit": q_als_fit,
    "user_factors": q_user_factors,
    "als_recommend_topn": q_als_recommend_topn,
    "als_grid": q_als_grid,
}

# ---------------------------------------------------------------- oracle SQL
_U = duck_uniform_sql(SPLIT_SEED, "user_id", "item_id")


def _ctes(**more):
    c = dict(
        ratings=duck.F_RATINGS, items=duck.F_ITEMS, alias=duck.F_ALIAS,
        canon="SELECT r.user_id, COALESCE(a.item_id, r.item_id) AS item_id, r.rating FROM ratings r "
              "LEFT JOIN alias a ON r.item_id = a.alias_id",
        sp=f"SELECT *, CASE WHEN {_U} < {TRAIN_SHARE} THEN 0 ELSE 1 END AS part FROM canon",
        train="SELECT * FROM sp WHERE part = 0",
        cv="SELECT user_id, item_id FROM sp WHERE part = 1",
        tot="SELECT item_id, SUM(rating) AS tot FROM train GROUP BY item_id",
        fu="SELECT MIN(user_id) AS u FROM ratings",
    )
    c.update(more)
    return c


def _q(body, **more):
    return duck.with_ctes(body, **_ctes(**more))


_NEG = dict(
    idx="SELECT item_id, ROW_NUMBER() OVER (ORDER BY item_id) - 1 AS item_idx FROM (SELECT DISTINCT item_id FROM sp) d",
    pos="SELECT DISTINCT user_id, item_id FROM cv",
    need="SELECT user_id, COUNT(*) AS p FROM pos GROUP BY user_id",
    draws="SELECT n.user_id, n.p, r.j, CAST(FLOOR(" + duck_uniform_sql(NEG_SEED, "n.user_id", "r.j")
          + " * (SELECT COUNT(*) FROM idx)) AS BIGINT) AS item_idx FROM need n, range((SELECT COUNT(*) FROM idx)) r(j)",
    valid="SELECT d.user_id, d.p, d.j, i.item_id FROM draws d JOIN idx i ON d.item_idx = i.item_idx "
          "WHERE NOT EXISTS (SELECT 1 FROM pos WHERE pos.user_id = d.user_id AND pos.item_id = i.item_id)",
    neg="SELECT user_id, item_id, j FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY j) AS r "
        "FROM valid) v WHERE r <= p",
)


def oracle() -> dict:
    return {
        "scan_ratings": duck.with_ctes("SELECT user_id, item_id, rating FROM ratings", ratings=duck.F_RATINGS),
        "scan_id_name": duck.with_ctes("SELECT item_id, trim(name) AS name FROM items", items=duck.F_ITEMS),
        "scan_alias": duck.with_ctes("SELECT alias_id, item_id FROM alias", alias=duck.F_ALIAS),
        "filter_valid_int": duck.with_ctes("SELECT item_id AS id, COUNT(*) * 2 AS n FROM items GROUP BY item_id",
                                           items=duck.F_ITEMS),
        "canonicalize_alias": _q("SELECT user_id, item_id, rating FROM canon"),
        "random_split": _q("SELECT user_id, item_id, part FROM sp"),
        "popularity_score": _q("SELECT cv.user_id, cv.item_id, CAST(COALESCE(tot.tot, 0.0) AS DOUBLE) AS score FROM cv "
                               "LEFT JOIN tot ON cv.item_id = tot.item_id"),
        "filter_user": _q("SELECT item_id, rating FROM ratings WHERE user_id = (SELECT u FROM fu)"),
        "known_items_of_user": _q("SELECT item_id, name FROM items WHERE item_id IN "
                                  "(SELECT item_id FROM ratings WHERE user_id = (SELECT u FROM fu))"),
        "lookup_key": _q("SELECT item_id, name FROM items WHERE item_id = (SELECT MIN(alias_id) FROM alias)"),
        "join_inner_pairs": _q("SELECT r.user_id, r.item_id, i.name FROM ratings r JOIN items i ON r.item_id = i.item_id"),
        "group_lists": _q("SELECT user_id, chunk, COUNT(*) AS n_items, list_sort(list(item_id)) AS items FROM (SELECT *, "
                          "CAST((ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY item_id) - 1) // 10000 AS BIGINT) AS chunk "
                          "FROM ratings) r GROUP BY user_id, chunk"),
        "key_value_views": _q("SELECT user_id AS key, item_id AS value FROM ratings"),
        "take_n": _q(f"SELECT user_id, item_id, rating FROM ratings ORDER BY rating DESC, user_id, item_id LIMIT {TOP_N}"),
        "sample_negatives": _q("SELECT user_id, item_id, j AS draw FROM neg", **_NEG),
        "ranking_auc": _q(
            "SELECT COUNT(*) AS users, ROUND(AVG(auc), 6) AS auc FROM (SELECT p.user_id, "
            "SUM(CASE WHEN p.s > n.s THEN 1 ELSE 0 END) / (COUNT(*)) AS auc FROM "
            "(SELECT cv.user_id, COALESCE(tot.tot, 0.0) AS s FROM cv LEFT JOIN tot ON cv.item_id = tot.item_id) p JOIN "
            "(SELECT neg.user_id, COALESCE(tot.tot, 0.0) AS s FROM neg LEFT JOIN tot ON neg.item_id = tot.item_id) n "
            "ON p.user_id = n.user_id GROUP BY p.user_id) a", **_NEG),
    }
