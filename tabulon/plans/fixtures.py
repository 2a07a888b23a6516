"""Stand-in inputs (the F-* fixtures) derived from the driver tables.

The reference reads play logs, forest-cover CSV, network connections,
encyclopedia XML, citation XML, taxi trips and price histories. Each has a
stand-in here computed by Spark from the parquet tables, so every query's
work grows with the tables it reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabulon.functions.geometry import ring_area, ring_edges


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ratings(spark, sf_dir) -> DataFrame:
    """F-ratings: (user_id, item_id, rating) = quantity a customer bought of a part."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (li.join(od, li.l_orderkey == od.o_orderkey)
            .groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"))
            .agg(F.sum("l_quantity").alias("rating")))


def items(spark, sf_dir) -> DataFrame:
    """F-items: (item_id, name)."""
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("item_id"),
                                               F.col("p_name").alias("name"))


def aliases(spark, sf_dir) -> DataFrame:
    """F-alias: duplicate parts (same name and brand) point at the smallest key."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    w = Window.partitionBy("p_name", "p_brand")
    return (p.withColumn("item_id", F.min("p_partkey").over(w))
            .where(F.col("p_partkey") != F.col("item_id"))
            .select(F.col("p_partkey").alias("alias_id"), "item_id"))


def labeled(spark, sf_dir) -> DataFrame:
    """F-labeled: (vec_id, label DOUBLE, embedding ARRAY<FLOAT>)."""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("label").cast("double").alias("label"), "embedding")


def mixed(spark, sf_dir) -> DataFrame:
    """F-mixed: numerics, three categoricals and a string label."""
    li = table(spark, sf_dir, "lineitem")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    return (li.join(p, li.l_partkey == p.p_partkey)
            .select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
                    "l_tax", "l_returnflag", "l_linestatus", "p_brand",
                    F.col("p_type").alias("label")))


def docs(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def articles(spark, sf_dir) -> DataFrame:
    """F-articles: documents dressed as encyclopedia pages (title, ns, text)
    with redirects, other namespaces and disambiguation pages mixed in."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    did = F.col("doc_id").cast("string")
    return d.select(
        "doc_id",
        F.when(F.col("doc_id") % 13 == 0, F.concat(F.lit("Doc "), did, F.lit(" (disambiguation)")))
         .otherwise(F.concat(F.lit("Doc "), did)).alias("title"),
        F.when(F.col("doc_id") % 7 == 0, F.lit(1)).otherwise(F.lit(0)).alias("ns"),
        F.when(F.col("doc_id") % 11 == 0, F.concat(F.lit("#REDIRECT "), F.col("text")))
         .otherwise(F.col("text")).alias("text"))


TOPIC_ROWS_A_TASK = 100_000


def doc_topics(spark, sf_dir, topic_col: str = "l_suppkey") -> DataFrame:
    """F-topics long form: (doc_id, topic STRING); baskets are documents. Rows
    seldom repeat, so they are dealt in tasks of bounded size before they are
    made distinct: a hash table over a whole split would save nothing."""
    li = table(spark, sf_dir, "lineitem")
    rows = li.select(F.col("l_orderkey").alias("doc_id"), F.col(topic_col).cast("string").alias("topic"))
    return rows.repartition(max(1, -(-li.count() // TOPIC_ROWS_A_TASK)), "doc_id", "topic").distinct()


def all_docs(spark, sf_dir) -> DataFrame:
    """Every document of F-topics, including those with no topic."""
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"))


def trips(spark, sf_dir) -> DataFrame:
    """F-trips: (event_id, license, event_type, pickup, dropoff, lon, lat)."""
    e = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    zero = (eid % 97) == 0
    lon = F.when(zero, F.lit(0.0)).otherwise((eid % 100) / F.lit(10.0) + F.lit(0.05))
    lat = F.when(zero, F.lit(0.0)).otherwise((F.floor(eid / F.lit(100)) % 100) / F.lit(10.0) + F.lit(0.05))
    dropoff = F.timestamp_add("MICROSECOND", F.floor(F.col("value") * F.lit(60000000)).cast("bigint"),
                              F.col("ts"))
    return e.select("event_id", F.col("user_id").alias("license"), "event_type",
                    F.col("ts").alias("pickup"), dropoff.alias("dropoff"),
                    lon.cast("double").alias("lon"), lat.cast("double").alias("lat"))


# The F-regions polygons (code, name, ring vertices as (x, y)).
REGIONS = [
    (1, "west", [(0, 0), (4, 0), (4, 10), (0, 10)]),
    (1, "west-core", [(1, 1), (3, 1), (3, 3), (1, 3)]),
    (2, "triangle", [(5, 0), (9, 0), (7, 6)]),
    (3, "ell", [(5, 7), (9, 7), (9, 9), (8, 9), (8, 8), (5, 8)]),
]


def region_rows():
    """Polygons as rows: code, name, area, bbox and edge list."""
    rows = []
    for code, name, ring in REGIONS:
        xs = [float(p[0]) for p in ring]
        ys = [float(p[1]) for p in ring]
        rows.append((code, name, ring_area(xs, ys), min(xs), min(ys), max(xs), max(ys),
                     [dict(x1=a, y1=b, x2=c, y2=d) for a, b, c, d in ring_edges(xs, ys)]))
    return rows


REGION_SCHEMA = ("code INT, name STRING, area DOUBLE, min_x DOUBLE, min_y DOUBLE, max_x DOUBLE, "
                 "max_y DOUBLE, edges ARRAY<STRUCT<x1: DOUBLE, y1: DOUBLE, x2: DOUBLE, y2: DOUBLE>>")


def regions(spark) -> DataFrame:
    """The polygon table built from literals (JVM-side)."""
    structs = []
    for code, name, area, x0, y0, x1, y1, edges in region_rows():
        es = F.array(*[F.struct(*[F.lit(float(e[k])).alias(k) for k in ("x1", "y1", "x2", "y2")]) for e in edges])
        structs.append(F.struct(F.lit(code).alias("code"), F.lit(name).alias("name"), F.lit(area).alias("area"),
                                F.lit(x0).alias("min_x"), F.lit(y0).alias("min_y"), F.lit(x1).alias("max_x"),
                                F.lit(y1).alias("max_y"), es.alias("edges")))
    return spark.range(1).select(F.inline(F.array(*structs)))


def instrument_prices(spark, sf_dir) -> DataFrame:
    """F-prices: (series, dt DATE, value) -- average order value per segment and day."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return (o.join(c, o.o_custkey == c.c_custkey)
            .groupBy(F.col("c_mktsegment").alias("series"), F.to_date("o_orderdate").alias("dt"))
            .agg(F.round(F.avg("o_totalprice"), 6).alias("value")))


def factor_prices(spark, sf_dir) -> DataFrame:
    """F-factors: (series, dt, value) per order priority."""
    o = table(spark, sf_dir, "orders")
    return (o.groupBy(F.col("o_orderpriority").alias("series"), F.to_date("o_orderdate").alias("dt"))
            .agg(F.round(F.avg("o_totalprice"), 6).alias("value")))
