"""Bucketed windows equal the plain per-key window, also with a hot key."""

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabulon.functions.time import US_PER_HOUR
from tabulon.operators.sessions import sessionize
from tabulon.operators.windows import bucketed_position, bucketed_running_sum, quantile_bucket


def _skewed(spark, n=30000):
    # key 0 holds a third of all rows
    return spark.range(n).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 97 + 1).alias("k"),
        (F.col("id") * 7919 % 100003).cast("double").alias("v"),
        F.timestamp_seconds((F.col("id") * 7919 % 1000003) * 60).cast("timestamp_ntz").alias("ts"))


def test_running_sum_matches_window(spark):
    df = _skewed(spark)
    cuts = [20000.0, 40000.0, 60000.0, 80000.0]
    b = df.withColumn("qb", quantile_bucket("v", cuts))
    got = bucketed_running_sum(b, "k", "qb", ["v", "id"], "v", "rs", inclusive=False)
    w = Window.partitionBy("k").orderBy("v", "id").rowsBetween(Window.unboundedPreceding, -1)
    exp = df.withColumn("rs", F.coalesce(F.sum("v").over(w), F.lit(0.0)))
    a = {r["id"]: r["rs"] for r in got.select("id", "rs").collect()}
    e = {r["id"]: r["rs"] for r in exp.select("id", "rs").collect()}
    assert a == e


def test_position_matches_row_number(spark):
    df = _skewed(spark).withColumn("blk", F.floor(F.col("id") / 1000))
    got = bucketed_position(df, "k", "blk", ["id"], "pos")
    exp = df.withColumn("pos", F.row_number().over(Window.partitionBy("k").orderBy("id")))
    assert {r["id"]: r["pos"] for r in got.collect()} == {r["id"]: r["pos"] for r in exp.collect()}


def test_sessionize_hot_key_matches_plain_window(spark):
    df = _skewed(spark)
    got = sessionize(df, "k", "ts", "id", 4 * US_PER_HOUR, bucket_us=24 * US_PER_HOUR)
    w = Window.partitionBy("k").orderBy("ts", "id")
    prev = F.lag("ts").over(w)
    start = (prev.isNull() | (F.timestamp_diff("MICROSECOND", prev, F.col("ts")) >= 4 * US_PER_HOUR)).cast("int")
    exp = df.withColumn("_s", start).withColumn(
        "session_no", F.sum("_s").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    assert {r["id"]: r["session_no"] for r in got.collect()} == {r["id"]: r["session_no"] for r in exp.collect()}


def test_group_lists_chunks(spark):
    from tabulon.operators.aggs import group_lists
    df = spark.createDataFrame([(1, v) for v in [9, 3, 70000, 5, 1, 8, 2, 7, 6, 4]] + [(2, 5)], "k INT, v BIGINT")
    got = sorted((r["k"], r["chunk"], r["n"], list(r["values"])) for r in group_lists(df, "k", "v", chunk=3).collect())
    assert got == [(1, 0, 3, [1, 2, 3]), (1, 1, 3, [4, 5, 6]), (1, 2, 3, [7, 8, 9]), (1, 3, 1, [70000]), (2, 0, 1, [5])]
