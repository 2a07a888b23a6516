"""Sessionization and gap pairs on hand-sized inputs."""

import datetime as dt

from pyspark.sql import functions as F

from tabulon.functions.time import US_PER_HOUR, floor_hours
from tabulon.operators.sessions import consecutive_pairs, ordered_position, sessionize


def _trips(spark, rows):
    return spark.createDataFrame(rows, "id BIGINT, k STRING, ts TIMESTAMP_NTZ")


def test_gap_of_exactly_four_hours_splits(spark):
    t0 = dt.datetime(2020, 1, 1, 0, 0, 0)
    rows = [(1, "a", t0), (2, "a", t0 + dt.timedelta(hours=4)),
            (3, "a", t0 + dt.timedelta(hours=7, minutes=59, seconds=59)),
            (4, "b", t0), (5, "b", t0 + dt.timedelta(hours=3, minutes=59))]
    s = sessionize(_trips(spark, rows), "k", "ts", "id", 4 * US_PER_HOUR)
    got = {r["id"]: r["session_no"] for r in s.collect()}
    assert got == {1: 1, 2: 2, 3: 2, 4: 1, 5: 1}


def test_sessions_across_buckets_and_ties(spark):
    base = dt.datetime(2020, 1, 1, 22, 0, 0)
    rows = [(i, "k", base + dt.timedelta(hours=h)) for i, h in enumerate([0, 1, 1, 3, 8, 30, 31, 50])]
    small = sessionize(_trips(spark, rows), "k", "ts", "id", 4 * US_PER_HOUR, bucket_us=US_PER_HOUR)
    big = sessionize(_trips(spark, rows), "k", "ts", "id", 4 * US_PER_HOUR, bucket_us=1000 * US_PER_HOUR)
    a = sorted((r["id"], r["session_no"]) for r in small.collect())
    b = sorted((r["id"], r["session_no"]) for r in big.collect())
    assert a == b == [(0, 1), (1, 1), (2, 1), (3, 1), (4, 2), (5, 3), (6, 3), (7, 4)]


def test_pairs_stay_inside_sessions(spark):
    base = dt.datetime(2020, 1, 1)
    rows = [(i, "k", base + dt.timedelta(hours=h)) for i, h in enumerate([0, 2, 9, 10, 30])]
    p = consecutive_pairs(_trips(spark, rows), "k", "ts", "id", carry=["id"], gap_us=4 * US_PER_HOUR,
                          bucket_us=3 * US_PER_HOUR)
    assert sorted((r["id"], r["next_id"]) for r in p.collect()) == [(0, 1), (2, 3)]


def test_ordered_position(spark):
    base = dt.datetime(2020, 1, 1)
    rows = [(i, "k", base + dt.timedelta(days=d)) for i, d in enumerate([5, 1, 3, 3, 0])]
    p = ordered_position(_trips(spark, rows), "k", "ts", "id", bucket_us=24 * US_PER_HOUR)
    assert sorted((r["pos"], r["id"]) for r in p.collect()) == [(1, 4), (2, 1), (3, 2), (4, 3), (5, 0)]


def test_floor_hours_negative(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 1, 1, 1), dt.datetime(2020, 1, 1, 0, 59, 59))],
                               "a TIMESTAMP_NTZ, b TIMESTAMP_NTZ")
    assert df.select(floor_hours("a", "b").alias("h")).first()["h"] == -1


def test_result_independent_of_partitioning(spark):
    from tabulon.plans import trips
    from tests.conftest import SF001
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    a = sorted(map(tuple, trips.q_sessionize(spark, SF001).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    b = sorted(map(tuple, trips.q_sessionize(spark, SF001).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert a == b and len(a) > 0
