"""Trip cleaning, regions, sessions and gap statistics (fixture F-trips)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.functions.time import (US_PER_HOUR, elapsed_us, epoch_micros, epoch_millis,
                                    floor_hours, parse_timestamp, whole_seconds)
from tabulon.operators.aggs import count_by_value, stats_by_group
from tabulon.operators.clean import filter_duration, filter_nonneg_gap, filter_zero_point
from tabulon.operators.geo import point_in_polygon
from tabulon.operators.sessions import consecutive_pairs, ordered_position, sessionize
from tabulon.plans import duck
from tabulon.plans import fixtures as fx
from tabulon.session import checkpoint_dir
from tabulon.sources.files import read_geojson
from tabulon.sources.text import parse_trips

GAP_US = 4 * US_PER_HOUR


def region_rank():
    """Polygon priority: region code ascending, then larger area first."""
    return [F.col("code"), -F.col("area")]


def _ts_text(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def trip_lines(spark, sf_dir) -> DataFrame:
    """Raw CSV lines built from F-trips: one good line per trip (with an
    unparseable coordinate where the trip has no position), plus a 13-field,
    a 15-field and a bad-timestamp variant of every trip, and a header."""
    t = fx.trips(spark, sf_dir)
    zero = (F.col("lon") == 0.0) & (F.col("lat") == 0.0)
    lon_txt = F.when(zero, F.lit("bad")).otherwise(F.col("lon").cast("string"))
    fields = [F.col("event_id").cast("string"), F.col("license").cast("string"), F.col("event_type"),
              F.lit("N"), F.lit("1"), _ts_text("pickup"), _ts_text("dropoff"), F.lit("1"), F.lit("0"),
              F.lit("0"), F.col("lon").cast("string"), F.col("lat").cast("string"), lon_txt,
              F.col("lat").cast("string")]
    good = F.concat_ws(",", *fields)
    short = F.concat_ws(",", *fields[:13])
    long_ = F.concat_ws(",", *fields, F.lit("extra"))
    bad_ts = F.concat_ws(",", *fields[:5], F.lit("not a time"), *fields[6:])
    lines = t.select(F.explode(F.array(good, short, long_, bad_ts)).alias("value"))
    header = spark.range(1).select(F.concat_ws(",", F.lit("medallion"), *[F.lit(f"c{i}") for i in range(1, 14)])
                                   .alias("value"))
    return lines.unionByName(header)


def clean_trips(spark, sf_dir) -> DataFrame:
    """Trips with 0 <= duration hours < 3 and no (0, 0) point."""
    t = filter_duration(fx.trips(spark, sf_dir), "pickup", "dropoff")
    return filter_zero_point(t, ("lon", "lat"))


def with_region(df: DataFrame, spark) -> DataFrame:
    return point_in_polygon(df, "lon", "lat", fx.regions(spark), region_rank(), out_col="region")


def gaps(spark, sf_dir) -> DataFrame:
    """(event_id, next_event_id, region of the first drop-off, gap_us) for
    consecutive trips of a license inside one session."""
    t = with_region(clean_trips(spark, sf_dir), spark)
    p = consecutive_pairs(t, "license", "pickup", "event_id", carry=["event_id"], gap_us=GAP_US)
    return p.select("event_id", F.col("next_event_id"), "region",
                    elapsed_us("dropoff", "next_pickup").alias("gap_us"),
                    "dropoff", "next_pickup")


def q_scan_trips_csv(spark, sf_dir):
    t = parse_trips(trip_lines(spark, sf_dir))
    return t.select(F.col("trip_id").try_cast("bigint").alias("trip_id"), "license",
                    epoch_micros("pickup").alias("pickup_us"), epoch_micros("dropoff").alias("dropoff_us"),
                    "pickup_lon", "pickup_lat", "dropoff_lon", "dropoff_lat")


def q_parse_timestamp(spark, sf_dir):
    t = fx.trips(spark, sf_dir)
    txt = F.explode(F.array(F.struct(F.lit("good").alias("variant"), _ts_text("pickup").alias("s")),
                            F.struct(F.lit("junk").alias("variant"),
                                     F.concat(F.lit("x"), _ts_text("pickup")).alias("s"))))
    v = t.select("event_id", txt.alias("v"))
    return v.select("event_id", F.col("v.variant").alias("variant"),
                    epoch_micros(parse_timestamp(F.col("v.s"))).alias("ts_us"))


def q_parse_point(spark, sf_dir):
    t = parse_trips(trip_lines(spark, sf_dir))
    return t.select(F.col("trip_id").try_cast("bigint").alias("trip_id"),
                    "pickup_lon", "pickup_lat", "dropoff_lon", "dropoff_lat")


def q_floor_hours(spark, sf_dir):
    t = fx.trips(spark, sf_dir)
    return count_by_value(t.select(floor_hours("pickup", "dropoff").alias("hours")), "hours")


def q_filter_duration(spark, sf_dir):
    return filter_duration(fx.trips(spark, sf_dir), "pickup", "dropoff").select("event_id")


def q_point_in_polygon(spark, sf_dir):
    t = filter_duration(fx.trips(spark, sf_dir), "pickup", "dropoff")
    return count_by_value(with_region(t, spark), "region")


def q_filter_zero_point(spark, sf_dir):
    return count_by_value(with_region(clean_trips(spark, sf_dir), spark), "region")


def q_sessionize(spark, sf_dir):
    t = fx.trips(spark, sf_dir).select("event_id", "license", "pickup")
    return sessionize(t, "license", "pickup", "event_id", GAP_US).select("license", "event_id", "session_no")


def q_secondary_sort(spark, sf_dir):
    t = fx.trips(spark, sf_dir).select("event_id", "license", "pickup")
    return ordered_position(t, "license", "pickup", "event_id").select("license", "event_id", "pos")


def q_epoch_millis(spark, sf_dir):
    return fx.trips(spark, sf_dir).select("event_id", epoch_millis("pickup").alias("pickup_ms"))


def q_consecutive_gap(spark, sf_dir):
    return gaps(spark, sf_dir).select("event_id", "next_event_id", "region", "gap_us")


def q_gap_hour_histogram(spark, sf_dir):
    g = gaps(spark, sf_dir)
    return count_by_value(g.select(floor_hours("dropoff", "next_pickup").alias("gap_hours")), "gap_hours")


def q_filter_nonneg_gap(spark, sf_dir):
    g = filter_nonneg_gap(gaps(spark, sf_dir), "dropoff", "next_pickup")
    return g.select("event_id", whole_seconds("dropoff", "next_pickup").alias("gap_s"))


def q_stats_by_group(spark, sf_dir):
    g = filter_nonneg_gap(gaps(spark, sf_dir), "dropoff", "next_pickup")
    g = g.select("region", whole_seconds("dropoff", "next_pickup").alias("gap_s"))
    s = stats_by_group(g, "region", "gap_s")
    return s.select("region", "n", *[F.round(c, 6).alias(c) for c in ("mean", "stdev", "min", "max")])


def region_geojson_text(spark, sf_dir) -> DataFrame:
    """A GeoJSON FeatureCollection built from the ``region`` table: region k
    is the unit-high rectangle [2k, 2k + 1 + k/2] x [0, 1 + k] (a polygon
    list is one document, so the features are gathered into one row; its
    size is the number of regions)."""
    r = fx.table(spark, sf_dir, "region")
    k = F.col("r_regionkey").cast("double")
    x0, x1, y1 = k * 2, k * 2 + 1 + k / 2, k + 1
    ring = F.array(F.array(x0, F.lit(0.0)), F.array(x1, F.lit(0.0)), F.array(x1, y1), F.array(x0, y1),
                   F.array(x0, F.lit(0.0)))
    feat = F.struct(F.lit("Feature").alias("type"),
                    F.create_map(F.lit("boroughCode"), F.col("r_regionkey").cast("string"),
                                 F.lit("borough"), F.col("r_name")).alias("properties"),
                    F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"))
    return r.agg(F.to_json(F.struct(F.lit("FeatureCollection").alias("type"),
                                    F.collect_list(feat).alias("features"))).alias("value"))


def q_scan_geojson(spark, sf_dir):
    out = f"{checkpoint_dir(spark).rstrip('/')}/regions-{uuid.uuid4().hex}"
    region_geojson_text(spark, sf_dir).coalesce(1).write.text(out)
    g = read_geojson(spark, out)
    return g.select("code", "name", F.round("area", 6).alias("area"), "min_x", "min_y", "max_x", "max_y",
                    F.size("edges").cast("bigint").alias("n_edges"))


QUERIES = {
    "scan_geojson": q_scan_geojson,
    "scan_trips_csv": q_scan_trips_csv,
    "parse_timestamp": q_parse_timestamp,
    "parse_point": q_parse_point,
    "floor_hours": q_floor_hours,
    "filter_duration": q_filter_duration,
    "point_in_polygon": q_point_in_polygon,
    "filter_zero_point": q_filter_zero_point,
    "sessionize": q_sessionize,
    "secondary_sort": q_secondary_sort,
    "epoch_millis": q_epoch_millis,
    "consecutive_gap": q_consecutive_gap,
    "gap_hour_histogram": q_gap_hour_histogram,
    "filter_nonneg_gap": q_filter_nonneg_gap,
    "stats_by_group": q_stats_by_group,
}

# ---------------------------------------------------------------- oracle SQL
_US = "(epoch_us({b}) - epoch_us({a}))"
_HOURS = "CAST(FLOOR((epoch_us({b}) - epoch_us({a})) / 3600000000.0) AS BIGINT)"
_SECS = "CAST(FLOOR((epoch_us({b}) - epoch_us({a})) / 1000000.0) AS BIGINT)"
_CLEAN = ("SELECT * FROM trips WHERE " + _HOURS.format(a="pickup", b="dropoff") + " >= 0 AND "
          + _HOURS.format(a="pickup", b="dropoff") + " < 3")
_REGION = """
SELECT c.*, b.name AS region FROM {src} c LEFT JOIN (
  SELECT event_id, name FROM (
    SELECT event_id, name, ROW_NUMBER() OVER (PARTITION BY event_id ORDER BY code, area DESC, name) AS rk
    FROM (SELECT p.event_id, e.code, e.name, e.area, SUM({cross}) AS cr
          FROM {src} p CROSS JOIN edges e GROUP BY p.event_id, e.code, e.name, e.area) x
    WHERE cr % 2 = 1) y WHERE rk = 1) b ON c.event_id = b.event_id"""


def _region_sql(src: str) -> str:
    from tabulon.functions.geometry import CROSSING_SQL
    return _REGION.format(src=src, cross=CROSSING_SQL.format(px="p.lon", py="p.lat"))


_GAPS = duck.with_ctes(
    "SELECT event_id, next_event_id, region, dropoff, next_pickup, "
    + _US.format(a="dropoff", b="next_pickup") + " AS gap_us FROM p WHERE next_pickup IS NOT NULL AND "
    + _US.format(a="pickup", b="next_pickup") + " < 14400000000",
    trips=duck.F_TRIPS, edges=duck.region_edges_sql(),
    clean=_CLEAN + " AND NOT (lon = 0.0 AND lat = 0.0)",
    reg=_region_sql("clean"),
    p="SELECT *, LEAD(pickup) OVER w AS next_pickup, LEAD(event_id) OVER w AS next_event_id FROM reg "
      "WINDOW w AS (PARTITION BY license ORDER BY pickup, event_id)")


def oracle() -> dict:
    return {
        "scan_geojson": "SELECT r_regionkey AS code, r_name AS name, ROUND((1 + r_regionkey / 2.0) * (r_regionkey + 1), 6) "
                        "AS area, CAST(2 * r_regionkey AS DOUBLE) AS min_x, 0.0::DOUBLE AS min_y, "
                        "2 * r_regionkey + 1 + r_regionkey / 2.0 AS max_x, CAST(r_regionkey + 1 AS DOUBLE) AS max_y, "
                        "CAST(5 AS BIGINT) AS n_edges FROM region",
        "scan_trips_csv": duck.with_ctes(
            "SELECT event_id AS trip_id, CAST(license AS VARCHAR) AS license, "
            "epoch_us(date_trunc('second', pickup)) AS pickup_us, epoch_us(date_trunc('second', dropoff)) AS dropoff_us, "
            "lon AS pickup_lon, lat AS pickup_lat, lon AS dropoff_lon, lat AS dropoff_lat FROM trips",
            trips=duck.F_TRIPS),
        "parse_timestamp": duck.with_ctes(
            "SELECT event_id, 'good' AS variant, epoch_us(date_trunc('second', pickup)) AS ts_us FROM trips "
            "UNION ALL SELECT event_id, 'junk' AS variant, CAST(NULL AS BIGINT) AS ts_us FROM trips",
            trips=duck.F_TRIPS),
        "parse_point": duck.with_ctes(
            "SELECT event_id AS trip_id, lon AS pickup_lon, lat AS pickup_lat, lon AS dropoff_lon, lat AS dropoff_lat "
            "FROM trips", trips=duck.F_TRIPS),
        "floor_hours": duck.with_ctes(
            "SELECT " + _HOURS.format(a="pickup", b="dropoff") + " AS hours, COUNT(*) AS n FROM trips GROUP BY 1",
            trips=duck.F_TRIPS),
        "filter_duration": duck.with_ctes("SELECT event_id FROM (" + _CLEAN + ") c", trips=duck.F_TRIPS),
        "point_in_polygon": duck.with_ctes(
            "SELECT region, COUNT(*) AS n FROM reg GROUP BY region",
            trips=duck.F_TRIPS, edges=duck.region_edges_sql(), clean=_CLEAN, reg=_region_sql("clean")),
        "filter_zero_point": duck.with_ctes(
            "SELECT region, COUNT(*) AS n FROM reg GROUP BY region",
            trips=duck.F_TRIPS, edges=duck.region_edges_sql(),
            clean=_CLEAN + " AND NOT (lon = 0.0 AND lat = 0.0)", reg=_region_sql("clean")),
        "sessionize": duck.with_ctes(
            "SELECT license, event_id, CAST(SUM(CASE WHEN prev IS NULL OR " + _US.format(a="prev", b="pickup")
            + " >= 14400000000 THEN 1 ELSE 0 END) OVER (PARTITION BY license ORDER BY pickup, event_id "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS session_no FROM l",
            trips=duck.F_TRIPS,
            l="SELECT *, LAG(pickup) OVER (PARTITION BY license ORDER BY pickup, event_id) AS prev FROM trips"),
        "secondary_sort": duck.with_ctes(
            "SELECT license, event_id, ROW_NUMBER() OVER (PARTITION BY license ORDER BY pickup, event_id) AS pos "
            "FROM trips", trips=duck.F_TRIPS),
        "epoch_millis": duck.with_ctes("SELECT event_id, epoch_us(pickup) / 1000.0 AS pickup_ms FROM trips",
                                       trips=duck.F_TRIPS),
        "consecutive_gap": "SELECT event_id, next_event_id, region, gap_us FROM (" + _GAPS + ") g",
        "gap_hour_histogram": "SELECT " + _HOURS.format(a="dropoff", b="next_pickup")
                              + " AS gap_hours, COUNT(*) AS n FROM (" + _GAPS + ") g GROUP BY 1",
        "filter_nonneg_gap": "SELECT event_id, " + _SECS.format(a="dropoff", b="next_pickup") + " AS gap_s FROM ("
                             + _GAPS + ") g WHERE " + _SECS.format(a="dropoff", b="next_pickup") + " >= 0",
        "stats_by_group": "SELECT region, COUNT(gap_s) AS n, ROUND(AVG(gap_s), 6) AS mean, "
                          "ROUND(STDDEV_POP(gap_s), 6) AS stdev, ROUND(MIN(gap_s), 6) AS min, "
                          "ROUND(MAX(gap_s), 6) AS max FROM (SELECT region, CAST("
                          + _SECS.format(a="dropoff", b="next_pickup") + " AS DOUBLE) AS gap_s FROM ("
                          + _GAPS + ") g) s WHERE gap_s >= 0 GROUP BY region",
    }
