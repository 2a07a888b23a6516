"""Trip-line cleaning on a stream: parse, duration filter, zero-point filter
and drop-off region, each micro-batch handled by the batch operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.operators.clean import filter_duration, filter_zero_point
from tabulon.operators.geo import point_in_polygon
from tabulon.sources.text import parse_trips


def clean_trip_stream(spark: SparkSession, path: str, regions: DataFrame,
                      rank_cols: list | None = None) -> DataFrame:
    """A streaming DataFrame of cleaned trips with their drop-off region,
    reading new text files under ``path`` as they arrive. The region table
    is static and joined stream-static (broadcast behind the size check)."""
    lines = spark.readStream.format("text").load(path)
    t = parse_trips(lines)
    t = filter_duration(t, "pickup", "dropoff")
    t = filter_zero_point(t, ("pickup_lon", "pickup_lat"), ("dropoff_lon", "dropoff_lat"))
    ranks = rank_cols or [F.col("code"), -F.col("area")]
    return point_in_polygon(t, "dropoff_lon", "dropoff_lat", regions, ranks, out_col="region")
