"""Line-oriented text sources: play logs, id/name and alias lists, taxi trip
CSV lines, 4-space price histories and word lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.functions.time import parse_timestamp


def read_lines(spark: SparkSession, path: str, with_file: bool = False) -> DataFrame:
    """One row per line (column ``value``); ``file`` holds the source file name
    when requested (from the ``_metadata`` column, no driver-side listing)."""
    df = spark.read.text(path)
    if with_file:
        df = df.select("value", F.col("_metadata.file_name").alias("file"))
    return df


def _try_long(c):
    return c.try_cast("bigint")


def _try_double(c):
    return c.try_cast("double")


def parse_ratings(lines: DataFrame, col: str = "value") -> DataFrame:
    """'user item count' lines (single spaces) to (user_id, item_id, rating)."""
    f = F.split(F.col(col), " ")
    out = lines.select(_try_long(f[0]).alias("user_id"), _try_long(f[1]).alias("item_id"),
                       _try_double(F.try_element_at(f, F.lit(3))).alias("rating"))
    return out.where(F.col("user_id").isNotNull() & F.col("item_id").isNotNull()
                     & F.col("rating").isNotNull())


def parse_id_name(lines: DataFrame, col: str = "value") -> DataFrame:
    """'id<TAB>name' lines, split on the first tab only; the id must be an
    integer and a name must be present; the name is trimmed."""
    f = F.split(F.col(col), "\t", 2)
    out = lines.select(_try_long(f[0]).alias("item_id"),
                       F.trim(F.try_element_at(f, F.lit(2))).alias("name"))
    return out.where(F.col("item_id").isNotNull() & F.col("name").isNotNull())


def parse_alias(lines: DataFrame, col: str = "value") -> DataFrame:
    """'alias<TAB>canonical' lines; both must be integers, others dropped."""
    f = F.split(F.col(col), "\t")
    out = lines.select(_try_long(f[0]).alias("alias_id"),
                       _try_long(F.try_element_at(f, F.lit(2))).alias("item_id"))
    return out.where(F.col("alias_id").isNotNull() & F.col("item_id").isNotNull())


TRIP_FIELDS = 14
TRIP_HEADER_FIRST = "medallion"


def parse_trips(lines: DataFrame, col: str = "value") -> DataFrame:
    """Comma-separated trip lines with exactly 14 fields, header excluded:
    [1] license, [5] pickup, [6] dropoff, [10..13] pickup lon/lat, dropoff
    lon/lat. Any unparseable coordinate sets both points to (0, 0); lines
    with an unparseable timestamp are dropped."""
    f = F.split(F.col(col), ",", -1)
    kept = lines.select(f.alias("f")).where((F.size("f") == TRIP_FIELDS)
                                            & (F.col("f")[0] != TRIP_HEADER_FIRST))
    coords = [_try_double(F.col("f")[i]) for i in (10, 11, 12, 13)]
    ok = coords[0].isNotNull() & coords[1].isNotNull() & coords[2].isNotNull() & coords[3].isNotNull()
    out = kept.select(
        F.col("f")[1].alias("license"),
        parse_timestamp(F.col("f")[5]).alias("pickup"),
        parse_timestamp(F.col("f")[6]).alias("dropoff"),
        *[F.when(ok, c).otherwise(F.lit(0.0)).alias(n)
          for c, n in zip(coords, ("pickup_lon", "pickup_lat", "dropoff_lon", "dropoff_lat"))],
        F.col("f")[0].alias("trip_id"))
    return out.where(F.col("pickup").isNotNull() & F.col("dropoff").isNotNull())


def parse_price_tsv(lines: DataFrame, col: str = "value", series: str | None = None) -> DataFrame:
    """'Mon dd, yyyy<4 spaces>value' lines to (dt DATE, value DOUBLE)."""
    f = F.split(F.col(col), "    ")
    dt = F.to_date(F.try_to_timestamp(f[0], F.lit("MMM dd, yyyy")))
    cols = [dt.alias("dt"), _try_double(F.try_element_at(f, F.lit(2))).alias("value")]
    if series:
        cols.insert(0, F.col(series))
    return lines.select(*cols).where(F.col("dt").isNotNull() & F.col("value").isNotNull())


def parse_wordlist(lines: DataFrame, col: str = "value") -> DataFrame:
    """Words separated by any whitespace (a line may hold more than one),
    lower-cased, distinct."""
    w = lines.select(F.explode(F.split(F.trim(F.col(col)), r"\s+")).alias("word"))
    return w.select(F.lower("word").alias("word")).where(F.col("word") != "").distinct()
