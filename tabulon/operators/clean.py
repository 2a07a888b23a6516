"""Row filters and projections used by the cleaning steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.functions.time import floor_hours, whole_seconds


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def valid_int(col) -> Column:
    """True when the text parses as a 64-bit integer."""
    return F.expr(f"try_cast({col} AS BIGINT)").isNotNull() if isinstance(col, str) \
        else col.try_cast("bigint").isNotNull()


def filter_valid_int(df: DataFrame, col: str) -> DataFrame:
    return df.where(valid_int(col))


def filter_duration(df: DataFrame, start: str, end: str, lo: int = 0, hi: int = 3) -> DataFrame:
    """Keep rows whose floored elapsed hours h satisfy lo <= h < hi."""
    h = floor_hours(start, end)
    return df.where((h >= lo) & (h < hi))


def has_zero_point(*pairs: tuple[str, str]) -> Column:
    """True when any (lon, lat) pair is exactly (0, 0)."""
    cond = F.lit(False)
    for lon, lat in pairs:
        cond = cond | ((F.col(lon) == 0.0) & (F.col(lat) == 0.0))
    return cond


def filter_zero_point(df: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
    return df.where(~has_zero_point(*pairs))


def filter_nonneg_gap(df: DataFrame, start: str, end: str) -> DataFrame:
    """Keep rows whose whole elapsed seconds are >= 0."""
    return df.where(whole_seconds(start, end) >= 0)


def filter_articles(df: DataFrame, title: str = "title", ns: str = "ns",
                    text: str = "text") -> DataFrame:
    """Encyclopedia articles only: namespace 0, not a redirect (the first 50
    characters hold '#REDIRECT' or '#redirect'), title not a disambiguation."""
    head = F.substring(F.col(text), 1, 50)
    redirect = head.contains("#REDIRECT") | head.contains("#redirect")
    return df.where((F.col(ns) == 0) & ~redirect & ~F.col(title).contains("(disambiguation)"))


def major_topics(col) -> Column:
    """Descriptor names flagged major ('Y'); a null list gives an empty array."""
    arr = _c(col)
    return F.transform(F.filter(F.coalesce(arr, F.array()), lambda x: x["_MajorTopicYN"] == "Y"),
                       lambda x: x["_VALUE"])


def filter_min_count(df: DataFrame, key: str, min_rows: int) -> DataFrame:
    """Keep groups with at least ``min_rows`` rows (partial-aggregated count
    joined back with a semi join)."""
    big = df.groupBy(key).count().where(F.col("count") >= min_rows).select(key)
    return df.join(big, key, "left_semi")
