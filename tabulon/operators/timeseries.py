"""Price histories on a long (series, dt, value) table.

No step keeps a whole series in one task: trimming uses per-series
min/max aggregates, the as-of fill runs its window over (series, month) with
a small per-month carry table, and returns use a business-day index so the
10-row window becomes an equi join on (series, index)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# A Monday: business-day ordinals are counted from here.
_ANCHOR = _dt.date(1970, 1, 5)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def business_day_ordinal(d) -> Column:
    """Weekdays elapsed since a fixed Monday: 5 per whole week plus the
    weekday (capped at 5 for Saturday/Sunday). Strictly increasing over
    weekdays, so it numbers a weekday calendar without a window."""
    x = F.datediff(_c(d), F.lit(_ANCHOR.isoformat()).cast("date"))
    return (F.floor(x / 7) * 5 + F.least(F.pmod(x, F.lit(7)), F.lit(5))).cast("bigint")


def weekday_calendar(series: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """(key, dt) for every Monday..Friday in [start, end) for each key."""
    days = F.explode(F.sequence(F.lit(start).cast("date"), F.date_sub(F.lit(end).cast("date"), 1))).alias("dt")
    return series.select(key).distinct().select(key, days).where(F.weekday("dt") < 5)


def trim_date_range(df: DataFrame, key: str, dt: str, value: str, start: str, end: str) -> DataFrame:
    """Keep rows in [start, end]; where a series' first kept date is after
    ``start`` add (start, first value), where its last is before ``end`` add
    (end, last value)."""
    s, e = F.lit(start).cast("date"), F.lit(end).cast("date")
    kept = df.where((F.col(dt) >= s) & (F.col(dt) <= e)).select(key, dt, value)
    edges = kept.groupBy(key).agg(F.min(dt).alias("_first"), F.max(dt).alias("_last"),
                                  F.min_by(value, dt).alias("_fv"), F.max_by(value, dt).alias("_lv"))
    pad_start = edges.where(F.col("_first") != s).select(key, s.alias(dt), F.col("_fv").alias(value))
    pad_end = edges.where(F.col("_last") != e).select(key, e.alias(dt), F.col("_lv").alias(value))
    return kept.unionByName(pad_start).unionByName(pad_end)


def asof_fill(prices: DataFrame, calendar: DataFrame, key: str, dt: str, value: str) -> DataFrame:
    """For each calendar (key, dt): the value of the latest price dated on or
    before dt (as-of semantics; a price on a weekend is carried to the next
    weekday). Null before the first price.

    Window over (key, month) + carry of the last price of earlier months
    from a per-(key, month) summary."""
    mon = lambda c: (F.year(c) * 12 + F.month(c)).cast("int")
    p = prices.select(key, dt, value, F.lit(0).alias("_cal"))
    c = calendar.select(key, dt, F.lit(None).cast("double").alias(value), F.lit(1).alias("_cal"))
    u = p.unionByName(c).withColumn("_m", mon(F.col(dt)))
    w = Window.partitionBy(key, "_m").orderBy(dt, "_cal").rowsBetween(Window.unboundedPreceding, 0)
    u = u.withColumn("_fill", F.last(value, ignorenulls=True).over(w))
    # carry: the last price of any earlier month, over a one-row-per-month table
    last_per_month = p.withColumn("_m", mon(F.col(dt))).groupBy(key, "_m").agg(F.max_by(value, dt).alias("_lv"))
    cal_months = c.select(key, mon(F.col(dt)).alias("_m")).distinct().select(key, "_m", F.lit(None).cast("double").alias("_lv"))
    months = last_per_month.unionByName(cal_months).groupBy(key, "_m").agg(F.max("_lv").alias("_lv"))
    carry = months.select(key, "_m", F.last("_lv", ignorenulls=True).over(
        Window.partitionBy(key).orderBy("_m").rowsBetween(Window.unboundedPreceding, -1)).alias("_carry"))
    out = u.where("_cal = 1").join(carry, [key, "_m"], "left")
    return out.select(key, dt, F.coalesce("_fill", "_carry").alias(value))


def rolling_return(filled: DataFrame, key: str, dt: str, value: str, rows: int = 10,
                   out: str = "ret") -> DataFrame:
    """(key, idx, dt, ret): (v[i + rows - 1] - v[i]) / v[i] over a weekday
    calendar, full windows only. ``idx`` is the 0-based row number of the
    window's first day inside the key. The window end is found by an equi
    join on the business-day ordinal, not a per-key window."""
    b = filled.select(key, dt, value, business_day_ordinal(F.col(dt)).alias("_o"))
    first = b.groupBy(key).agg(F.min("_o").alias("_o0"))
    b = b.join(first, key)
    a = b.alias("a")
    z = b.select(key, (F.col("_o") - (rows - 1)).alias("_o"), F.col(value).alias("_v_end"))
    j = a.join(z, [key, "_o"])
    return j.select(key, (F.col("_o") - F.col("_o0")).alias("idx"), dt,
                    ((F.col("_v_end") - F.col(value)) / F.col(value)).alias(out))
