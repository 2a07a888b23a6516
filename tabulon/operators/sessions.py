"""Sessionization and consecutive-event gaps, skew-safe.

The textbook plan is one window ``PARTITION BY key ORDER BY ts``: a single
task per key. When one key holds a large share of all rows that task becomes
the job. Here the window runs over ``(key, time bucket)`` instead, and the
only cross-bucket facts a row needs -- the last time of the previous
non-empty bucket and the first time of the next one, and how many sessions
started in earlier buckets -- come from a per-(key, bucket) summary that is
tiny next to the rows (one row per key and bucket). A hot key is thereby
spread over as many tasks as it has buckets; AQE skew handling splits what
is left.

Exchanges on the big side: one hash exchange on (key, bucket); the windows
and the joins with the summaries reuse that partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabulon.functions.time import US_PER_HOUR, elapsed_us, epoch_micros

DEFAULT_BUCKET_US = 24 * US_PER_HOUR


def neighbours(df: DataFrame, key: str, ts: str, tie: str,
               bucket_us: int = DEFAULT_BUCKET_US, prefix: str = "") -> DataFrame:
    """Add ``prev_ts`` and ``next_ts``: the time of the previous / next row of
    the same key in (ts, tie) order, null at the ends.

    Ties on ``ts`` are ordered by ``tie``; rows sharing a bucket boundary time
    are handled because buckets are disjoint and ordered.
    """
    b = f"{prefix}_bkt"
    t = df.withColumn(b, F.floor(epoch_micros(ts) / F.lit(float(bucket_us))).cast("bigint"))
    per_bucket = t.groupBy(key, b).agg(F.min(ts).alias(f"{b}_first"), F.max(ts).alias(f"{b}_last"))
    wb = Window.partitionBy(key).orderBy(b)
    per_bucket = per_bucket.select(
        key, b,
        F.lag(f"{b}_last").over(wb).alias(f"{b}_prev_last"),
        F.lead(f"{b}_first").over(wb).alias(f"{b}_next_first"))
    w = Window.partitionBy(key, b).orderBy(ts, tie)
    t = (t.withColumn("prev_ts", F.lag(ts).over(w))
          .withColumn("next_ts", F.lead(ts).over(w)))
    return (t.join(per_bucket, [key, b], "left")
             .withColumn("prev_ts", F.coalesce("prev_ts", f"{b}_prev_last"))
             .withColumn("next_ts", F.coalesce("next_ts", f"{b}_next_first"))
             .drop(f"{b}_prev_last", f"{b}_next_first"))


def sessionize(df: DataFrame, key: str, ts: str, tie: str, gap_us: int = 4 * US_PER_HOUR,
               session_col: str = "session_no", bucket_us: int = DEFAULT_BUCKET_US) -> DataFrame:
    """Number sessions per key: a row starts a new session when the time since
    the previous row of the key (by ``ts``, then ``tie``) is ``>= gap_us``.
    The first row of a key opens session 1.

    Note ``session_window`` is not a drop-in: it merges two events exactly one
    gap apart, this rule splits them.
    """
    b = "_s_bkt"
    t = neighbours(df, key, ts, tie, bucket_us, prefix="_s")
    starts = (F.col("prev_ts").isNull() | (elapsed_us("prev_ts", ts) >= F.lit(gap_us))).cast("int")
    t = t.withColumn("_start", starts)
    w = Window.partitionBy(key, b).orderBy(ts, tie).rowsBetween(Window.unboundedPreceding, 0)
    t = t.withColumn("_local", F.sum("_start").over(w))
    # sessions opened in earlier buckets of the same key (a small table)
    offs = (t.groupBy(key, b).agg(F.sum("_start").alias("_n"))
             .withColumn("_offset", F.coalesce(
                 F.sum("_n").over(Window.partitionBy(key).orderBy(b)
                                  .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
             .drop("_n"))
    return (t.join(offs, [key, b], "left")
             .withColumn(session_col, (F.col("_offset") + F.col("_local")).cast("bigint"))
             .drop(b, "_start", "_local", "_offset", "prev_ts", "next_ts"))


def consecutive_pairs(df: DataFrame, key: str, ts: str, tie: str, carry: list[str],
                      gap_us: int = 4 * US_PER_HOUR,
                      bucket_us: int = DEFAULT_BUCKET_US) -> DataFrame:
    """Sliding pairs (t1, t2) of consecutive rows inside one session.

    Two consecutive rows of a key are in the same session exactly when the
    second does not open a new one, i.e. ``t2.ts - t1.ts < gap_us``. So pairs
    need only ``next`` row values, not session numbers. ``carry`` columns of
    t2 are returned as ``next_<col>``.
    """
    b = "_p_bkt"
    t = df.withColumn(b, F.floor(epoch_micros(ts) / F.lit(float(bucket_us))).cast("bigint"))
    w = Window.partitionBy(key, b).orderBy(ts, tie)
    nxt = {c: F.lead(c).over(w) for c in [ts] + carry}
    t = t.select("*", *[v.alias(f"next_{c}") for c, v in nxt.items()])
    # the first row of the next non-empty bucket, for the last row of each bucket
    firsts = (t.groupBy(key, b)
               .agg(F.min_by(F.struct(*[F.col(c).alias(c) for c in [ts] + carry]),
                             F.struct(ts, tie)).alias("_first")))
    wb = Window.partitionBy(key).orderBy(b)
    firsts = firsts.select(key, b, F.lead("_first").over(wb).alias("_nb"))
    t = t.join(firsts, [key, b], "left")
    is_last = F.col(f"next_{ts}").isNull()
    t = t.select(*[F.col(c) for c in df.columns],
                 *[F.when(is_last, F.col("_nb")[c]).otherwise(F.col(f"next_{c}")).alias(f"next_{c}")
                   for c in [ts] + carry])
    same_session = elapsed_us(ts, f"next_{ts}") < F.lit(gap_us)
    return t.where(F.col(f"next_{ts}").isNotNull() & same_session)


def ordered_position(df: DataFrame, key: str, ts: str, tie: str, pos_col: str = "pos",
                     bucket_us: int = DEFAULT_BUCKET_US) -> DataFrame:
    """1-based position of each row inside its key, by (ts, tie): the
    secondary-sort order. Computed per (key, bucket) plus the row counts of
    earlier buckets, so no key is ever held by a single task."""
    b = "_o_bkt"
    t = df.withColumn(b, F.floor(epoch_micros(ts) / F.lit(float(bucket_us))).cast("bigint"))
    t = t.withColumn("_local", F.row_number().over(Window.partitionBy(key, b).orderBy(ts, tie)))
    offs = (t.groupBy(key, b).agg(F.count(F.lit(1)).alias("_n"))
             .withColumn("_offset", F.coalesce(
                 F.sum("_n").over(Window.partitionBy(key).orderBy(b)
                                  .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
             .drop("_n"))
    return (t.join(offs, [key, b], "left")
             .withColumn(pos_col, (F.col("_offset") + F.col("_local")).cast("bigint"))
             .drop(b, "_local", "_offset"))
