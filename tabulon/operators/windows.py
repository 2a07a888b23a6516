"""Running sums and positions inside a key without one task per key.

A window ``PARTITION BY key ORDER BY ...`` puts a whole key into one task.
When the ordering column can be cut into ordered buckets (time buckets, draw
blocks, score quantiles) the same result comes from a window over
(key, bucket) plus, per key, the totals of the earlier buckets -- a table
with one row per (key, bucket). A hot key is then spread over its buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabulon.session import cut


def bucketed_running_sum(df: DataFrame, key, bucket: str, order: list, value, out: str,
                         inclusive: bool = True) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows of the same key that
    come before (and, if ``inclusive``, at) each row in (bucket, order)
    order. ``bucket`` must be a column of ``df`` that is non-decreasing in
    ``order`` within a key."""
    keys = [key] if isinstance(key, str) else list(key)
    v = F.col(value) if isinstance(value, str) else value
    t = df.withColumn("_rs_v", v)
    frame_end = 0 if inclusive else -1
    w = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, frame_end)
    t = t.withColumn("_rs_local", F.coalesce(F.sum("_rs_v").over(w), F.lit(0)))
    offs = (t.groupBy(*keys, bucket).agg(F.sum("_rs_v").alias("_rs_tot"))
             .withColumn("_rs_off", F.coalesce(F.sum("_rs_tot").over(
                 Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
             .drop("_rs_tot"))
    return (t.join(offs, [*keys, bucket], "left")
             .withColumn(out, F.col("_rs_off") + F.col("_rs_local"))
             .drop("_rs_v", "_rs_local", "_rs_off"))


def bucketed_position(df: DataFrame, key, bucket: str, order: list, out: str = "pos") -> DataFrame:
    """1-based position of each row inside its key in (bucket, order) order
    (order must be total within a key for a deterministic result)."""
    r = bucketed_running_sum(df, key, bucket, order, F.lit(1).cast("bigint"), out)
    return r.withColumn(out, F.col(out).cast("bigint"))


def quantile_bucket(col, cuts: list[float]) -> Column:
    """Index of the bucket of ``col`` among ascending cut points (0..len)."""
    c = F.col(col) if isinstance(col, str) else col
    e = F.lit(0)
    for x in cuts:
        e = e + (c > F.lit(float(x))).cast("int")
    return e


def dense_index(df: DataFrame, col: str, out: str = "idx") -> DataFrame:
    """(col, out): the distinct values of ``col`` numbered 0.. in ascending
    order. Values are range-partitioned and sorted; a value's number is its
    place in its partition plus the sizes of the partitions before it, so
    only one row per partition meets in one task."""
    d = df.select(col).where(F.col(col).isNotNull()).distinct().repartitionByRange(col).sortWithinPartitions(col)
    d = cut(d.withColumn("_m", F.monotonically_increasing_id()))
    part, local = F.shiftright("_m", 33), F.col("_m").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = d.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    j = d.withColumn("_p", part).join(offsets, F.col("_p") == F.col("_part"))
    return j.select(col, (F.col("_before") + local).cast("bigint").alias(out))
