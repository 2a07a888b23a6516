"""Aggregations: frequency tables, summary statistics, moments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def count_by_value(df: DataFrame, *cols, count_col: str = "n") -> DataFrame:
    """Frequency table (partial + final hash aggregate)."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(count_col))


def summary_exprs(value, prefix: str = "") -> list[Column]:
    """count, mean, population stdev, min, max of one numeric column."""
    v = _c(value).cast("double")
    return [F.count(v).alias(f"{prefix}n"), F.avg(v).alias(f"{prefix}mean"),
            F.stddev_pop(v).alias(f"{prefix}stdev"), F.min(v).alias(f"{prefix}min"),
            F.max(v).alias(f"{prefix}max")]


def summary_stats(df: DataFrame, value, prefix: str = "") -> DataFrame:
    return df.agg(*summary_exprs(value, prefix))


def stats_by_group(df: DataFrame, key, value, prefix: str = "") -> DataFrame:
    """Mergeable per-key statistics (partial aggregation before the shuffle)."""
    return df.groupBy(key).agg(*summary_exprs(value, prefix))


def sum_by_key(df: DataFrame, key, value, out: str = "total") -> DataFrame:
    return df.groupBy(key).agg(F.sum(value).alias(out))


def freq_of_freq(counts: DataFrame, count_col: str = "n", out: str = "n_values") -> DataFrame:
    """How many values share each count."""
    return counts.groupBy(F.col(count_col).alias("count")).agg(F.count(F.lit(1)).alias(out))


def column_moments(df: DataFrame, vec: str, key_cols: tuple = ()) -> DataFrame:
    """Per vector position: n, sum, sum of squares, mean, population stdev
    sqrt(n*ss - s^2)/n. One aggregate with three sums a position (the longest
    vector's size is found first), partially aggregated, so no row is copied
    per position; the few result rows are then laid out by position.
    Positions that no vector of a group reaches have no row."""
    size = df.agg(F.max(F.size(F.col(vec))).alias("d")).first()["d"] or 0
    none = df.select(*key_cols, F.lit(0).alias("pos"), F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("s"), F.lit(0.0).alias("ss")).where(F.lit(False))
    if size > 0:
        aggs = []
        for i in range(size):
            x = F.get(F.col(vec), F.lit(i))
            aggs.append(F.struct(F.lit(i).alias("pos"), F.count(x).alias("n"), F.sum(x).alias("s"), F.sum(x * x).alias("ss"),
                                 F.count_if(F.size(F.col(vec)) > i).alias("m")))
        wide = df.groupBy(*key_cols).agg(F.array(*aggs).alias("_m"))
        none = wide.select(*key_cols, F.inline("_m")).where("m > 0")
    return none.select(*key_cols, "pos", "n", "s", "ss", (F.col("s") / F.col("n")).alias("mean"),
                       (F.sqrt(F.greatest(F.col("n") * F.col("ss") - F.col("s") * F.col("s"), F.lit(0.0)))
                        / F.col("n")).alias("stdev"))


def group_lists(df: DataFrame, key: str, value: str, chunk: int = 10_000, block: int = 1 << 16) -> DataFrame:
    """(key, chunk, n, values): the values of each key, ascending, as arrays
    of at most ``chunk`` elements. A key with more values gets several
    chunks, so no single array (or task) has to hold an unbounded group;
    positions come from a bucketed window over value blocks."""
    from tabulon.operators.windows import bucketed_position
    b = df.select(key, value).withColumn("_blk", F.floor(F.col(value) / F.lit(block)))
    p = bucketed_position(b, key, "_blk", [value], "_pos")
    g = p.groupBy(key, F.floor((F.col("_pos") - 1) / F.lit(chunk)).cast("bigint").alias("chunk"))
    return g.agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(value)).alias("values"))
