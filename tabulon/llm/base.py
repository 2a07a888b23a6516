"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.session import checkpoint_dir

#: ASCII white space; a word is a maximal run of anything else.
SPACE = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager)


def saved(df: DataFrame) -> DataFrame:
    """Cut the lineage with a Parquet table in the shared folder (smaller
    than a checkpoint, and later reads take only the columns they need)."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """Runs of non-white-space characters, in order (null text: none)."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), lambda w: w != "")


def let(value: Column, body) -> Column:
    """``body(v)`` with ``v`` bound to ``value``: a lambda variable is
    evaluated once per row, while a column used inside a lambda would be
    evaluated once per element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def same_key(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, root): the smallest id reachable over undirected edges, for every
    id that occurs in an edge. Large-star / small-star rounds (Kiveris et
    al. 2014) until the edge set stops changing; each round is checkpointed,
    and one aggregate (count and hash sum) compares it with the last."""
    e = edges.select(F.greatest(a, b).alias("x"), F.least(a, b).alias("y")).where("x <> y").distinct()
    e = cut(e)

    def state(d):
        r = d.agg(F.count(F.lit(1)), F.sum(F.xxhash64("x", "y").cast("decimal(20,0)"))).first()
        return r[0], r[1]

    last = state(e)
    while last[0]:
        both = e.union(e.select("y", "x")).toDF("u", "v")
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
        large = both.join(low, F.col("u") == F.col("c")).where("v > u").select(F.col("v").alias("x"), F.col("m").alias("y"))
        large = large.where("x <> y").distinct()
        low = large.groupBy("x").agg(F.min("y").alias("m"))
        moved = large.join(low.withColumnRenamed("x", "c"), F.col("x") == F.col("c")).select(F.col("y").alias("x"), F.col("m").alias("y"))
        nxt = cut(moved.union(low.select("x", F.col("m").alias("y"))).where("x <> y").distinct())
        now = state(nxt)
        e = nxt
        if now == last:
            break
        last = now
    out = e.groupBy("x").agg(F.min("y").alias("root")).withColumnRenamed("x", "id")
    roots = out.select(F.col("root").alias("id"), "root").distinct()
    return out.union(roots)


def pieces(text: Column, separator: str) -> Column:
    """Non-empty pieces between runs of ``separator``; split leaves an empty
    string at most at either end, so the ends are cut off."""
    def trim(a):
        first = (F.element_at(a, 1) == "").cast("int")
        last = (F.element_at(a, -1) == "").cast("int")
        return F.slice(a, first + 1, F.greatest(F.size(a) - first - last, F.lit(0)))
    return let(F.split(F.coalesce(text, F.lit("")), f"(?:{separator})+"), trim)


def row_key(doc: str = "doc_id", text: str = "text") -> list[Column]:
    """Key of a row: id and text hash. Rows with equal key are repeated rows
    and get equal results. Text hash of null differs from that of ''."""
    return [F.col(doc).alias("doc_id"), F.xxhash64(F.col(text).isNull(), F.col(text)).alias("th")]


def on_key(a: DataFrame, b: DataFrame, how: str = "left") -> DataFrame:
    """Join on (doc_id, th), null ids included; ``b`` loses its key columns
    and must hold a key once."""
    b = b.withColumnsRenamed({"doc_id": "_doc", "th": "_th"})
    out = a.join(b, a["doc_id"].eqNullSafe(b["_doc"]) & (a["th"] == b["_th"]), how)
    return out if how in ("left_semi", "left_anti") else out.drop("_doc", "_th")


def small(df: DataFrame, most: int) -> DataFrame:
    """``df``, to be broadcast if it has at most ``most`` rows, else joined
    by shuffle. ``df`` must be cut (checkpointed) and have narrow rows."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def grams(hashes: Column, n: int) -> Column:
    """Hash of each run of ``n`` elements (none if there are fewer)."""
    return F.when(F.size(hashes) >= n, F.transform(F.sequence(F.lit(1), F.size(hashes) - (n - 1)),
                                                   lambda i: F.xxhash64(F.slice(hashes, i, n)))) \
            .otherwise(F.array().cast("array<bigint>"))


def in_arrow(df: DataFrame, run, schema) -> DataFrame:
    """``df.mapInArrow``, with this package sent to the executors, which may
    not have it installed."""
    sc = df.sparkSession.sparkContext
    if not getattr(sc, "_tabulon_sent", False):
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        path = os.path.join(tempfile.mkdtemp(prefix="tabulon-code-"), "tabulon_code.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, names in os.walk(root):
                for name in sorted(names):
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.relpath(full, os.path.dirname(root)))
        sc.addPyFile(path)  # Spark's own file transfer, not a shared path
        sc._tabulon_sent = True
    return df.mapInArrow(run, schema)
