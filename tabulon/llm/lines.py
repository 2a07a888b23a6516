"""Line dedup by distinct-site spread, as DataFrame functions only.

Every normalised line is hashed; a HyperLogLog sketch of the sites that carry
it is built per line by partial aggregation and merged by the shuffle.
Sketches settle the lines far from the threshold; lines whose estimate lies
within ``band`` of it get an exact distinct count. Equal texts are one text on
one site, the smallest of theirs, so that a page copied to many sites does not
turn its own lines into boilerplate. Lines on ``min_sites`` sites or more are
boilerplate and removed from every document, whatever is left of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.llm.base import SPACE, cut, let, on_key, row_key, small

MIN_SITES = 10
SKETCH_ERROR = 0.1   # relative standard deviation of the sketches
BAND = 0.5           # estimates within this share of the threshold are counted exactly
BROADCAST_ROWS = 200_000


def _hashed(line):
    """Hash of the normalised line; lines without a word hash to null."""
    return F.when(line.rlike(r"[^\x20\x09-\x0D]"), F.xxhash64(F.lower(F.trim(F.regexp_replace(line, SPACE + "+", " ")))))


def spread_lines(rows: DataFrame, min_sites: int = MIN_SITES, error: float = SKETCH_ERROR, band: float = BAND) -> DataFrame:
    """(lh) of the lines of ``rows(lh, site)`` on ``min_sites`` sites or more."""
    sketched = rows.groupBy("lh").agg(F.approx_count_distinct("site", error).alias("est"))
    sketched = cut(sketched.where(F.col("est") >= min_sites * (1 - band)))
    near = small(sketched.where(F.col("est") <= min_sites * (1 + band)).select("lh"), BROADCAST_ROWS)
    exact = rows.join(near, "lh", "left_semi").groupBy("lh").agg(F.countDistinct("site").alias("n")).where(F.col("n") >= min_sites)
    return sketched.where(F.col("est") > min_sites * (1 + band)).select("lh").union(exact.select("lh"))


def one_site_each(rows: DataFrame) -> DataFrame:
    """``rows(th, site, ..)`` with the site of a text (hash) that several
    sites carry replaced by the smallest of them."""
    sites = rows.select("th", "site").distinct().groupBy("th").agg(F.min("site").alias("_site"), F.count(F.lit(1)).alias("_n"))
    moved = cut(sites.where("_n > 1").select(F.col("th").alias("_moved"), "_site"))
    j = rows.join(small(moved, BROADCAST_ROWS), F.col("th") == F.col("_moved"), "left")
    return j.withColumn("site", F.coalesce("_site", "site")).drop("_moved", "_site")


def dedup_lines(docs: DataFrame, doc: str = "doc_id", text: str = "text", site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text``, and n_lines
    (lines with a word) and n_removed added (replacing columns of these
    names). The remaining lines stay joined by newlines as they were, blank
    ones included. Null text stays null; a null site is no site; a line
    counts once per site however often it is repeated; an empty table gives
    an empty one."""
    hashes = F.transform(F.split(F.col(text), "\n"), _hashed)
    lined = docs.select(*row_key(doc, text), F.col(site).alias("site"), hashes.alias("hs"))
    rows = one_site_each(lined.where("site is not null").select("th", "site", "hs"))
    rows = rows.select("site", F.explode(F.array_distinct("hs")).alias("lh")).where("lh is not null")
    spread = cut(spread_lines(rows, min_sites))
    held = lined.select("doc_id", "th", F.explode(F.array_distinct("hs")).alias("lh")).where("lh is not null")
    held = held.join(small(spread, BROADCAST_ROWS), "lh", "left_semi").groupBy("doc_id", "th").agg(F.collect_set("lh").alias("_gone"))
    extra = [c for c in ("n_lines", "n_removed", "_in") if c in docs.columns]
    packed = docs.drop(*extra).select(*row_key(doc, text), F.struct("*").alias("_in"))
    j = on_key(packed, held)
    t = F.col(f"_in.{text}")

    def cleaned(all_lines):
        gone = F.col("_gone")
        marked = F.transform(all_lines, lambda x: F.struct(x.alias("x"), F.coalesce(F.array_contains(gone, _hashed(x)), F.lit(False)).alias("g")))

        def settle(m):
            left = F.array_join(F.transform(F.filter(m, lambda x: ~x["g"]), lambda x: x["x"]), "\n")
            return F.struct(left.alias("text"), F.size(F.filter(m, lambda x: x["g"])).cast("bigint").alias("n"))
        return let(marked, settle)

    n_lines = F.size(F.filter(F.split(F.coalesce(t, F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))).cast("bigint")
    done = F.when(t.isNotNull() & F.col("_gone").isNotNull(), let(F.split(t, "\n"), cleaned))
    j = j.select("_in", done.alias("_d"), n_lines.alias("_n"))
    cols = [F.when(F.col("_d").isNotNull(), F.col("_d.text")).otherwise(t).alias(c) if c == text else F.col(f"_in.`{c}`").alias(c)
            for c in docs.columns if c not in extra]
    return j.select(*cols, F.col("_n").alias("n_lines"), F.coalesce("_d.n", F.lit(0).cast("bigint")).alias("n_removed"))
