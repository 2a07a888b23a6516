"""Benchmark decontamination by winnowing, as DataFrame functions only.

Words are lower-cased (A-Z) runs of ASCII letters, digits and non-ASCII
characters. A window is ``window`` consecutive words of a benchmark item (an
item of fewer words, but not none, is one window). Both sides keep, of every
``window - k + 1`` consecutive k-grams, the one with the smallest hash; any
span of ``window`` shared words holds one such stretch, so its fingerprint is
on both sides. A semi join on the fingerprints (benchmark side broadcast
behind a size check, else shuffled) leaves the candidate documents; in them
each hit is extended to whole windows: all runs of ``window`` words meet the
benchmark's windows in an equi join. Items shorter than a window have no
guaranteed fingerprint; the whole-item hash of each such length is matched
against all documents' runs of that length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.llm.base import cut, grams, let, on_key, pieces, row_key, small

WINDOW = 10
K = 5
#: Rows of (hash, hash, length) below which the benchmark side is broadcast.
BROADCAST_ROWS = 500_000
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
UNFOLDED = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"  # the same before A-Z is lower-cased
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def bench_words(text: Column) -> Column:
    """Words with A-Z lower-cased and nothing else changed."""
    return pieces(F.translate(text, UPPER, LOWER), SEPARATOR)


def loose_hashes(text: Column) -> Column:
    """Hash of each word with all its letters lower-cased. Lower-casing may
    look at neighbouring letters (a final sigma), so every word is lower-cased
    by itself: equal ``bench_words`` have equal hashes, at a lower price than
    a translation of whole texts."""
    return F.transform(pieces(text, UNFOLDED), lambda w: F.xxhash64(F.lower(w)))


def winnow(hashes: Column, k: int, window: int) -> Column:
    """Distinct minima of the k-gram hashes over every ``window`` words."""
    many = window - k + 1
    return let(grams(hashes, k), lambda g: F.when(
        F.size(g) >= many, F.array_distinct(F.transform(
            F.sequence(F.lit(1), F.size(g) - (many - 1)), lambda j: F.array_min(F.slice(g, j, many)))))
        .otherwise(F.array().cast("array<bigint>")))


def _runs(words: Column, lengths: list[int]) -> Column:
    """(pos, len, h, g) of every run of words of the given lengths; two
    independent hashes identify a run."""
    none = F.array().cast("array<struct<pos:int,len:int,h:bigint,g:int>>")
    parts = [F.when(F.size(words) >= n, F.transform(F.sequence(F.lit(1), F.size(words) - (n - 1)), lambda i: F.struct(
        i.alias("pos"), F.lit(n).alias("len"), F.xxhash64(F.slice(words, i, n)).alias("h"),
        F.hash(F.slice(words, i, n)).alias("g")))).otherwise(none) for n in lengths]
    return F.concat(*parts)


def decontaminate(docs: DataFrame, bench: DataFrame, doc: str = "doc_id", text: str = "text", item: str = "item_id",
                  item_text: str = "text", window: int = WINDOW, k: int = K) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit (words inside an
    occurrence of a window), item_ids (items with an occurrence, sorted as
    strings), contaminated, and th, the text's hash, which tells rows with
    one id apart. Null or empty texts have no words and no hits; null item
    ids are left out of item_ids; an item counts once however often it
    occurs; an empty benchmark contaminates nothing."""
    items = bench.select(F.col(item).cast("string").alias("item_id"), bench_words(F.col(item_text)).alias("w"))
    n = F.size("w")
    windows = items.select("item_id", F.explode(F.when(n >= window, _runs(F.col("w"), [window])).when(
        n > 0, F.array(F.struct(F.lit(1).alias("pos"), n.alias("len"), F.xxhash64("w").alias("h"), F.hash("w").alias("g"))))).alias("r"))
    windows = cut(windows.select("item_id", "r.len", "r.h", "r.g").distinct())
    short = sorted(r[0] for r in windows.where(F.col("len") < window).select("len").distinct().collect())

    loose = bench.select(loose_hashes(F.col(item_text)).alias("wh"))
    prints = loose.where(F.size("wh") >= window).select(F.explode(winnow(F.col("wh"), k, window)).alias("fp"))
    if short:
        whole = loose.where(F.size("wh").between(1, window - 1)).select(F.xxhash64("wh").alias("fp"))
        prints = prints.union(whole)
    prints = cut(prints.distinct())

    keyed = docs.select(*row_key(doc, text), F.col(text).alias("text"))
    found = let(loose_hashes(F.col("text")), lambda wh: F.struct(
        F.size(wh).cast("bigint").alias("n_words"),
        F.concat(winnow(wh, k, window), *[grams(wh, m) for m in short]).alias("fps")))
    # every document's word count and the documents that hold a fingerprint
    # come from one pass: the count rides along as a row without fingerprint
    counted = keyed.select("doc_id", "th", found.alias("f")).select(
        "doc_id", "th", "f.n_words", F.explode_outer(F.concat(F.array(F.lit(None).cast("bigint")), "f.fps")).alias("fp"))
    marks = prints.withColumn("hit", F.lit(True))
    met = counted.join(small(marks, BROADCAST_ROWS), "fp", "left").where("fp is null or hit")
    per_row = cut(met.groupBy("doc_id", "th", "n_words").agg(F.count_if(F.col("hit")).alias("n_prints"), F.count_if(F.col("fp").isNull()).alias("copies")))

    suspects = cut(per_row.where("n_prints > 0").select("doc_id", "th"))
    texts = on_key(keyed, small(suspects, BROADCAST_ROWS), "left_semi").dropDuplicates(["doc_id", "th"])
    runs = texts.select("doc_id", "th", F.explode(let(bench_words(F.col("text")), lambda w: _runs(w, [window, *short]))).alias("r"))
    runs = runs.select("doc_id", "th", "r.*")
    known = cut(windows.select("len", "h", "g").distinct())
    hits = cut(runs.join(small(known, BROADCAST_ROWS), ["len", "h", "g"], "left_semi"))

    spans = F.sort_array(F.collect_list(F.struct("pos", "len")))
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("n"))
    covered = F.aggregate("spans", zero, lambda a, s: F.struct(
        F.greatest(a["end"], s["pos"] + s["len"]).alias("end"),
        (a["n"] + F.greatest(F.lit(0), s["pos"] + s["len"] - F.greatest(a["end"], s["pos"]))).alias("n")), lambda a: a["n"])
    n_hit = hits.groupBy("doc_id", "th").agg(spans.alias("spans")).select("doc_id", "th", covered.alias("n_hit"))
    # windows held by the same items are one class: a document meets the set
    # of items once, however many of its windows it holds
    sets = windows.where("item_id is not null").groupBy("len", "h", "g").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    sets = cut(sets.withColumns({"set": F.xxhash64("items"), "set2": F.hash(F.size("items"), F.col("items"))}))
    classes = cut(sets.dropDuplicates(["set", "set2"]).select("set", "set2", "items"))
    pairs = hits.join(small(sets.drop("items"), BROADCAST_ROWS), ["len", "h", "g"]).select("doc_id", "th", "set", "set2").distinct()
    ids = pairs.join(classes, ["set", "set2"]).groupBy("doc_id", "th").agg(
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("item_ids"))
    out = on_key(on_key(per_row, n_hit), ids)
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return out.select("doc_id", "th", "n_words", F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
                      F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
                      (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))
