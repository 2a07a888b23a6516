"""Quality rules with cross-document line frequency, as DataFrame functions.

Base rules look at one text (word count, share of words inside repeated
8-word windows). The corpus rule hashes every normalised line (white space
runs as one space, trimmed, lower-cased), counts per host the distinct
documents that hold it -- equal texts count once, so that a page copied many
times is no boilerplate -- and takes a line for boilerplate if more than
``max_docs`` documents and more than ``max_share`` of the host's documents
have it. Such lines are removed; a document left with fewer than
``min_words`` words, or with less than ``min_left`` of its words, is
depleted and rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.llm.base import SPACE, cut, grams, let, on_key, pieces, row_key, small

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
MAX_DOCS = 20       # a line in no more documents of a host is never boilerplate
MIN_LEFT = 0.3
SYMBOLS = r"[#*$%&|<>]"
BROADCAST_ROWS = 200_000


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words inside ``window``-word windows that occur twice or more: sort
    the window hashes with their positions, keep those equal to a neighbour,
    and add up the union of the windows at the kept positions."""
    def covered(s):
        def twin(x, i):
            return F.coalesce(x["h"] == F.get(s, i - 1)["h"], F.lit(False)) | F.coalesce(x["h"] == F.get(s, i + 1)["h"], F.lit(False))
        at = F.array_sort(F.transform(F.filter(s, twin), lambda x: x["i"]))
        zero = F.struct(F.lit(-window).alias("last"), F.lit(0).cast("bigint").alias("n"))
        return F.aggregate(at, zero, lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(window), p - a["last"])).alias("n")),
                           lambda a: a["n"])

    def count(h):
        pairs = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("bigint")).otherwise(let(F.sort_array(pairs), covered))

    return let(F.transform(words, lambda w: F.xxhash64(w)), lambda wh: let(grams(wh, window), count))


def lines(text: Column) -> Column:
    """Lines with a word."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def normal(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(line, SPACE + "+", " ")))


def base_rules(text: Column) -> Column:
    """Struct of n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    t = F.coalesce(text, F.lit(""))
    dup = let(lines(t), lambda a: F.size(a) - F.size(F.array_distinct(a)))
    per_word = let(pieces(t, SPACE), lambda w: F.struct(F.size(w).cast("bigint").alias("n_words"), repeated_words(w).alias("n_repeat_words")))
    return let(per_word, lambda p: F.struct(
        p["n_words"].alias("n_words"),
        (F.char_length(t) - F.regexp_count(t, F.lit(SPACE))).cast("bigint").alias("word_chars"),
        F.regexp_count(t, F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        dup.cast("bigint").alias("n_dup_lines"), p["n_repeat_words"].alias("n_repeat_words")))


def line_rows(docs: DataFrame, doc: str, text: str, host: str) -> DataFrame:
    """(doc_id, th, host, lh, n, words): every different line of a row."""
    rows = docs.select(*row_key(doc, text), F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"), F.col(text).alias("text"))
    each = F.transform(lines(F.col("text")), lambda x: F.struct(F.xxhash64(normal(x)).alias("lh"),
                                                               (F.regexp_count(x, F.lit(r"[^\x20\x09-\x0D]+"))).alias("words")))
    return rows.select("doc_id", "th", "host", F.explode(each).alias("l")).select("doc_id", "th", "host", "l.lh", "l.words")


def frequent_lines(rows: DataFrame, max_docs: int) -> DataFrame:
    """(host, lh) of the lines above the limit."""
    seen = rows.select("host", "lh", "th").distinct().groupBy("host", "lh").agg(F.count(F.lit(1)).alias("n"))
    return seen.where(F.col("n") > max_docs).select("host", "lh")


def quality(docs: DataFrame, doc: str = "doc_id", text: str = "text", host: str = "source", min_words: int = MIN_WORDS,
            max_repeat: int = MAX_REPEAT_PERCENT, max_docs: int = MAX_DOCS,
            min_left: float = MIN_LEFT) -> DataFrame:
    """One row per row of ``docs``: doc_id, th (text hash), n_words,
    word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    n_removed (words in lines above the limits), removed (those lines'
    hashes) and kept. Null text counts as empty (no words: base_failed); a
    null host is a host of its own; rows repeated in full count as one
    document and get one result each; an empty table gives an empty one."""
    rows = line_rows(docs, doc, text, host)
    limits = cut(frequent_lines(rows, max_docs))
    gone = rows.join(small(limits, BROADCAST_ROWS), ["host", "lh"])
    # a row repeated in full has each of its lines as often as it is repeated
    gone = gone.groupBy("doc_id", "th", "host").agg(F.sum("words").alias("n_all"), F.collect_set("lh").alias("removed"))
    keys = docs.select(*row_key(doc, text), F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"))
    again = keys.groupBy("doc_id", "th", "host").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    again = small(cut(again.withColumnsRenamed({"doc_id": "_doc", "th": "_th", "host": "_host"})), BROADCAST_ROWS)
    gone = gone.join(again, gone["doc_id"].eqNullSafe(again["_doc"]) & (gone["th"] == again["_th"]) & (gone["host"] == again["_host"]), "left")
    gone = gone.select("doc_id", "th", "host", (F.col("n_all") / F.coalesce("m", F.lit(1))).cast("bigint").alias("n_all"), "removed")
    per_host = docs.select(*row_key(doc, text), F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"), base_rules(F.col(text)).alias("b"))
    times = per_host.select("doc_id", "th", "host", "b.*")
    gone = gone.withColumnsRenamed({"doc_id": "_doc", "th": "_th", "host": "_host"})
    j = times.join(gone, times["doc_id"].eqNullSafe(gone["_doc"]) & (times["th"] == gone["_th"]) & (times["host"] == gone["_host"]), "left")
    removed = F.least(F.coalesce("n_all", F.lit(0)), F.col("n_words"))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words"))
    left = F.col("n_words") - F.col("n_removed")
    depleted = (F.col("n_removed") > 0) & ((left < min_words) | (left < min_left * F.col("n_words")))
    return j.withColumn("n_removed", removed.cast("bigint")).select(
        "doc_id", "th", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        "n_removed", F.coalesce("removed", F.array().cast("array<bigint>")).alias("removed"), (~failed & ~depleted).alias("kept"))
