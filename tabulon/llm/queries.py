"""Registered queries of the training-data operators and their oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabulon.llm import bpe, chat, decontaminate, html, lines, maxent, negatives, oracle, pii, quality, repeats, runs, secrets, simhash
from tabulon.llm.base import table


def tokenizer_file() -> str:
    """The installed vocabulary file that the token queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_repeats(spark, sf_dir):
    left = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op2_chat(spark, sf_dir):
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    more = [spark.range(1).select(F.lit(-7).cast("bigint").alias("conv_id"), F.lit(i).cast("bigint").alias("turn"),
                                  F.lit(role).alias("role"), F.lit(said).alias("text")) for i, role in enumerate(("user", "assistant"))]
    windows = chat.format_chat(given.unionByName(more[0]).unionByName(more[1]))
    back = chat.read_back(windows)
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
                       F.char_length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


def op3_pii(spark, sf_dir):
    found = pii.sanitise(table(spark, sf_dir, "documents"), min_texts=1)
    counts = [F.size(F.filter("base", lambda b: b["k"] == k)).cast("bigint").alias(f"n_{kind}") for k, kind in enumerate(pii.KINDS[:4])]
    return found.select("doc_id", *counts, F.sha2(pii.written(F.col("base")), 256).alias("base_sha256"),
                        pii.written(F.col("spans")).alias("spans"))


def op5_html(spark, sf_dir):
    texts = html.extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return texts.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


def op4_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_quality(spark, sf_dir):
    q = quality.quality(table(spark, sf_dir, "documents"))
    return q.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_removed")


def op7_bpe(spark, sf_dir):
    return bpe.bpe_round_trip(table(spark, sf_dir, "documents"), tokenizer_file)


def op8_lines(spark, sf_dir):
    out = lines.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.char_length("text").cast("bigint").alias("n_chars_left"),
                      F.sha2("text", 256).alias("text_sha256"))


def op9_secrets(spark, sf_dir):
    return secrets.findings(table(spark, sf_dir, "documents"))


def op10_winnow(spark, sf_dir):
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


def op11_runs(spark, sf_dir):
    found = runs.periodic_runs(runs.with_periods(table(spark, sf_dir, "documents")))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
                        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_negatives(spark, sf_dir):
    given = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(given.select("vec_id", moved.alias("label"), "embedding"))


def op13_maxent(spark, sf_dir):
    return maxent.language_scores(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_repeats": op1_repeats,
    "op2_chat": op2_chat,
    "op3_pii": op3_pii,
    "op4_simhash": op4_simhash,
    "op5_html": op5_html,
    "op6_quality": op6_quality,
    "op7_bpe": op7_bpe,
    "op8_lines": op8_lines,
    "op9_secrets": op9_secrets,
    "op10_winnow": op10_winnow,
    "op11_runs": op11_runs,
    "op12_negatives": op12_negatives,
    "op13_maxent": op13_maxent,
}

#: The others have no SQL form (XXH64 fingerprints, BPE, parsers, windows of
#: formatted text, a trained forest, byte-wise suffix matches): their tests
#: hold them against brute force.
ORACLE = {
    "op6_quality": oracle.QUALITY,
    "op8_lines": oracle.LINE_DEDUP,
    "op10_winnow": oracle.WINNOW,
    "op12_negatives": oracle.HARD_NEGATIVES,
}
