"""The training-data pipeline over ``documents``.

Five stages, each the operator of its name on everything its predecessor
kept. All but the last return the columns of documents; the last returns
doc_id and the token counts and digests of the encoded and decoded text.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.llm import bpe, decontaminate, lines, quality, simhash
from tabulon.llm.base import on_key, row_key, table
from tabulon.llm.queries import tokenizer_file
from tabulon.session import checkpoint_dir


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows with their key beside the packed row."""
    return docs.select(*row_key(), F.struct("*").alias("_in"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; texts stay as they are."""
    kept = quality.quality(docs).where("kept").select("doc_id", "th").distinct()
    return on_key(_keyed(docs), kept, "left_semi").select("_in.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines go; every document stays."""
    return lines.dedup_lines(docs).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id (null
    ids last, then the smallest text hash) stays; of rows repeated under that
    id with that text, one."""
    doc, th = row_key()
    groups = simhash.near_duplicates(docs.select(F.struct(doc.isNull().alias("none"), doc, th).alias("key"), "text"), "key")
    first = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id.doc_id", "doc_id.th").distinct()
    kept = on_key(_keyed(docs), first, "left_semi")
    return kept.dropDuplicates(["doc_id", "th"]).select("_in.*")


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    bad = found.where("contaminated").select("doc_id", "th").distinct()
    return on_key(_keyed(docs), bad, "left_anti").select("_in.*")


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the encoded and decoded text."""
    return bpe.bpe_round_trip(docs, tokenizer_file)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("bpe_tokens", bpe_tokens),
]

#: XXH64 fingerprints and BPE have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``; each result is written as
    Parquet in the shared folder and read again as the next one's input."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{k}-{name}")
            docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
