"""The pipeline: order, columns and what each stage decides."""

import random
import uuid

import corpus_pipeline
from tabulon.session import checkpoint_dir


def write(spark, docs, bench):
    folder = f"{checkpoint_dir(spark).rstrip('/')}/case-{uuid.uuid4().hex}"
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(bench, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def case():
    rnd = random.Random(12)
    text = lambda n: " ".join("".join(rnd.choice("abcdefghij") for _ in range(rnd.randrange(2, 9))) for _ in range(n))
    clean = [text(60) + "\n" + text(40) for _ in range(30)]
    docs = [(i, t) for i, t in enumerate(clean)]
    docs += [(100, clean[3]), (101, clean[3]), (102, clean[4] + " end"), (103, "too short"), (104, "a b c d " * 30), (105, None)]
    bench = [(0, text(30)), (1, text(12))]
    docs += [(200, text(50) + " " + bench[0][1] + " " + text(40)), (201, text(90))]
    docs = [(d, t + "\nAll rights reserved here." if t and d < 30 and d not in (3, 4) else t) for d, t in docs]
    return [(d, t, "en", f"s{d % 12}", 0) for d, t in docs], bench


def test_run(spark):
    docs, bench = case()
    folder = write(spark, docs, bench)
    out = corpus_pipeline.run(spark, folder)
    assert {r["doc_id"] for r in out.collect()} == {*range(30), 201}
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_stages(spark):
    docs, bench = case()
    folder = write(spark, docs, bench)
    rows = spark.read.parquet(f"{folder}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "benchmark_decontamination", "bpe_tokens"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        done = stage(spark, rows, folder)
        assert done.columns == rows.columns
        gone = {r[0] for r in rows.select("doc_id").collect()} - {r[0] for r in done.select("doc_id").collect()}
        assert gone == {"quality_rules": {103, 104, 105}, "line_dedup": set(), "near_dedup": {100, 101, 102}, "benchmark_decontamination": {200}}[name], name
        if name == "line_dedup":
            assert not any("All rights" in r["text"] for r in done.collect())
        path = f"{folder}/{name}"
        done.write.parquet(path)
        rows = spark.read.parquet(path)


def test_empty(spark):
    folder = write(spark, [], [])
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_near_dedup_null_and_repeated_ids(spark):
    """Different texts stay under one id or none; of copies one row stays."""
    rnd = random.Random(5)
    a, b, c, d = (" ".join("".join(rnd.choice("abcdefghij") for _ in range(6)) for _ in range(80)) for _ in range(4))
    docs = [(None, a), (None, b), (None, b), (7, c), (7, d), (7, d), (9, c), (None, d)]
    rows = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in docs], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    done = corpus_pipeline.near_dedup(spark, rows, "")
    assert done.columns == rows.columns
    assert {(r["doc_id"], r["text"]) for r in done.collect()} == {(None, a), (None, b), (7, c), (7, d)} and done.count() == 4
