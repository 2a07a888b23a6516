"""Sanitisation: base spans against Python's re, disclosure against counts."""

import hashlib
import math
import re
import uuid

from pyspark.sql import functions as F

from tabulon.llm import pii, queries
from tabulon.session import checkpoint_dir

KINDS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
         ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def holds(kind, v):
    d = [int(c) for c in v if c in "0123456789"]
    if kind == "email":
        return True
    if kind == "ip":
        return all(int(p) <= 255 for p in v.split("."))
    if kind == "phone":
        return 9 <= len(d) <= 15
    return 12 <= len(d) <= 19 and sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(reversed(d))) % 10 == 0


def base(t):
    found = [(m.start(), k, m.end()) for k, (kind, p) in enumerate(KINDS) for m in re.finditer(p, t or "", re.ASCII) if holds(kind, m.group())]
    return sorted(found)


TEXTS = ["a@b.c_x@d.e", "a@b.c.@d.e x@y é 1.2.3.4.5.6.7.8 256.1.1.1 0255.1.1.001", "+1 (234) 567-8901 4111 1111 1111 1111", "4111-1111-1111-1111 +" + "1" * 20,
         "1" * 20000, "é\U0001f389 a@b.co \U0001f389" + "x." * 3000 + "@d.e" + ".q" * 9000, "1 2" * 9000, "1.1" * 5000, "+1" * 4000, None, "", "no data",
         "me@x.org 10.0.0.1 5555555555554444 +49 30 1234567", "me@x.org 10.0.0.1 5555555555554444 +49 30 1234567", "4 4 4 4 4 4 4 4 4 4 4 4 4 4 4 2",
         "a@b.c " * 700, "99999999999999999999999.1.1.1", "@a.b", "a@-.-"]


def test_base_spans(spark):
    df = spark.createDataFrame([(i, t, "s") for i, t in enumerate(TEXTS)], "doc_id int, text string, spans string")
    rows = {r["doc_id"]: r for r in pii.sanitise(df).collect()}
    assert len(rows) == len(TEXTS)
    for i, t in enumerate(TEXTS):
        assert [(b["s"], b["k"], b["e"]) for b in rows[i]["base"]] == base(t)
        assert [(b["s"], b["k"], b["e"]) for b in rows[i]["spans"] if b["k"] < 4] == base(t)


def test_written_digest(spark):
    df = spark.createDataFrame([(1, "me@x.org 10.0.0.1, 5555555555554444 +49 30 1234567")], "doc_id int, text string")
    r = pii.sanitise(df).select(pii.written(F.col("base")).alias("w"), F.sha2(pii.written(F.col("base")), 256).alias("d")).first()
    assert r["w"] == "email:0:8,ip:9:17,card:19:35,phone:36:50"
    assert r["d"] == hashlib.sha256(r["w"].encode()).hexdigest()


def test_disclosing_terms(spark):
    """'zanzibar' stands only beside one address, 'report' everywhere."""
    rows = [(i, f"report {i} by zanzibar boss@corp.org ends") for i in range(4)] + [(9, "report 0 by zanzibar boss@corp.org ends")]
    rows += [(10 + i, f"report number {i} about nothing ends here") for i in range(40)] + [(60, "solitary hapax@corp.org"), (61, None)]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    out = {r["doc_id"]: r for r in pii.sanitise(df).collect()}
    n, n_e, n_te, n_t = len(rows), 5, 5, sum("zanzibar" in (t or "") for _, t in rows)
    score = math.log(n * n_te / (n_t * n_e)) / math.log(n / n_e)
    for i in (0, 1, 2, 3, 9):
        added = [s for s in out[i]["spans"] if s["k"] == 4]
        assert [(s["s"], s["e"]) for s in added] == [(12, 20)]
        assert abs(added[0]["score"] - score) < 1e-9
    assert all(s["k"] < 4 for i in [*range(10, 50), 60, 61] for s in out[i]["spans"])
    done = pii.sanitise(df).join(df, "doc_id").select("doc_id", pii.sanitised_text(F.col("text"), F.col("spans")).alias("t")).where("doc_id = 1").first()
    assert done["t"] == "report 1 by  [EMAIL] ends"


def test_copies_are_no_evidence(spark):
    rows = [(i, "zanzibar boss@corp.org") for i in range(5)] + [(10 + i, f"number {i}") for i in range(20)]
    out = pii.sanitise(spark.createDataFrame(rows, "doc_id int, text string"))
    assert all(s["k"] < 4 for r in out.collect() for s in r["spans"])


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id int, text string")
    assert pii.sanitise(df).count() == 0


def test_terms_anywhere_in_the_text(spark):
    """'lee' and a name of two characters stand with one address only, far
    from it; a term of the copies' text counts once."""
    far = " the same words again and again" * 9
    rows = [(d, f"lee \u674e\u56db {far} {i} boss@corp.org" + far) for d, i in ((0, 0), (1, 1), (2, 2), (9, 0))]
    rows += [(20 + i, f"{far} {i}") for i in range(40)]
    out = {r["doc_id"]: r for r in pii.sanitise(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    for i in (0, 1, 2, 9):
        assert [(s["s"], s["e"], round(s["score"], 9)) for s in out[i]["spans"] if s["k"] == 4] == [(0, 3, 1.0), (4, 6, 1.0)]


def test_query_scores_terms_of_one_text(spark):
    """A rare name beside a one-off address, whose text is there twice."""
    rows = [(i, "zanzibar report hapax@corp.org") for i in (1, 2)] + [(10 + i, f"report number {i} ends") for i in range(30)]
    folder = f"{checkpoint_dir(spark).rstrip('/')}/case-{uuid.uuid4().hex}"
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{folder}/documents.parquet")
    out = {r["doc_id"]: r["spans"] for r in queries.op3_pii(spark, folder).collect()}
    assert out == {1: "term:0:8,email:16:30", 2: "term:0:8,email:16:30", **{10 + i: "" for i in range(30)}}
