"""Quality rules and line dedup against brute force."""

import collections
import random
import re

import pytest
from pyspark.sql import functions as F

from tabulon.llm.lines import dedup_lines, spread_lines
from tabulon.llm.quality import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def normal(line):
    return re.sub(r"[\x20\x09-\x0D]+", " ", line).strip(" ").lower()


def base(t):
    t = t or ""
    w = WORD.findall(t)
    n = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    rep = {i + k for i in range(len(w) - 7) if n[tuple(w[i:i + 8])] > 1 for k in range(8)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(rep), len(w) < 20 or 100 * len(rep) > 30 * len(w))


def corpus():
    rnd = random.Random(2)
    vocab = [f"w{i}" for i in range(60)] + ["é", "#", "a&b", "<x>", "\U0001f389"]
    line = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    rows = []
    for i in range(150):
        parts = [line(rnd.randrange(1, 12)) for _ in range(rnd.randrange(0, 9))]
        if i % 3 == 0:
            parts.insert(rnd.randrange(len(parts) + 1), rnd.choice(["All  rights\treserved.", "ALL rights reserved."]))
        if i % 4 == 0 and parts:
            parts += parts[:2] * rnd.randrange(1, 3)
        rows.append((i, "\n".join(parts), f"s{i % 12}"))
    copy = "\n".join(line(9) for _ in range(6))
    rows += [(200 + i, copy, f"s{i % 12}") for i in range(30)]
    rows += [(300, None, "s1"), (301, "", None), (302, " \n\t\n", "s2"), (303, "one two three " * 3000, "s3"), (304, "x y z w " * 9, "s3"),
             (305, rows[3][1], None), (305, rows[3][1], None), (None, rows[5][1], "s5"), (306, "\x1cq\r\nb\x0bc\nq", "s1")]
    return rows


def table(spark, rows):
    return spark.createDataFrame([(*r, 5, "k") for r in rows], "doc_id bigint, text string, source string, lh int, n_removed string")


@pytest.mark.parametrize("max_docs", [3, 1000])
def test_quality(spark, max_docs):
    rows = corpus()
    hosts, seen = collections.defaultdict(set), collections.defaultdict(set)
    for _, t, s in rows:
        hosts[s or ""].add(t)
        for x in (t or "").split("\n"):
            if WORD.search(x):
                seen[s or "", normal(x)].add(t)
    limits = {k for k, v in seen.items() if len(v) > max_docs}
    want = []
    for d, t, s in rows:
        b = base(t)
        gone = sum(len(WORD.findall(x)) for x in (t or "").split("\n") if (s or "", normal(x)) in limits)
        left = b[0] - gone
        want.append((d, *b, gone, not b[5] and not (gone > 0 and (left < 20 or left < 0.3 * b[0]))))
    out = quality(table(spark, rows), max_docs=max_docs)
    out = out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_removed", "kept").collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    # a row repeated in full shares its lines' sums up to its own length
    assert sorted([tuple(r) for r in out if r[0] != 305], key=key) == sorted([r for r in want if r[0] != 305], key=key)
    assert len(out) == len(rows)
    if max_docs == 3:
        assert limits


def test_line_dedup(spark):
    # the corpus's own frequent lines stand in copies; these in different texts
    rows = corpus() + [(900 + i, f"own words {i}\n" + ("Cookies  help us\n\n" * (i % 3)) + f"cookies help US {i % 2}", f"site{i % 15}") for i in range(60)]
    sites, own = collections.defaultdict(set), {}
    for _, t, s in rows:
        if s is not None:
            own[t] = min(own.get(t, s), s)
    for t, s in own.items():
        for x in (t or "").split("\n"):
            if WORD.search(x):
                sites[normal(x)].add(s)
    spread = {k for k, v in sites.items() if len(v) >= 10}
    assert spread
    want = []
    for d, t, s in rows:
        lines = (t or "").split("\n")
        gone = [bool(WORD.search(x)) and normal(x) in spread for x in lines]
        text = None if t is None else "\n".join(x for x, g in zip(lines, gone) if not g)
        want.append((d, text, s, 5, sum(bool(WORD.search(x)) for x in lines), sum(gone)))
    out = dedup_lines(table(spark, rows))
    assert out.columns == ["doc_id", "text", "source", "lh", "n_lines", "n_removed"]
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    assert sorted([tuple(r) for r in out.collect()], key=key) == sorted(want, key=key)


def test_copies_are_one_site_and_boilerplate_pages_lose_all(spark):
    """A text on 30 sites keeps its own lines; a line in different texts on ten
    sites goes, even from a page that holds nothing else."""
    copied = "this page\nis copied whole"
    rows = [(i, copied, f"s{i}") for i in range(30)]
    rows += [(100 + i, f"own words {i}\nshared line", f"s{i}") for i in range(10)] + [(200, "Shared  line", "s3"), (201, "shared line\nshared line\nrest", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn("th", F.lit(1)).withColumn("_site", F.lit("x"))
    out = {r["doc_id"]: (r["text"], r["n_removed"]) for r in dedup_lines(docs).collect()}
    assert all(out[i] == (copied, 0) for i in range(30)) and all(out[100 + i] == (f"own words {i}", 1) for i in range(10))
    assert out[200] == ("", 1) and out[201] == ("rest", 2) and len(out) == len(rows)


def test_near_threshold_lines_are_exact(spark):
    rows = [(k, s) for k in range(1, 41) for s in range(k)]
    df = spark.createDataFrame(rows, "lh bigint, site int")
    assert sorted(r[0] for r in spread_lines(df, min_sites=20).collect()) == list(range(20, 41))


def test_empty(spark):
    df = table(spark, corpus()).limit(0)
    assert quality(df).count() == 0 and dedup_lines(df).count() == 0


def test_repeated_rows_are_one_document(spark):
    """A quarter of the words are boilerplate: kept, however often repeated."""
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(60)) + "\n" + "all rights reserved " * 6 + "now here", "s1") for i in range(30)]
    rows += [rows[0]] * 3 + [(None, rows[1][1], "s1")] * 4
    out = quality(table(spark, rows), max_docs=3).select("doc_id", "n_words", "n_removed", "kept").collect()
    assert sorted(map(tuple, out), key=str) == sorted([(r[0], 80, 20, True) for r in rows], key=str)
