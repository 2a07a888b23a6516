"""Secret scan: a random forest removes false positives from candidates.

Candidates are long runs of key characters. Each gets features of length,
character mix and transitions (class changes, and mean log probability under
the corpus's own letter transitions), dictionary coverage (share of its
letters inside frequent corpus words), path (slashes, dots, the surroundings
of a URL or file name) and neighbouring words. A forest is trained on
labelled findings and scores every candidate; those at ``threshold`` or more
are secrets.

Labels come from the caller, or else from rules that are right where they
apply and silent elsewhere: provider formats and values assigned to a secret's
name are findings; plain words and numbers, parts of URLs, UUIDs and named checksums are
not. The rules' formats are no features, so the forest carries over to
candidates that no rule knows. Corpus statistics cover all documents; only the
training rows are a bounded sample (``MAX_TRAIN`` a class, by hash).
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.llm.base import cut, in_arrow, on_key, row_key, saved

MAX_TRAIN = 4000         # labelled rows of each class that the forest sees
DICTIONARY = 3000        # most frequent corpus words, 3 to 10 letters
TREES, DEPTH, SEED = 20, 6, 7
THRESHOLD = 0.5
HELD_WORDS = 200_000     # words counted in memory before they are passed on
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}(?![A-Za-z0-9+/_=-])")
#: Public formats of providers' keys (fixed values).
FORMATS = re.compile(r"(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36}|glpat-[A-Za-z0-9_-]{20}|sk_live_[A-Za-z0-9]{16,}|"
                     r"xox[abprs]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{35}|npm_[A-Za-z0-9]{36}")
ASSIGNED = re.compile(r"(?i)(?:passw(?:or)?d|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|auth|bearer|credential)s?"
                      r"[\"']?\s*(?::=|=>|[:=]|\s)\s*[\"']?$")
HARMLESS = re.compile(r"(?i)(?:sha-?(?:1|256|512)?|md5|commit|checksum|digest|etag|integrity|revision|uuid|guid)[\"']?\s*[:=]?\s*[\"']?$")
UUID = re.compile(r"(?i)[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}")
URL = re.compile(r"(?i)(?:https?:|www\.|href=)\S*$")
HINTS = ("key", "token", "secret", "password", "auth", "id", "sha", "commit", "hash", "http")
FEATURES = ("length", "upper", "lower", "digit", "symbol", "distinct", "changes", "hex", "transitions", "coverage", "slashes", "dotted",
            "quoted", "assigned", *HINTS)


def corpus_rows(texts: DataFrame) -> DataFrame:
    """(kind, key, n): partial counts of words (kind 0) and of letter
    transitions (kind 1) in ``texts(text)``."""
    def run(batches):
        words: Counter = Counter()
        pairs = np.zeros(27 * 27, np.int64)

        def table(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.string()),
                                               pa.array([r[2] for r in rows], pa.int64())], ["kind", "key", "n"])

        for b in batches:
            for x in b.column(0):
                data = (x.as_py() or "").encode("utf-8", "surrogatepass").lower()
                words.update(re.findall(rb"(?<![a-z\x80-\xff])[a-z]{3,10}(?![a-z\x80-\xff])", data))
                v = np.frombuffer(data, np.uint8).astype(np.int64) - 96
                v[(v < 1) | (v > 26)] = 0
                pairs += np.bincount(v[:-1] * 27 + v[1:], minlength=27 * 27) if len(v) > 1 else 0
                if len(words) > HELD_WORDS:
                    yield table([(0, w.decode(), n) for w, n in words.items()])
                    words.clear()
        yield table([(0, w.decode(), n) for w, n in words.items()] + [(1, str(i), int(n)) for i, n in enumerate(pairs) if n])

    return in_arrow(texts, run, "kind int, key string, n bigint")


def corpus_model(texts: DataFrame) -> tuple[frozenset, list[float]]:
    """The dictionary and the log probabilities of letter transitions: both
    of fixed size, whatever the corpus."""
    counts = saved(corpus_rows(texts).groupBy("kind", "key").agg(F.sum("n").alias("n")))
    top = counts.where("kind = 0").orderBy(F.desc("n"), "key").limit(DICTIONARY).collect()
    pairs = np.ones((27, 27))
    for r in counts.where("kind = 1").collect():  # at most 729 rows
        pairs[divmod(int(r["key"]), 27)] += r["n"]
    return frozenset(r["key"] for r in top), np.log(pairs / pairs.sum(1, keepdims=True)).ravel().tolist()


def coverage(word: str, dictionary: frozenset) -> float:
    """Share of the characters inside dictionary words, best split."""
    best = [0] * (len(word) + 1)
    for i in range(len(word)):
        best[i + 1] = max(best[i + 1], best[i])
        for n in range(3, min(10, len(word) - i) + 1):
            if word[i:i + n] in dictionary and best[i] + n > best[i + n]:
                best[i + n] = best[i] + n
    return best[-1] / max(1, len(word))


def features(v: str, before: str, after: str, dictionary: frozenset, transitions) -> list[float]:
    n = len(v)
    kinds = ["U" if "A" <= c <= "Z" else "l" if "a" <= c <= "z" else "d" if c.isdigit() else "s" for c in v]
    low = v.lower()
    codes = [ord(c) - 96 if "a" <= c <= "z" else 0 for c in low]
    steps = [transitions[a * 27 + b] for a, b in zip(codes, codes[1:])]
    near = before.lower()
    return [float(n), kinds.count("U") / n, kinds.count("l") / n, kinds.count("d") / n, kinds.count("s") / n, len(set(v)) / n,
            sum(a != b for a, b in zip(kinds, kinds[1:])) / n, float(all(c in "0123456789abcdef" for c in low)),
            sum(steps) / max(1, len(steps)), coverage(low, dictionary), float(v.count("/")),
            float(bool(re.match(r"\.[a-z]{1,4}\b", after)) or before.endswith("/")), float(before[-1:] in "\"'" and before != ""),
            float(bool(re.search(r"[:=]\s*[\"']?$", before))), *[float(h in near) for h in HINTS]]


def rule_label(v: str, before: str) -> int | None:
    if FORMATS.fullmatch(v):
        return 1
    if URL.search(before) or UUID.fullmatch(v) or HARMLESS.search(before):
        return 0
    if ASSIGNED.search(before):
        return 1 if any(c.isdigit() for c in v) else None
    return 0 if v.isdigit() or (v.isalpha() and (v[1:].islower() or v.isupper())) else None


def candidates(docs: DataFrame, model, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, th, s, e, features, label): every candidate with its features
    and the rules' label (null where they are silent); code points."""
    dictionary, transitions = model
    src = docs.select(*row_key(doc, text), F.col(text).alias("text"))

    def run(batches):
        for b in batches:
            rows = []
            for doc_id, th, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                t = t.as_py() or ""
                for m in CANDIDATE.finditer(t):
                    before, after = t[max(0, m.start() - 40):m.start()], t[m.end():m.end() + 20]
                    rows.append((doc_id, th, m.start(), m.end(), features(m.group(), before, after, dictionary, transitions), rule_label(m.group(), before)))
            types = [b.schema.field(0).type, pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.float64()), pa.int32()]
            for a in range(0, max(1, len(rows)), 5000):
                cols = list(zip(*rows[a:a + 5000])) or [()] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["doc_id", "th", "s", "e", "features", "label"])

    kind = src.schema["doc_id"].dataType.simpleString()
    return in_arrow(src, run, f"doc_id {kind}, th bigint, s int, e int, features array<double>, label int").distinct()


def training_rows(found: DataFrame, most: int = MAX_TRAIN) -> DataFrame:
    """At most ``most`` labelled rows of each class, different feature
    vectors only, chosen and ordered by hash; in one partition, so that the
    same rows always give the same forest."""
    part = [found.where(F.col("label") == k).select("features", "label").distinct().orderBy(F.xxhash64("features"), "features").limit(most) for k in (0, 1)]
    return cut(part[0].union(part[1]).coalesce(1).sortWithinPartitions(F.xxhash64("features"), "label"))


def fit_forest(labelled: DataFrame):
    """The forest over ``labelled(features, label)``, or None if it lacks a
    class."""
    if labelled.select("label").distinct().count() < 2:
        return None
    rows = labelled.select(array_to_vector("features").alias("vector"), F.col("label").cast("double").alias("y"))
    return RandomForestClassifier(featuresCol="vector", labelCol="y", numTrees=TREES, maxDepth=DEPTH, seed=SEED,
                                  rawPredictionCol="raw", probabilityCol="probability", predictionCol="guess").fit(rows)


def scan_secrets(docs: DataFrame, doc: str = "doc_id", text: str = "text", labelled: DataFrame | None = None,
                 threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, th, s, e, score, secret) per candidate. ``labelled`` may give
    (features, label) rows; else the rules label the candidates themselves.
    Without both classes the rules alone decide. Null texts have no
    candidates; rows repeated in full give one set of findings; an empty
    table gives an empty one."""
    model = corpus_model(docs.select(F.col(text).alias("text")))
    found = saved(candidates(docs, model, doc, text))
    forest = fit_forest(training_rows(found) if labelled is None else labelled)
    if forest is None:
        scored = found.withColumn("score", F.coalesce(F.col("label").cast("double"), F.lit(0.0)))
    else:
        scored = forest.transform(found.withColumn("vector", array_to_vector("features"))).withColumn("score", F.get(vector_to_array("probability"), F.lit(1)))
    return scored.select("doc_id", "th", "s", "e", "score", (F.col("score") >= threshold).alias("secret"))


def findings(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_candidates, n_secrets and spans
    (start:end of each secret, in order, comma-joined)."""
    scored = scan_secrets(docs, doc, text)
    at = F.when(F.col("secret"), F.struct("s", "e"))
    per = scored.groupBy("doc_id", "th").agg(F.count(F.lit(1)).alias("n_candidates"), F.count_if("secret").alias("n_secrets"),
                                             F.sort_array(F.collect_list(at)).alias("found"))
    out = on_key(docs.select(*row_key(doc, text)), per)
    spans = F.array_join(F.transform("found", lambda x: F.concat_ws(":", x["s"].cast("string"), x["e"].cast("string"))), ",")
    return out.select("doc_id", F.coalesce("n_candidates", F.lit(0).cast("bigint")).alias("n_candidates"),
                      F.coalesce("n_secrets", F.lit(0).cast("bigint")).alias("n_secrets"), F.coalesce(spans, F.lit("")).alias("spans"))
