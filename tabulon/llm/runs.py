"""Periodic runs of words by branching tandem repeats of an enhanced suffix array.

A run is a stretch of consecutive words with smallest period q that no
neighbouring word extends. Per text the suffixes of the word sequence are
sorted by prefix doubling (only suffixes whose rank is still shared are
sorted again), which leaves the suffix array, its inverse (ISA) and, from the
ranks of all rounds, the common prefixes (LCP). One stack scan over the LCP
array gives every interval of depth d with the bounds of its children; no
tree is built. For every suffix i of all children but the largest, ISA[i + d]
and ISA[i - d] tell whether the suffix d words away lies in the same interval
but another child: then a square of period d starts there and the word behind
it breaks the period (a branching tandem repeat). Every other square of the
run is a rotation of it, so rotating left as long as words d apart agree
merges all of them into the run. Periods that are multiples of a smaller one
of the same stretch are left out.

A run of length >= max(min_length, min_exponent * q) makes the suffixes at its
start and one period later agree in at least ``common_words`` words; a text
that holds no such repeated word sequence holds no run and needs no scan. The
check is exact and falls out of the first sorting rounds.

Texts are independent: there is no shuffle, each row is one unit of work and
memory is bounded by the longest text. Null text has no words; texts shorter
than ``min_length`` words have no runs; repeated rows get equal results; an
empty table gives an empty one.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.llm.base import in_arrow

MIN_LENGTH, MIN_EXPONENT = 24, 3


def common_words(min_length: int, min_exponent: int) -> int:
    """Least common prefix of the suffixes at a run's start and one period
    later: length - q with length >= max(min_length, min_exponent * q)."""
    return min(max(min_length, min_exponent * q) - q for q in range(1, min_length + 1))


def sort_suffixes(ids: np.ndarray, needed: int = 0) -> list[np.ndarray] | None:
    """Ranks by the first 1, 2, 4, ... words; the last is the inverse suffix
    array. A rank is the first place of its group, so settled ones stay.
    None where no sequence of ``needed`` words or more is repeated."""
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    found = ids[order]
    at = np.arange(n)
    differs = np.concatenate([[True], found[1:] != found[:-1], [True]])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(differs[:-1], at, 0))
    shared = order[~(differs[:-1] & differs[1:])]
    levels, h = [rank], 1
    while len(shared):
        ahead = shared + h
        key = rank[shared] * (n + 1) + np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        order = np.argsort(key, kind="stable")
        key, shared = key[order], shared[order]
        old, at = rank[shared], np.arange(len(shared))
        differs = np.concatenate([[True], key[1:] != key[:-1], [True]])
        outer = np.concatenate([[True], old[1:] != old[:-1]])
        rank = rank.copy()
        rank[shared] = old + np.maximum.accumulate(np.where(differs[:-1], at, 0)) - np.maximum.accumulate(np.where(outer, at, 0))
        shared = shared[~(differs[:-1] & differs[1:])]
        levels.append(rank)
        h *= 2
    # nothing is shared at h words; h / 2 words were
    return levels if h > needed else None


def common_prefixes(levels: list[np.ndarray], sa: np.ndarray) -> np.ndarray:
    """LCP of each suffix with the one before it in the suffix array."""
    n = len(sa)
    lcp = np.zeros(n, np.int64)
    a, b, at = sa[:-1].copy(), sa[1:].copy(), np.arange(1, n)
    for k in range(len(levels) - 1, -1, -1):
        inside = np.flatnonzero((a < n) & (b < n))
        same = inside[levels[k][a[inside]] == levels[k][b[inside]]]
        lcp[at[same]] += 1 << k
        a[same] += 1 << k
        b[same] += 1 << k
    return lcp


def branching_squares(sa: np.ndarray, isa: np.ndarray, lcp: np.ndarray, min_exponent: int) -> set[tuple[int, int]]:
    """(end, period) of the branching tandem repeats."""
    n = len(sa)
    place, where, depth = sa.tolist(), isa.tolist(), lcp.tolist()
    most = n // max(min_exponent, 2)  # a run with a longer period does not fit
    out: set[tuple[int, int]] = set()

    def test(d, left, right, starts):
        ends = [*starts[1:], right + 1]
        big = max(range(len(starts)), key=lambda c: ends[c] - starts[c])
        for c, (lo, hi) in enumerate(zip(starts, ends)):
            if c == big:
                continue
            for x in range(lo, hi):
                i = place[x]
                j = i + d
                if j < n and left <= (y := where[j]) <= right and not lo <= y < hi:
                    out.add((i + 2 * d, d))
                j = i - d
                if j >= 0 and left <= (y := where[j]) <= right and not lo <= y < hi:
                    out.add((j + 2 * d, d))

    stack: list = [(0, 0, [0])]  # open intervals: depth, left bound, starts of the children
    for j in range(1, n + 1):
        now = depth[j] if j < n else 0
        left = j - 1
        while stack[-1][0] > now:
            d, left, starts = stack.pop()
            if d <= most:
                test(d, left, j - 1, starts)
        if stack[-1][0] == now:
            if now:
                stack[-1][2].append(j)
        else:
            stack.append((now, left, [left, j]))
    return out


def rotate_left(ids: np.ndarray, start: int, period: int) -> int:
    """The first place from which on words ``period`` apart agree."""
    step = 16
    while start > 0:
        m = min(step, start)
        differs = np.flatnonzero(ids[start - m:start] != ids[start - m + period:start + period])
        if len(differs):
            return start - m + int(differs[-1]) + 1
        start -= m
        step *= 2
    return 0


def find_runs(words: list, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of one word sequence, by start,
    then period."""
    if len(words) < max(min_length, min_exponent):
        return []
    seen: dict = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)
    levels = sort_suffixes(ids, common_words(min_length, min_exponent))
    if levels is None:
        return []
    isa = levels[-1]
    sa = np.empty(len(ids), np.int64)
    sa[isa] = np.arange(len(ids))
    squares = branching_squares(sa, isa, common_prefixes(levels, sa), min_exponent)
    runs, here, last = [], [], -1
    for end, d in sorted(squares):
        if end != last:
            here, last = [], end
        if any(d % q == 0 and end - 2 * d >= s for s, q in here):
            continue  # a multiple of the period of the same run
        start = rotate_left(ids, end - 2 * d, d)
        here.append((start, d))
        if end - start >= max(min_length, min_exponent * d):
            runs.append((start, end - start, d))
    return sorted(runs, key=lambda r: (r[0], r[2]))


def collapse(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words no run contains after its first period."""
    drop = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    gone = np.cumsum(drop)
    return [w for w, g in zip(words, gone) if not g]


def periodic_runs(docs: DataFrame, doc: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH,
                  min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, runs (array of start, length,
    period in words, by start, then period), best (the run with the greatest
    length / period; ties: smallest start, then period; null without runs)
    and collapsed (the text's words without the repeated periods, joined by
    one space)."""
    if min_length < 2 or min_exponent < 2:
        raise ValueError("a run has two words and two periods at least")
    src = docs.select(F.col(doc).alias("doc_id"), F.col(text).cast("string").cast("binary").alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def as_row(r):
        return dict(zip(("start", "length", "period"), r))

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                runs, best, left = [], [], []
                for t in part.column(1):
                    words = (t.as_py() or b"").split()  # bytes: ASCII white space only
                    found = find_runs(words, min_length, min_exponent)
                    top = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
                    runs.append([as_row(r) for r in found])
                    best.append(as_row(top) if top else None)
                    left.append(b" ".join(collapse(words, found) if found else words))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(runs, pa.list_(run_type)), pa.array(best, run_type), pa.array(left, pa.binary()).cast(pa.string())],
                    ["doc_id", "runs", "best", "collapsed"])

    one = "struct<start:bigint,length:bigint,period:bigint>"
    return in_arrow(src, run, f"doc_id {kind}, runs array<{one}>, best {one}, collapsed string")


def with_periods(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text) with a rule's periods written into a tenth of the texts:
    let h be the CRC-32 of the decimal id and g = h div 10; where h mod 10 is
    0, each word i >= a becomes word a + (i - a) mod p, with a = g mod n and
    p = 1 + (n - a) div (3 + g mod 8). Null ids and texts without a word stay."""
    pieces = F.filter(F.split(F.col(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    h = F.crc32(F.col(doc).cast("string").cast("binary"))

    def changed(words):
        n, g = F.size(words), F.floor(h / 10)
        a = (g % n).cast("int")
        p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
        period = F.slice(words, a + 1, p)
        return F.array_join(F.concat(F.slice(words, 1, a), F.transform(
            F.sequence(F.lit(0), n - a - 1), lambda i: F.element_at(period, i % p + 1))), " ")

    new = F.element_at(F.transform(F.array(pieces), lambda ws: F.when(F.size(ws) > 0, changed(ws)).otherwise(F.col(text))), 1)
    return docs.select(F.col(doc).alias("doc_id"), F.when(F.col(text).isNotNull() & (h % 10 == 0), new).otherwise(F.col(text)).alias("text"))
