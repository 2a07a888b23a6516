"""Hard negatives by slot-decomposed selection.

Every anchor has its ``positives`` best rows of the same label; each of them
asks for the ``negatives`` best rows of other labels whose score lies in a
window below its own, and the windows of one anchor overlap. The distinct
scores of the positives are the upper limits of disjoint slots: slot j holds
the scores above the next lower limit and up to its own. A window starts with
its limit's slot and reaches into the lower ones, so the best rows of every
slot are enough: tasks combine the top-k of each (anchor, slot), a partial
aggregation of bounded size, the shuffle merges them, and the slots of an
anchor strung together from the highest down answer every window by its
suffix, cut off at its lower bound.

Vectors are quantised to floor(scale * x) and scored by integer inner
products, exactly: in float32 while the norms bound every partial sum below
2^24, in float64 below 2^53, in Python integers beyond (scores outside
+-``LIMIT`` saturate there).

The anchors are the stated query set; they go through in blocks of at most
``BLOCK_BYTES`` and ``BLOCK_ROWS``, the only thing that is broadcast, each
against all rows where they lie. At most ``PARTS`` tasks read the rows, which
bounds what the combiners emit: PARTS x (positives + slots x negatives) rows
an anchor in the worst case.

Rows with a null id, label or vector or a null or non-finite component take
no part. Rows repeated under one id count once, as the one with the smallest
(label, vector). Of vectors of different lengths the common components count.
Ties go to the smaller id. Anchors without a positive or a negative in any
window have no rows; an empty table gives an empty one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabulon.llm.base import cut, in_arrow

BLOCK_BYTES, BLOCK_ROWS = 16 << 20, 32_768
PARTS, PART_ROWS = 256, 16_384
CELLS = 2_000_000                 # scores computed at a time in a task
NONE = np.iinfo(np.int64).min     # no score
LIMIT = np.iinfo(np.int64).max // 128


def matrix(column: pa.Array, width: int | None, scale: float) -> np.ndarray:
    """Quantised vectors as rows of ``width`` components (short ones padded
    with zeros, longer ones cut; None: the longest)."""
    offsets = np.asarray(column.offsets, np.int64)
    flat = np.floor(scale * np.asarray(column.values, np.float64)[offsets[0]:offsets[-1]])
    offsets = offsets - offsets[0]
    sizes = np.diff(offsets)
    width = int(sizes.max(initial=0)) if width is None else width
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    inside = np.arange(width) < sizes[:, None]
    out[inside] = flat[(offsets[:-1, None] + np.arange(width))[inside]]
    return out


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of a with those of b, in the
    narrowest type that holds every partial sum (Cauchy-Schwarz)."""
    with np.errstate(over="ignore"):
        bound = np.sqrt((a * a).sum(1).max(initial=0)) * np.sqrt((b * b).sum(1).max(initial=0))
    if bound < 2**24:
        return a.astype(np.float32) @ b.astype(np.float32).T
    if bound < 2**53:
        return a @ b.T
    whole = [np.array([[int(x) for x in r] for r in m], object).reshape(m.shape) for m in (a, b)]
    return np.clip((whole[0] @ whole[1].T).astype(object), -LIMIT, LIMIT).astype(np.int64)


class Best:
    """The k best (score, id) of every group; offered in the order of ids."""

    def __init__(self, groups: int, k: int):
        self.k = k
        self.score = np.full((groups, k), NONE, np.int64)
        self.id = np.zeros((groups, k), np.int64)

    def floor(self) -> np.ndarray:
        """Scores up to this one can't enter any more."""
        return self.score[:, -1]

    def offer(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        touched = np.unique(group)
        g = np.concatenate([group, np.repeat(touched, self.k)])
        s = np.concatenate([score, self.score[touched].ravel()])
        i = np.concatenate([ids, self.id[touched].ravel()])
        order = np.lexsort((i, ~s, g))  # ~s: descending, the least integer included
        g, s, i = g[order], s[order], i[order]
        first = np.concatenate([[0], np.flatnonzero(g[1:] != g[:-1]) + 1])
        rank = np.arange(len(g)) - np.repeat(first, np.diff(np.append(first, len(g))))
        keep = rank < self.k
        self.score[g[keep], rank[keep]] = s[keep]
        self.id[g[keep], rank[keep]] = i[keep]


def _chunks(batches, width: int, anchors: int, scale: float):
    """(ids, labels, vectors) of at most CELLS / anchors rows."""
    step = max(1, CELLS // max(anchors, 1))
    for b in batches:
        for at in range(0, b.num_rows, step):
            part = b.slice(at, step)
            yield np.asarray(part.column(0), np.int64), part.column(1).to_pylist(), matrix(part.column(2), width, scale)


def _emit(names: list[str], *columns):
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


def top_positives(rows: DataFrame, block, k: int, scale: float) -> DataFrame:
    """(anchor_id, score, id): the k best rows of the anchor's label, other
    than itself, of every task."""
    def run(batches):
        ids, labels, q = block.value
        best, of_label = Best(len(ids), k), {x: np.flatnonzero(labels == x) for x in set(labels.tolist())}
        for at, names, x in _chunks(batches, q.shape[1], len(ids), scale):
            names = np.array(names, object)
            for name in set(names.tolist()) & of_label.keys():
                a, r = of_label[name], np.flatnonzero(names == name)
                s, low = scores(q[a], x[r]), best.floor()[a]
                if len(r) > k and (low == NONE).any():  # an own lower bound for the first rows
                    low = np.maximum(low, np.partition(s, len(r) - k - 1, axis=1)[:, len(r) - k - 1].astype(np.int64) - 1)
                i, j = np.nonzero(s > low[:, None])
                other = ids[a[i]] != at[r[j]]
                i, j = i[other], j[other]
                if len(i):
                    best.offer(a[i], s[i, j].astype(np.int64), at[r[j]])
        g, j = np.nonzero(best.score != NONE)
        yield from _emit(["anchor_id", "score", "id"], ids[g], best.score[g, j], best.id[g, j])

    return in_arrow(rows, run, "anchor_id bigint, score bigint, id bigint")


def top_slots(rows: DataFrame, block, limits, k: int, scale: float) -> DataFrame:
    """(anchor_id, slot, score, id): the k best rows of other labels of every
    (anchor, slot) of every task. ``limits``: (lowest score wanted per
    anchor, upper limits of its slots in descending order, NONE for none)."""
    def run(batches):
        ids, labels, q = block.value
        least, upper = limits.value
        slots = upper.shape[1]
        best = Best(len(ids) * slots, k)
        for at, names, x in _chunks(batches, q.shape[1], len(ids), scale):
            s = scores(q, x)
            i, j = np.nonzero((s >= least[:, None]) & (s <= upper[:, :1]))
            other = labels[i] != np.array(names, object)[j]
            i, j = i[other], j[other]
            found = s[i, j].astype(np.int64)
            group = i * slots + (upper[i] >= found[:, None]).sum(1) - 1
            new = found > best.floor()[group]
            if new.any():
                best.offer(group[new], found[new], at[j[new]])
        g, j = np.nonzero(best.score != NONE)
        yield from _emit(["anchor_id", "slot", "score", "id"], ids[g // slots], g % slots, best.score[g, j], best.id[g, j])

    return in_arrow(rows, run, "anchor_id bigint, slot bigint, score bigint, id bigint")


def _best(found: DataFrame, k: int, *keys: str) -> DataFrame:
    """The k best (score, id) per key of the tasks' candidates."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k)


def slot_limits(ids: np.ndarray, chosen: list, k: int, share: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Least wanted score and descending upper limits per anchor from its
    positives' scores. The window of a negative score is empty, so only
    scores from 0 on are limits."""
    place = {x: n for n, x in enumerate(ids.tolist())}
    upper = np.full((len(ids), k), NONE, np.int64)
    tops: dict = {}
    for a, s in chosen:
        if s >= 0:
            tops.setdefault(place[a], set()).add(s)
    least = np.full(len(ids), np.iinfo(np.int64).max, np.int64)
    for n, found in tops.items():
        upper[n, :len(found)] = sorted(found, reverse=True)
        least[n] = -(-share[0] * min(found) // share[1])
    return least, upper


def hard_negatives(table: DataFrame, id: str = "vec_id", label: str = "label", vector: str = "embedding", anchor: Column | None = None,
                   positives: int = 5, negatives: int = 5, share: tuple[int, int] = (80, 100), scale: float = 256.0) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score,
    negative_score: for each anchor (rows that satisfy ``anchor``; default:
    id divisible by 100) and each of its best ``positives`` rows of its label
    the best ``negatives`` rows of other labels with share[0] *
    positive_score <= share[1] * negative_score <= share[1] * positive_score."""
    if positives < 1 or negatives < 1 or not 0 <= share[0] <= share[1] <= 127:
        raise ValueError("positives, negatives >= 1 and 0 <= share[0] <= share[1] <= 127 are needed")
    spark = table.sparkSession
    rows = table.select(F.col(id).cast("bigint").alias("vec_id"), F.col(label).cast("string").alias("label"), F.col(vector).alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where("vec_id is not null and label is not null and vec is not null").where(finite)
    parts = min(PARTS, max(1, -(-rows.count() // PART_ROWS)))
    # dealt by id and sorted, as the aggregation leaves them
    one = rows.repartition(parts, "vec_id").groupBy("vec_id").agg(F.min(F.struct("label", "vec")).alias("r"))
    rows = cut(one.select("vec_id", "r.label", "r.vec").sortWithinPartitions("vec_id"))
    is_anchor = F.col("vec_id") % 100 == 0 if anchor is None else anchor
    asked = cut(rows.where(is_anchor))
    size = asked.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.size("vec")), F.lit(0)).alias("cells")).first()
    blocks = max(1, -(-size["n"] // BLOCK_ROWS), -(-8 * size["cells"] // BLOCK_BYTES))
    chosen, answers = [], []
    for b in range(blocks):
        part = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).orderBy("vec_id").toArrow()
        if not part.num_rows and b:
            continue
        part = part.combine_chunks()
        ids = np.asarray(part["vec_id"], np.int64)
        vec = pa.concat_arrays(part["vec"].chunks) if part["vec"].num_chunks else pa.array([], part.schema.field("vec").type)
        block = spark.sparkContext.broadcast((ids, np.array(part["label"].to_pylist(), object), matrix(vec, None, scale)))
        best = cut(_best(top_positives(rows, block, positives, scale), positives, "anchor_id"))
        pairs = [(r["anchor_id"], r["score"]) for r in best.select("anchor_id", "score").collect()]  # positives x block at most
        limits = spark.sparkContext.broadcast(slot_limits(ids, pairs, positives, share))
        slots = cut(_best(top_slots(rows, block, limits, negatives, scale), negatives, "anchor_id", "slot"))
        chosen.append(best.select("anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")))
        answers.append(slots.select("anchor_id", "score", "id"))
        block.unpersist()
        limits.unpersist()
    pos, neg = chosen[0], answers[0]
    for p, n in zip(chosen[1:], answers[1:]):
        pos, neg = pos.unionByName(p), neg.unionByName(n)
    # the slots of an anchor strung together: slots x negatives rows at most
    strung = neg.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("down"), "id"))).alias("list"))
    suffix = F.slice(F.filter("list", lambda x: -x["down"] <= F.col("positive_score")), 1, negatives)
    window = F.filter(suffix, lambda x: share[0] * F.col("positive_score") <= -x["down"] * share[1])
    out = pos.join(strung, "anchor_id").select("anchor_id", "positive_id", "positive_score", F.posexplode(window).alias("at", "x"))
    return out.select("anchor_id", "positive_id", (F.col("at") + 1).alias("rank"), F.col("x.id").alias("negative_id"),
                      "positive_score", (-F.col("x.down")).alias("negative_score"))
