"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Fingerprints that differ in at most ``radius`` = 3 bits are linked and the
links' components formed. Two fingerprints within an even distance 2r meet in
a variant within r flipped bits of either; for the odd radius 3 the third
differing bit is absorbed by erasing one of four 16-bit blocks: some block
holds a differing bit, and outside it at most two bits differ, so both sides
emit a common variant within one flip. That is 4 x (1 + 48) = 196 variants a
fingerprint instead of the 1 + 64 + 2,016 of the plain ball of radius two
(16 bytes each: 33 kB a document, more than the documents themselves).

The variants are shuffled; a variant that only one fingerprint emits is
dropped. The fingerprints on a shared variant are put in order and each is
verified against the three before it and the first; components of these links
leave only pairs across components open. Variants whose fingerprints all lie
in one component are settled. On the others, up to ``PAIRED`` fingerprints
are joined across components, deduplicated and verified; fingerprints on a
variant shared by more emit the plain ball of radius two among themselves:
whatever lies within two flips of a midpoint is linked to the smallest
fingerprint within one flip of it. So a large group of near copies costs
links in proportion to its size, never all its pairs, and no link between
components is lost. At most 2,081 different fingerprints share a midpoint,
which bounds that window.

Equal fingerprints are one node, however many documents carry them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabulon.llm.base import components, cut, in_arrow

RADIUS = 3
SHINGLE = 3       # words
SEED = 42
PAIRED = 128      # fingerprints on one variant that are compared pair by pair
BEFORE = 3        # fingerprints before it that each is compared with
BLOCK = 16        # bits erased at once
CHUNK = 1 << 16   # shingles hashed at a time


def _fingerprint(text: str | None, shingle: int) -> int:
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for a in range(0, n, CHUNK):
        part = words[a:min(a + CHUNK, n) + shingle - 1]
        grams = map(b" ".join, zip(*(part[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
        h = np.fromiter((xxh64_intdigest(g, SEED) for g in grams), np.uint64)
        ones += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, doc: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the SimHash of each row. A-Z lower-cased; words are runs
    without ASCII white space; shingles of ``shingle`` words, repeats
    included, hashed with XXH64 (seed 42); a bit is set if more than half of
    the hashes set it. Fewer words than a shingle: the whole sequence; none
    or null: zero."""
    def run(batches):
        for b in batches:
            fps = [_fingerprint(t.as_py(), shingle) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    ids = docs.select(F.col(doc).alias("doc_id"), F.col(text).alias("text"))
    return in_arrow(ids, run, f"doc_id {ids.schema['doc_id'].dataType.simpleString()}, fp bigint")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _variants() -> list[tuple[int, int, int]]:
    """(block, bits kept, bit flipped) of the 196 blocked variants."""
    out = []
    for block in range(64 // BLOCK):
        erased = ((1 << BLOCK) - 1) << (BLOCK * block)
        kept = ~erased & ((1 << 64) - 1)
        out += [(block, _signed(kept), _signed(flip)) for flip in [0, *(1 << i for i in range(64) if kept >> i & 1)]]
    return out


def _distance(a, b):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def links(fps: DataFrame, radius: int = RADIUS, paired: int = PAIRED) -> DataFrame:
    """(a, b): links between different fingerprints of ``fps(fp)``; their
    components are those of all pairs within ``radius`` bits."""
    if radius != 3:
        raise ValueError("the blocked variants are laid out for a radius of three bits")
    nodes = fps.select("fp").distinct()
    table = F.array(*[F.struct(F.lit(b).cast("byte").alias("b"), F.lit(k).alias("k"), F.lit(x).alias("x")) for b, k, x in _variants()])
    each = nodes.select("fp", F.explode(table).alias("v"))
    each = each.select(F.col("v.b").alias("block"), F.col("fp").bitwiseAND(F.col("v.k")).bitwiseXOR(F.col("v.x")).alias("key"), "fp")
    on = Window.partitionBy("key", "block")
    shared = cut(each.withColumn("n", F.count(F.lit(1)).over(on)).where("n > 1"))

    order = on.orderBy("fp")
    others = F.array(*[F.lag("fp", i).over(order) for i in range(1, BEFORE + 1)], F.first("fp").over(order))
    near = shared.select("fp", others.alias("o")).select("fp", F.explode(F.array_distinct("o")).alias("a"))
    near = near.where("a <> fp").select("a", F.col("fp").alias("b")).distinct().where(_distance("a", "b") <= radius)
    rooted = cut(components(near).select(F.col("id").alias("c"), "root"))

    # variants with few fingerprints were compared pair by pair already
    open_ = shared.where(F.col("n") > BEFORE + 1).join(rooted, F.col("fp") == F.col("c"), "left").select(
        "key", "block", "fp", "n", F.coalesce("root", "fp").alias("root"))
    open_ = open_.withColumn("differs", F.min("root").over(on) < F.max("root").over(on))
    open_ = cut(open_.where("differs").select("key", "block", "fp", "n", "root"))
    few = open_.where(F.col("n") <= paired)
    l, r = few.alias("l"), few.alias("r")
    pairs = l.join(r, (F.col("l.key") == F.col("r.key")) & (F.col("l.block") == F.col("r.block")) & (F.col("l.root") < F.col("r.root")))
    pairs = pairs.select(F.col("l.fp").alias("a"), F.col("r.fp").alias("b")).distinct().where(_distance("a", "b") <= radius)
    crowd = open_.where(F.col("n") > paired).select("fp").distinct()
    return rooted.select(F.col("root").alias("a"), F.col("c").alias("b")).where("a <> b").union(pairs).union(_star(crowd)).distinct()


def _star(crowd: DataFrame) -> DataFrame:
    """Links among ``crowd(fp)`` through the midpoints of the plain ball."""
    flips = [0, *(1 << i for i in range(64)), *((1 << i) | (1 << j) for i in range(64) for j in range(i))]
    ball = F.array(*[F.lit(_signed(x)) for x in flips])
    ball = crowd.select("fp", F.explode(ball).alias("x")).select("fp", F.col("fp").bitwiseXOR(F.col("x")).alias("mid"))
    hub = F.min(F.when(_distance("fp", "mid") <= 1, F.col("fp"))).over(Window.partitionBy("mid"))
    return ball.withColumn("hub", hub).where("hub <> fp").select(F.col("hub").alias("a"), F.col("fp").alias("b")).distinct()


def near_duplicates(docs: DataFrame, doc: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint, component_id) per row of ``docs``: the
    fingerprint as 16 hex digits, and the smallest doc_id among all rows
    whose fingerprints are reachable over links (null ids count as largest).
    Rows without words share fingerprint zero and are linked like any other.
    Repeated rows give repeated results; an empty table gives an empty one."""
    fps = cut(fingerprints(docs, doc, text, shingle))
    nodes = fps.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    comp = components(links(nodes))
    rooted = nodes.join(comp, nodes["fp"] == comp["id"], "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"))
    first = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = rooted.join(first, "root").select(F.col("fp").alias("_fp"), "component_id")
    out = fps.join(named, F.col("fp") == F.col("_fp"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
