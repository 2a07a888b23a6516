"""SimHash near-duplicates against brute force."""

import random
import re

import pytest
import xxhash

from tabulon.llm import simhash
from tabulon.llm.base import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_fp(t):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    if not w:
        return 0
    g = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in g]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(fps, radius=3):
    ids = sorted(fps)
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if (fps[a] ^ fps[b]).bit_count() <= radius:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_fingerprints(spark):
    texts = [None, "", " \t\n", "One", "one TWO", "a b c", "Éa B c éa b c d", "x " * 5000, "a\x1cb c d"]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id bigint, text string, fp int")
    out = {r[0]: r[1] for r in simhash.near_duplicates(df).select("doc_id", "fingerprint").collect()}
    assert out == {i: f"{brute_fp(t):016x}" for i, t in enumerate(texts)}


@pytest.mark.parametrize("paired", [2, 128])
def test_components_equal_all_pairs(spark, paired):
    """Clusters around centres at one to five flips, chains, and bits of
    every block; a small bound sends groups through the plain ball."""
    rnd = random.Random(paired)
    fps = {rnd.getrandbits(64) for _ in range(60)} | {0, (1 << 64) - 1}
    for c in list(fps)[:12]:
        for _ in range(25):
            x = c
            for _ in range(rnd.randrange(1, 6)):
                x ^= 1 << rnd.randrange(64)
            fps.add(x)
    for c in list(fps)[:4]:  # chains of three flips, in one block and across
        for step in (0b111, 0b111 << 30, 1 | 1 << 20 | 1 << 63):
            fps.add(c ^ step)
    signed = {x - (1 << 64) if x >> 63 else x: x for x in fps}
    links = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp bigint"), paired=paired)
    got = {r["id"]: r["root"] for r in components(links).collect()}
    want = roots({s: u for s, u in signed.items()})
    assert {s: got.get(s, s) for s in signed} == want


def test_documents(spark):
    base = " ".join(f"w{i}" for i in range(300))
    rows = [(9, base, "s"), (4, base, "s"), (4, base, "s"), (7, base.replace("w7 ", "q "), "s"), (1, None, "s"), (2, "", None), (3, "only here", "s"), (None, base, "s")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, component_id string")
    out = simhash.near_duplicates(df).collect()
    assert len(out) == len(rows)
    comp = {(r["doc_id"]): r["component_id"] for r in out}
    assert comp[9] == comp[4] == comp[None] == 4
    assert comp[1] == comp[2] == 1 and comp[3] == 3
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_component_rounds(spark):
    path = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (5, 5)], "a int, b int")
    out = {r["id"]: r["root"] for r in components(path).collect()}
    assert out == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}
    assert components(path.limit(0)).count() == 0
