"""Repeated substrings by common-prefix intervals of an enhanced suffix array.

All texts are UTF-8 bytes. A byte goes if it lies in a string of ``length``
bytes that starts anywhere else too. Sorting every suffix of the corpus would
shuffle many times its size, so the suffix array is sparse: with k-grams of
about a third of ``length``, the gram with the smallest hash of every
``length - k + 1`` consecutive ones is an anchor (all, if several are
smallest). An anchor depends on its surroundings alone, so every string of
``length`` bytes holds one, with its gram, at the same place in each of its
occurrences. The first one of the smallest in a string settles it: an anchor
has the strings of ``length`` bytes that start in one stretch, and its
neighbourhood is what they cover. Each string is settled once, and no byte
that none of them holds is looked at.

1. Anchors are counted per gram hash and per hash of the neighbourhood (at
   most ``length - k`` bytes to the left, ``length`` to the right). A gram that
   occurs once is dropped. A neighbourhood that occurs twice is repeated as a
   whole: its bytes go without another look.
2. What is left lies at the edges of repeats. These anchors, and one
   representative of each repeated neighbourhood beside them, bring their
   bytes. Sorted by gram and right context they form an enhanced suffix
   array; one scan with a stack enumerates the common-prefix intervals from
   the deepest up. Every interval keeps its members ordered by left context;
   when intervals merge, the smaller one's members are inserted and the
   longest left extension shared with a neighbour tells whether the
   extensions differ, that is, whether the repeat is maximal, and how far it
   reaches for each member. A member of an interval of common prefix r with
   the left extension l has the repeat [-l, r); from l + r = ``length`` on
   it counts. Groups come with all members, not neighbours only.
3. A gram shared by more than ``CROWD`` different neighbourhoods (a passage
   in very many documents) is not scanned in one task: each of its anchors
   emits the hashes of its strings of ``length`` bytes, and those that
   two anchors share are kept, by partial aggregation.

Kept intervals return to their documents by an equi join.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.llm.base import cut, in_arrow, on_key, row_key, saved, small

LENGTH = 400
CROWD = 8192           # neighbourhoods scanned in one task (some 6 MB)
BROADCAST_ROWS = 500_000
ODD = np.uint64(0x9E3779B97F4A7C15)           # base of the rolling hash (odd)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
PRIMES = ((2147483647, 1103515245), (2147483629, 747796405))  # moduli below 2^31 with their bases
_powers: dict = {}


def _prime_table(n: int, prime: int, base: int):
    """Powers of ``base`` and of its inverse modulo ``prime``, by doubling."""
    if len(_powers.get(prime, ((),))[0]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        tables = []
        for b in (base, pow(base, -1, prime)):
            p = np.ones(size, np.uint64)
            done = 1
            while done < size:
                p[done:2 * done] = p[:done] * np.uint64(pow(b, done, prime)) % np.uint64(prime)
                done *= 2
            tables.append(p)
        _powers[prime] = tables
    up, down = _powers[prime]
    return up[:n], down[:n]


def _power_table(n: int):
    """Powers of the base and of its inverse modulo 2^64, grown on demand."""
    if len(_powers.get("up", ())) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        for name, base in (("up", ODD), ("down", INVERSE)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[name] = np.multiply.accumulate(p)
    return _powers["up"][:n], _powers["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


class Rolling:
    """Hashes of substrings of one text. Modulo 2^64 any base has different
    strings of 150 bytes with one hash (the squared product of 1 - x^2k, k to 8,
    times 1 - x^2 is zero at every odd x), so this hash alone only chooses grams, whose bytes
    are compared later; ``of``, which settles equality, adds two primes."""

    def __init__(self, data: bytes):
        b = np.frombuffer(data, np.uint8)
        up, self.down = _power_table(len(b) + 1)
        self.plus = b.astype(np.uint64) + np.uint64(1)
        self.sums = np.empty(len(b) + 1, np.uint64)
        self.sums[0] = 0
        np.cumsum(self.plus * up[:-1], out=self.sums[1:])

    def of(self, start, end) -> np.ndarray:
        out = mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64) * ODD)
        for prime, base in PRIMES:
            p = np.uint64(prime)
            up, down = _prime_table(len(self.sums), prime, base)
            sums = np.zeros(len(self.sums), np.uint64)
            np.cumsum(self.plus * up[:-1] % p, out=sums[1:])  # below 2^31 a byte: no overflow under 8 GB
            out = mix(out ^ ((sums[end] - sums[start]) % p * down[start] % p))
        return out

    def grams(self, k: int) -> np.ndarray:
        return mix((self.sums[k:] - self.sums[:-k]) * self.down[:len(self.sums) - k])


def sliding_min(h: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` consecutive values: running minima of blocks
    from the left and from the right."""
    n = len(h)
    padded = np.full(-(-n // w) * w, np.uint64(2**64 - 1), np.uint64)
    padded[:n] = h
    blocks = padded.reshape(-1, w)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n - w + 1], left[w - 1:n])


def anchors(h: np.ndarray, w: int) -> np.ndarray:
    """Places that hold the minimum of some window of ``w`` grams: those
    equal to the largest of the minima of the windows that hold them."""
    low = np.zeros(len(h) + w - 1, np.uint64)
    low[w - 1:len(h)] = sliding_min(h, w)
    return np.flatnonzero(~sliding_min(~low, w) == h)


def settled(h: np.ndarray, at: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors that are the first minimum of some window of ``w`` grams, and
    the first and last of these windows, which are consecutive."""
    low = sliding_min(h, w)
    own = np.searchsorted(at, np.arange(len(low)))  # the first anchor in each window
    wrong = np.flatnonzero(h[at[own]] != low)
    while len(wrong):
        own[wrong] += 1
        wrong = wrong[h[at[own[wrong]]] != low[wrong]]
    first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
    return at[own[first]], first, np.append(first[1:], len(own)) - 1


def gram_size(length: int) -> int:
    return max(1, length * 8 // 25)


def _find(batch_doc, batch_th, texts, length: int):
    k = gram_size(length)
    back = length - k
    for doc, th, t in zip(batch_doc, batch_th, texts):
        data = (t or "").encode("utf-8", "surrogatepass")
        if len(data) < length:
            continue
        r = Rolling(data)
        h = r.grams(k)
        at, first, last = settled(h, anchors(h, back + 1), back + 1)
        before, after = at - first, last + length - at
        # equal neighbourhoods have their anchor at the same place
        ctx = mix(r.of(first, last + length) ^ (before.astype(np.uint64) << np.uint64(32)) ^ after.astype(np.uint64))
        yield doc, th, at, before, after, h[at].view(np.int64), ctx.view(np.int64)


def find_anchors(texts: DataFrame, length: int) -> DataFrame:
    """(doc_id, th, at, before, after, gram, ctx) of every anchor of
    ``texts(doc_id, th, text)``; its neighbourhood has ``before`` bytes before
    and ``after`` bytes from the anchor on."""
    def run(batches):
        for b in batches:
            for a in range(0, b.num_rows, 500):
                part = b.slice(a, 500)
                cols = ([], [], [], [], [], [], [])
                for doc, th, at, *more in _find(part.column(0).to_pylist(), part.column(1).to_pylist(), (x.as_py() for x in part.column(2)), length):
                    for c, v in zip(cols, ([doc] * len(at), [th] * len(at), at, *more)):
                        c.extend(v if isinstance(v, list) else v.tolist())
                types = [b.schema.field(0).type, pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["doc_id", "th", "at", "before", "after", "gram", "ctx"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    return in_arrow(texts, run, f"doc_id {kind}, th bigint, at int, before int, after int, gram bigint, ctx bigint")


def common(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    x = np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)
    return int(x.argmax())


class Interval:
    """Members of a common-prefix interval in the order of their (reversed)
    left contexts, each with the longest left extension that another shares."""

    __slots__ = ("depth", "keys", "ids")

    def __init__(self, depth, key, member):
        self.depth, self.keys, self.ids = depth, [key], [member]


class Scan:
    """One pass over the sorted anchors of a gram."""

    def __init__(self, length: int):
        self.length = length
        self.left: list[int] = []    # longest valid left extension per member
        self.right: list[int] = []   # longest valid common prefix per member
        self.shared: list[int] = []  # longest left extension shared so far

    def member(self) -> int:
        self.left.append(0)
        self.right.append(0)
        self.shared.append(-1)
        return len(self.left) - 1

    def reach(self, i: int, depth: int, extension: int) -> None:
        """Member i shares ``extension`` bytes to the left with another
        member of an interval of depth ``depth``."""
        if extension > self.shared[i]:
            self.shared[i] = extension
        if self.shared[i] + depth >= self.length:
            if self.shared[i] > self.left[i]:
                self.left[i] = self.shared[i]
            if depth > self.right[i]:
                self.right[i] = depth

    def merge(self, a: Interval, b: Interval, depth: int) -> Interval:
        """Join two intervals at ``depth``; the smaller one is inserted."""
        if len(a.ids) < len(b.ids):
            a, b = b, a
        for key, i in zip(b.keys, b.ids):
            at = bisect_left(a.keys, key)
            if at > 0:
                n = common(key, a.keys[at - 1])
                self.reach(i, depth, n)
                self.reach(a.ids[at - 1], depth, n)
            if at < len(a.keys):
                n = common(key, a.keys[at])
                self.reach(i, depth, n)
                self.reach(a.ids[at], depth, n)
            a.keys.insert(at, key)
            a.ids.insert(at, i)
        a.depth = depth
        return a

    def run(self, rows) -> None:
        """``rows``: (right context, reversed left context) sorted by the
        former. Stack of open intervals, deepest on top."""
        stack: list[Interval] = []
        prefix: list[int] = []  # common prefix of each stack entry with the next
        last = None
        for right, left in rows:
            if last is not None:
                n = common(last, right)
                top = stack.pop()
                while prefix and prefix[-1] >= n:
                    top = self.merge(stack.pop(), top, prefix.pop())
                stack.append(top)
                prefix.append(n)
            stack.append(Interval(len(right), left, self.member()))
            last = right
        while prefix:
            top = stack.pop()
            stack.append(self.merge(stack.pop(), top, prefix.pop()))


def scan_groups(edges: DataFrame, length: int) -> DataFrame:
    """(doc_id, th, s, e) of the repeats at the anchors of
    ``edges(gram, right, left, doc_id, th, at, copies)``."""
    kind = edges.schema["doc_id"].dataType.simpleString()
    sorted_rows = edges.select("gram", "right", "left", "doc_id", "th", "at", "copies").repartition("gram").sortWithinPartitions("gram", "right", "left")

    def settle(group):
        scan = Scan(length)
        scan.run((g[1], g[2]) for g in group)
        for i, g in enumerate(group):
            if g[6] == 1 and scan.right[i]:
                yield g[3], g[4], g[5] - scan.left[i], g[5] + scan.right[i]

    def run(batches):
        group, out = [], []

        def table():
            cols = list(zip(*out)) or [(), (), (), ()]
            types = [sorted_rows_type, pa.int64(), pa.int32(), pa.int32()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["doc_id", "th", "s", "e"])

        sorted_rows_type = pa.int64()
        for b in batches:
            sorted_rows_type = b.schema.field(3).type
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if group and group[0][0] != row[0]:
                    out.extend(settle(group))
                    group = []
                group.append(row)
            if len(out) > 50_000:
                yield table()
                out = []
        if group:
            out.extend(settle(group))
        if out:
            yield table()

    return in_arrow(sorted_rows, run, f"doc_id {kind}, th bigint, s int, e int")


def crowd_windows(edges: DataFrame, length: int) -> DataFrame:
    """(window, doc_id, th, at, off, copies): hashes of every string of
    ``length`` bytes that an anchor of a crowded gram settles. The gram and its place in the window
    are part of the hash, so that equal hashes are different occurrences."""
    back = length - gram_size(length)
    kind = edges.schema["doc_id"].dataType.simpleString()
    src = edges.select("doc_id", "th", "at", "left", "right", "copies", "gram")

    def run(batches):
        for b in batches:
            for a in range(0, b.num_rows, 200):
                part = b.slice(a, 200)
                cols = ([], [], [], [], [], [])
                for doc, th, at, left, right, copies, gram in zip(*(c.to_pylist() for c in part.columns)):
                    data = left[::-1] + right
                    n = len(left)
                    offs = np.arange(max(0, length - len(right)), min(n, back) + 1)
                    if not len(offs):
                        continue
                    w = Rolling(data).of(n - offs, n - offs + length)
                    w = mix(mix(w ^ np.full(1, gram, np.int64).view(np.uint64)) + offs.astype(np.uint64)).view(np.int64)
                    for c, v in zip(cols, (w.tolist(), [doc] * len(w), [th] * len(w), [at] * len(w), offs.tolist(), [copies] * len(w))):
                        c.extend(v)
                types = [pa.int64(), b.schema.field(0).type, pa.int64(), pa.int32(), pa.int32(), pa.int32()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["window", "doc_id", "th", "at", "off", "copies"])

    return in_arrow(src, run, f"window bigint, doc_id {kind}, th bigint, at int, off int, copies int")


def contexts(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes around wanted anchors: ``wanted(doc_id, th, list)`` joined
    with the texts; list holds (at, before, after, gram, copies)."""
    j = on_key(texts, wanted, "inner").select("doc_id", "th", "text", "list")
    kind = texts.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            for a in range(0, b.num_rows, 50):
                part = b.slice(a, 50)
                out = []
                for doc, th, text, marks in zip(*(c.to_pylist() for c in part.columns)):
                    data = text.encode("utf-8", "surrogatepass")
                    for m in marks:
                        at = m["at"]
                        out.append((m["gram"], data[at:at + m["after"]], data[at - m["before"]:at][::-1], doc, th, at, m["copies"]))
                types = [pa.int64(), pa.binary(), pa.binary(), b.schema.field(0).type, pa.int64(), pa.int32(), pa.int32()]
                cols = list(zip(*out)) or [()] * 7
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["gram", "right", "left", "doc_id", "th", "at", "copies"])

    return in_arrow(j, run, f"gram bigint, right binary, left binary, doc_id {kind}, th bigint, at int, copies int")


def repeats(docs: DataFrame, doc: str = "doc_id", text: str = "text", length: int = LENGTH, crowd: int = CROWD) -> DataFrame:
    """(doc_id, th, spans): per text the byte intervals (s, e) that repeated
    strings of ``length`` bytes or more cover, sorted and possibly
    overlapping; texts without one are absent.

    Rows repeated in full are one text that occurs that many times."""
    keyed = docs.select(*row_key(doc, text), F.col(text).alias("text"))
    found = find_anchors(keyed, length)
    # most grams occur once: only anchors of the others go on. The texts are
    # scanned twice for that, which costs less than storing all anchors
    many = found.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram")
    found = saved(found.join(many, "gram", "left_semi"))
    one = [F.first(c).alias(c) for c in ("doc_id", "th", "at", "before", "after")]  # of one row: they are set together
    per_ctx = saved(found.groupBy("gram", "ctx").agg(F.count(F.lit(1)).alias("n"), *one))
    per_gram = cut(per_ctx.groupBy("gram").agg(F.count(F.lit(1)).alias("n_ctx")).where("n_ctx > 1"))

    whole = found.join(per_ctx.where("n > 1").select("gram", "ctx"), ["gram", "ctx"], "left_semi")
    whole = whole.select("doc_id", "th", (F.col("at") - F.col("before")).alias("s"), (F.col("at") + F.col("after")).alias("e"))

    # different neighbourhoods that share a gram, one row each
    edges = per_ctx.join(per_gram.select("gram"), "gram", "left_semi").select("doc_id", "th", F.struct(
        "at", "before", "after", "gram", F.least("n", F.lit(2)).cast("int").alias("copies")).alias("m"))
    wanted = cut(edges.groupBy("doc_id", "th").agg(F.collect_list("m").alias("list")))
    held = on_key(keyed, small(cut(wanted.select("doc_id", "th")), BROADCAST_ROWS), "left_semi").dropDuplicates(["doc_id", "th"])
    near = contexts(held, wanted, length)
    crowded = cut(per_gram.where(F.col("n_ctx") > crowd).select("gram"))
    if crowded.isEmpty():
        spans = whole.union(scan_groups(near, length))
    else:
        near = saved(near)
        windows = crowd_windows(near.join(crowded, "gram", "left_semi"), length)
        shared = windows.groupBy("window").agg(F.sum("copies").alias("n")).where("n > 1").select("window")
        reach = windows.join(shared, "window", "left_semi").where("copies = 1").groupBy("doc_id", "th", "at").agg(
            F.max("off").alias("most"), F.min("off").alias("least"))
        reach = reach.select("doc_id", "th", (F.col("at") - F.col("most")).alias("s"), (F.col("at") - F.col("least") + length).alias("e"))
        spans = whole.union(scan_groups(near.join(crowded, "gram", "left_anti"), length)).union(reach)
    return spans.groupBy("doc_id", "th").agg(F.sort_array(F.collect_set(F.struct("s", "e"))).alias("spans"))


def remove_repeats(docs: DataFrame, doc: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans,
    kept (the remaining bytes) and removed (array of s, e). Null text counts
    as empty; texts shorter than ``length`` bytes lose nothing; rows
    repeated in full are copies of each other and go whole if long enough;
    an empty table gives an empty one."""
    spans = cut(repeats(docs, doc, text, length))
    keys = small(cut(spans.select("doc_id", "th")), BROADCAST_ROWS)
    rows = docs.select(*row_key(doc, text), F.col(text).alias("text"))
    # texts without a repeat need not meet the intervals in a shuffle
    touched = on_key(on_key(rows, keys, "left_semi"), spans)
    free = on_key(rows, keys, "left_anti").withColumn("spans", F.lit(None).cast(spans.schema["spans"].dataType))
    j = touched.unionByName(free).select("doc_id", "text", "spans")
    kind = j.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            for a in range(0, b.num_rows, 200):
                part = b.slice(a, 200)
                rows = []
                for t, sp in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    data = (t or "").encode("utf-8", "surrogatepass")
                    gone, kept, at = [], [], 0
                    for x in sp or ():
                        s, e = max(0, x["s"]), min(x["e"], len(data))
                        if gone and s <= gone[-1]["e"]:
                            gone[-1]["e"] = max(gone[-1]["e"], e)
                        else:
                            gone.append({"s": s, "e": e})
                    for x in gone:
                        kept.append(data[at:x["s"]])
                        at = x["e"]
                    kept.append(data[at:])
                    rows.append((len(data), sum(x["e"] - x["s"] for x in gone), len(gone), b"".join(kept), gone))
                cols = list(zip(*rows)) or [()] * 5
                types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))]
                yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(c, t) for c, t in zip(cols, types)]],
                                                 ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "removed"])

    return in_arrow(j, run, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary, removed array<struct<s:int,e:int>>")
