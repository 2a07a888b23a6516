"""Language-model scores from a hashed maximum-entropy model.

Tokens are the words of a text, A-Z lower-cased, and one end. The model is a
class-factored softmax: a token's classes are the digits of its code in a
16-ary Huffman code over the training counts, and its probability is the
product of one small softmax per digit,

    P(digit | node, h) ~ count(child) * exp(sum of the features' weights),

so that a token costs about entropy / 4 softmaxes of 16, and the model without
weights is the unigram model. Features are the last word, the last two, and
the skip to the word two places back, each joined with the node and hashed to
one of 2^``bits`` rows of 16 weights.

* **Counts.** Every task counts its words and the shuffle sums them; the table
  of all counts is written, grows with the corpus and stays distributed.
* **Codes.** The words of at least two training tokens, at most ``SHORTLIST``
  of them (the most frequent), have codes of their own; all others share one,
  the rare code, and divide its probability by their counts plus 0.1. Only the
  shortlist is broadcast. Rare words of a text meet the count table in a join.
* **Weights.** Training runs in ``rounds`` over disjoint parts of all training
  texts, so each is used once. A task starts from the broadcast weights, makes
  mini-batch gradient updates (AdaGrad) over its texts and emits the change of
  every row it touched; the shuffle averages the changes by touches (the
  objective is convex). The tasks are sized by tokens, so that what they emit
  stays in proportion to the input, and the weight table has a fixed size.
* **Scores.** A map over all texts gathers rows of weights for blocks of tokens
  and sums the logarithms per text.

The weights depend in their last digits on how the rows are dealt to tasks;
the base score doesn't. Held-out texts (and those with a null id) are never
trained on. Null text counts as empty: one token, the end. Rows repeated in
full are rows of their own. Without training texts every token has
probability one in the base score and the model. An empty table gives an
empty one.
"""

from __future__ import annotations

from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.llm.base import in_arrow, saved

WAYS = 16                  # children of a node
BITS = 17                  # 2^17 rows of weights: 8 MB
SHORTLIST = 1 << 18        # words with a code of their own
ROUNDS = 2
TASK_TOKENS = 4_000_000    # training tokens of a task
BLOCK = 8_192              # tokens of a mini-batch
RATE = 0.5
MOST = 20.0                # change of a child's logarithm by the weights
FEW = 8                    # events of a row of weights that are added block by block
CHUNK = 2_048              # events whose softmaxes are made at a time: they stay in the cache
ALPHA = 0.1                # added to every count
END = ""                   # the end token in the count table; no word is empty
BEFORE = -1                # history before the text


def tokens(text: bytes | None) -> list[bytes]:
    """Words between ASCII white space with A-Z lower-cased (bytes methods
    change and split at nothing else)."""
    return (text or b"").lower().split()


def training_rows(doc: Column) -> Column:
    """Texts to learn from: CRC-32 of the decimal id not divisible by 10."""
    return F.coalesce(F.crc32(doc.cast("string").cast("binary")) % 10 != 0, F.lit(False))


# ------------------------------------------------------------------- counts
def count_words(texts: DataFrame, flush: int = 200_000) -> DataFrame:
    """(word, c) over ``texts(text)`` in bytes, the end token included."""
    def run(batches):
        seen: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array([w.decode() for w in seen], pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "c"])

        for b in batches:
            for t in b.column(0):
                seen.update(tokens(t.as_py()))
            seen[END.encode()] += b.num_rows
            if len(seen) > flush:
                yield out()
                seen = Counter()
        yield out()

    return in_arrow(texts, run, "word string, c bigint").where("c > 0").groupBy("word").agg(F.sum("c").alias("c"))


# -------------------------------------------------------------------- codes
class Codes:
    """A WAYS-ary Huffman code: per leaf its path of (node, digit), from the
    root; per node the logarithms of its children's shares (-inf: no child)."""

    def __init__(self, weights: np.ndarray):
        n = len(weights)
        pad = (1 - n) % (WAYS - 1) if n > 1 else WAYS - 1
        leaves = np.argsort(weights, kind="stable")
        queue = [(0.0, -1)] * pad + [(float(weights[i]), int(i)) for i in leaves]
        merged: list = []  # made in ascending order: two queues need no heap
        a = b = 0
        children = []
        while len(queue) - a + len(merged) - b > 1 or not children:
            kids = []
            for _ in range(WAYS):
                if a < len(queue) and (b >= len(merged) or queue[a][0] <= merged[b][0]):
                    kids.append(queue[a])
                    a += 1
                elif b < len(merged):
                    kids.append(merged[b])
                    b += 1
            merged.append((sum(w for w, _ in kids), n + len(children)))
            children.append(kids)
        nodes = len(children)
        parent, digit = np.full(n + nodes, -1, np.int64), np.zeros(n + nodes, np.int64)
        self.bias = np.full((nodes, WAYS), -np.inf, np.float32)
        for k, kids in enumerate(children):
            total = sum(w for w, _ in kids) or 1.0
            for d, (w, i) in enumerate(kids):
                if i >= 0:
                    parent[i], digit[i] = k, d
                    self.bias[k, d] = np.log(max(w, 1e-9) / total)
        # paths of all leaves, from the leaf up, in step
        steps, at = [], np.arange(n)
        while (parent[at] >= 0).any():
            steps.append((np.where(parent[at] >= 0, parent[at], -1), digit[at]))
            at = np.where(parent[at] >= 0, n + parent[at], at)
        path = np.array([s[0] for s in steps]).T.reshape(n, -1)[:, ::-1]
        digits = np.array([s[1] for s in steps]).T.reshape(n, -1)[:, ::-1]
        on = path >= 0
        self.start = np.concatenate([[0], np.cumsum(on.sum(1))]).astype(np.int64)
        self.node, self.digit = path[on].astype(np.int32), digits[on].astype(np.int8)

    def events(self, leaf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in ``leaf``, node, digit) of every softmax on the paths."""
        sizes = self.start[leaf + 1] - self.start[leaf]
        at = np.repeat(np.arange(len(leaf)), sizes)
        within = np.arange(len(at)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        e = self.start[leaf][at] + within
        return at, self.node[e], self.digit[e]


# -------------------------------------------------------------------- model
def history(leaf: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Hashes of the features, a row each, at each token of texts strung
    together; ``first`` is the place of each token's text start."""
    at = np.arange(len(leaf))

    def back(k):
        return np.where(at - k >= first, leaf[np.maximum(at - k, 0)], BEFORE).astype(np.uint64)

    one, two = back(1), back(2)
    m1, m2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
    keys = np.stack([one * m1 + np.uint64(1), (one * m1 ^ two * m2) + np.uint64(2), two * m1 + np.uint64(3)])
    keys ^= keys >> np.uint64(31)
    return keys * m2


def rows_for(keys: np.ndarray, node: np.ndarray, bits: int) -> np.ndarray:
    """Row of weights of each (feature, event)."""
    h = (keys + node.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)) * np.uint64(0x9E3779B97F4A7C15)
    return (h >> np.uint64(64 - bits)).view(np.int64)


class Scratch:
    """Arrays of WAYS columns that are used again block by block: fresh ones
    of this size would be given back to the system each time."""

    def __init__(self):
        self.held: dict = {}

    def rows(self, name: str, n: int) -> np.ndarray:
        if len(self.held.get(name, ())) < max(n, 1):
            self.held[name] = np.empty((n + n // 4, WAYS), np.float32)
        return self.held[name][:n]

    def take(self, name: str, table: np.ndarray, at: np.ndarray) -> np.ndarray:
        return np.take(table, at, axis=0, out=self.rows(name, len(at)), mode="clip")


def shares(weights: np.ndarray, bias: np.ndarray, node: np.ndarray, rows: np.ndarray, scratch: Scratch | None = None) -> np.ndarray:
    """Probabilities of the children of each event's node; the weights move
    a child's logarithm by ``MOST`` at most, so no exponential overflows."""
    scratch = scratch or Scratch()
    out, ones = scratch.rows("z", len(node)), np.ones(WAYS, np.float32)
    for a in range(0, len(node), CHUNK):
        z = out[a:a + CHUNK]
        np.take(weights, rows[0, a:a + CHUNK], axis=0, out=z, mode="clip")
        for r in rows[1:]:
            z += scratch.take("c", weights, r[a:a + CHUNK])
        np.clip(z, -MOST, MOST, out=z)
        z += scratch.take("c", bias, node[a:a + CHUNK])
        np.exp(z, out=z)
        z /= (z @ ones)[:, None]
    return out


class Reader:
    """Texts as leaves of the shortlist, block by block."""

    def __init__(self, words: list[bytes]):
        self.rare, self.end = len(words), len(words) + 1
        self.leaf = {w: i for i, w in enumerate(words)} | {END.encode(): self.end}

    def batch(self, texts) -> tuple[list, np.ndarray, np.ndarray]:
        """(all tokens strung together, their leaves, ends of the texts)."""
        flat: list = []
        ends = []
        for t in texts:
            flat += tokens(t)
            flat.append(b"")
            ends.append(len(flat))
        leaf = np.fromiter(map(self.leaf.get, flat, repeat(self.rare)), np.int64, len(flat))
        return flat, leaf, np.array(ends, np.int64)


def _texts(batches, column: int, most: int = 4_000_000):
    """Slices of the batches of about ``most`` bytes of text, one row at least."""
    for b in batches:
        sizes = np.asarray(pc.fill_null(pc.binary_length(b.column(column)), 0), np.int64)
        start = total = 0
        for i, s in enumerate(sizes.tolist()):
            if total and total + s > most:
                yield b.slice(start, i - start)
                start, total = i, 0
            total += s
        if start < b.num_rows:
            yield b.slice(start, b.num_rows - start)


def strung(leaf: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, place of the text's first token) of each token."""
    sizes = np.diff(np.concatenate([[0], ends]))
    text = np.repeat(np.arange(len(ends)), sizes)
    return text, (ends - sizes)[text]


class Learner:
    """Local gradient updates from given weights; AdaGrad with one sum of
    squared gradients per row."""

    def __init__(self, weights: np.ndarray, touches: np.ndarray, codes, rate: float = RATE):
        self.start, self.w = weights, weights.copy()
        # squared gradients so far, estimated from the touches of former rounds
        self.squares = (1.0 + 0.5 * touches).astype(np.float32)
        self.touched = np.zeros(len(weights), np.int64)
        self.codes, self.rate = codes, rate
        self.bits = len(weights).bit_length() - 1
        self.scratch = Scratch()

    def learn(self, leaf: np.ndarray, keys: np.ndarray) -> None:
        at, node, digit = self.codes.events(leaf)
        rows = rows_for(keys[:, at], node, self.bits)
        slope = shares(self.w, self.codes.bias, node, rows, self.scratch)
        np.negative(slope, out=slope)
        slope[np.arange(len(at)), digit] += 1
        # (row, event) as one number: sorting values beats sorting places
        low = np.int64(len(at).bit_length())
        packed = np.sort(((rows << low) | np.arange(len(at))).ravel())
        row, event = packed >> low, packed & ((np.int64(1) << low) - 1)
        first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        n = np.diff(np.append(first, len(row)))
        hit, sums = row[first], self.scratch.take("s", slope, event[first])
        self.add_more(sums, slope, event, first, n)
        squares = self.squares[hit] + np.einsum("ij,ij->i", sums, sums)
        self.squares[hit] = squares
        sums *= (self.rate / np.sqrt(squares))[:, None]
        sums += self.scratch.take("t", self.w, hit)
        self.w[hit] = sums
        self.touched[hit] += n

    def add_more(self, sums: np.ndarray, slope: np.ndarray, event: np.ndarray, first: np.ndarray, n: np.ndarray) -> None:
        """Add to ``sums``, which hold the first event of each row, the others:
        rows in descending order of their events, so that the k-th events of
        those that have so many are added as one block. Longer runs, which are
        few, are left to reduceat; either way takes 32-bit sums in one order."""
        again = np.flatnonzero(n > 1)
        again = again[np.argsort(-n[again], kind="stable")]
        size, start = n[again], first[again]
        long = int(np.searchsorted(-size, -FEW))  # rows with over FEW events
        if long:
            inside = np.repeat(start[:long] - np.cumsum(size[:long]) + size[:long], size[:long]) + np.arange(size[:long].sum())
            runs = np.cumsum(size[:long]) - size[:long]
            sums[again[:long]] = np.add.reduceat(self.scratch.take("t", slope, event[inside]), runs, axis=0)
        again, size, start = again[long:], size[long:], start[long:]
        total = self.scratch.take("u", slope, event[start + 1])
        for k in range(2, FEW):
            more = int(np.searchsorted(-size, -k))  # rows with over k events
            if not more:
                break
            total[:more] += self.scratch.take("t", slope, event[start[:more] + k])
        total += self.scratch.take("t", sums, again)
        sums[again] = total

    def changes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        hit = np.flatnonzero(self.touched)
        return hit, self.touched[hit], self.w[hit] - self.start[hit]


class Model:
    """What scoring needs: counts of the corpus, the shortlist with its
    counts, the codes and the weights."""

    def __init__(self, total, distinct, words, counts, rare_total, rare_distinct, bits):
        self.total, self.distinct, self.bits = total, distinct, bits
        self.words, self.counts = words, counts              # counts: of the words, rare (0), end
        self.base_norm = total + ALPHA * (distinct + 1)
        self.rare_norm = rare_total + ALPHA * (rare_distinct + 1)
        self.codes = Codes(np.concatenate([counts[:-2], [self.rare_norm], counts[-1:]]).astype(float)) if total else None
        self.weights = np.zeros((1 << bits, WAYS), np.float32)
        self.touches = np.zeros(1 << bits, np.int64)


def fit(docs: DataFrame, learn: Column, text: str = "text", bits: int = BITS, shortlist: int = SHORTLIST, rounds: int = ROUNDS,
        task_tokens: int = TASK_TOKENS, part: Column | None = None) -> tuple[Model, DataFrame]:
    """The model of the rows of ``docs`` where ``learn`` holds, and the table
    (word, c) of its rare words. ``part`` (a number) deals the rows to the
    rounds; by default a hash of the text does."""
    spark = docs.sparkSession
    part = F.xxhash64(F.col(text)) if part is None else part
    given = docs.select(F.col(text).cast("string").cast("binary").alias("text"), F.pmod(part, F.lit(rounds)).alias("round"), learn.alias("learn"))
    given = given.where("learn").select("text", "round")
    counts = saved(count_words(given.select("text")))
    # how many words have each count: as many rows as different counts, at
    # most the root of twice the tokens
    spectrum = sorted(((r["c"], r["n"]) for r in counts.groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    total, distinct = sum(c * n for c, n in spectrum), sum(n for _, n in spectrum)
    least, seen = 2, 0
    for c, n in spectrum:
        seen += n
        if seen > shortlist:
            least = max(least, c + 1)
            break
    frequent = (F.col("c") >= least) & (F.col("word") != END)
    found = counts.where(frequent).orderBy(F.desc("c"), "word").toArrow()  # at most ``shortlist`` rows
    words = [w.encode() for w in found["word"].to_pylist()]
    mine = np.array(found["c"].to_pylist(), np.int64)
    end = counts.where(F.col("word") == END).first()
    ends = end["c"] if end else 0
    rare = counts.where(~frequent & (F.col("word") != END))
    rare_total, rare_distinct = total - ends - int(mine.sum()), distinct - len(words) - (1 if ends else 0)
    model = Model(total, distinct, words, np.concatenate([mine, [0, ends]]), rare_total, rare_distinct, bits)
    tasks = max(1, -(-total // (rounds * task_tokens)))
    for r in range(rounds if total else 0):
        shared = spark.sparkContext.broadcast((words, model.codes, model.weights, model.touches))
        texts = given.where(F.col("round") == r).select("text").coalesce(tasks)
        merge = changes(texts, shared).groupBy("row").agg(
            F.sum("n").alias("n"), *[(F.sum(F.col("n") * F.col(f"w{i}")) / F.sum("n")).alias(f"w{i}") for i in range(WAYS)])
        got = merge.toArrow()  # rows of the weight table: 2^bits at most
        at = np.asarray(got["row"].combine_chunks(), np.int64)
        weights, touches = model.weights.copy(), model.touches.copy()
        weights[at] += np.stack([np.asarray(got[f"w{i}"].combine_chunks(), np.float32) for i in range(WAYS)], 1)
        touches[at] += np.asarray(got["n"].combine_chunks(), np.int64)
        model.weights, model.touches = weights, touches
        shared.unpersist()
    return model, rare


def changes(texts: DataFrame, shared) -> DataFrame:
    """(row, n, w0 ..): per task the changed rows of weights with their touches."""
    def run(batches):
        words, codes, weights, touches = shared.value
        reader, learner = Reader(words), Learner(weights, touches, codes)
        for b in _texts(batches, 0):
            _, leaf, ends = reader.batch(b.column(0).to_pylist())
            _, first = strung(leaf, ends)
            keys = history(leaf, first)
            for a in range(0, len(leaf), BLOCK):
                learner.learn(leaf[a:a + BLOCK], keys[:, a:a + BLOCK])
        rows, n, w = learner.changes()
        for a in range(0, len(rows), 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(rows[a:a + 10_000], pa.int64()), pa.array(n[a:a + 10_000], pa.int64()),
                                              *[pa.array(np.ascontiguousarray(w[a:a + 10_000, i]), pa.float32()) for i in range(WAYS)]],
                                             ["row", "n", *[f"w{i}" for i in range(WAYS)]])

    return in_arrow(texts, run, "row bigint, n bigint, " + ", ".join(f"w{i} float" for i in range(WAYS)))


def score_texts(docs: DataFrame, model: Model, rare: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, n_known (tokens seen in
    training), base_score and score, log10 probabilities of the whole text
    under the smoothed unigram counts and the model."""
    spark = docs.sparkSession
    src = docs.select(F.col(doc).alias("doc_id"), F.col(text).cast("string").cast("binary").alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    shared = spark.sparkContext.broadcast((model.words, model.counts, model.base_norm, model.codes, model.weights, model.bits))

    def run(batches):
        words, counts, base_norm, codes, weights, bits = shared.value
        reader, scratch = Reader(words), Scratch()
        base = np.where(np.arange(len(counts)) == reader.rare, 0.0, np.log10((counts + ALPHA) / base_norm))
        for b in _texts(batches, 1):
            flat, leaf, ends = reader.batch(b.column(1).to_pylist())
            text, first = strung(leaf, ends)
            n = len(ends)
            chance = np.zeros(n)
            if codes is not None:
                keys = history(leaf, first)
                for a in range(0, len(leaf), BLOCK):
                    at, node, digit = codes.events(leaf[a:a + BLOCK])
                    share = shares(weights, codes.bias, node, rows_for(keys[:, a:a + BLOCK][:, at], node, bits), scratch)
                    share = np.log(share[np.arange(len(at)), digit].astype(float))
                    low = text[a]  # texts of this block
                    each = np.bincount(text[a:a + BLOCK][at] - low, share)
                    chance[low:low + len(each)] += each
            is_rare = leaf == reader.rare
            known = np.bincount(text, (counts[leaf] > 0).astype(float), minlength=n).astype(np.int64)
            n_rare = np.bincount(text[is_rare], minlength=n).astype(np.int64)
            rare_words = pa.array([flat[i] for i in np.flatnonzero(is_rare).tolist()], pa.binary()).cast(pa.string())
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n_rare)]), pa.int32()), rare_words)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.diff(np.concatenate([[0], ends])), pa.int64()), pa.array(known, pa.int64()),
                 pa.array(n_rare, pa.int64()),
                 pa.array(np.bincount(text, base[leaf], minlength=n), pa.float64()), pa.array(chance / np.log(10.0), pa.float64()),
                 lists],
                ["doc_id", "n_tokens", "known", "n_rare", "base", "chance", "rare"])

    parts = in_arrow(src, run, f"doc_id {kind}, n_tokens bigint, known bigint, n_rare bigint, base double, chance double, rare array<string>")
    parts = saved(parts.withColumn("row", F.monotonically_increasing_id()))  # written: the row numbers stay
    met = parts.select("row", F.explode("rare").alias("word")).join(rare, "word")
    met = met.groupBy("row").agg(F.count(F.lit(1)).alias("met"), F.sum(F.log10((F.col("c") + ALPHA) / ALPHA)).alias("gain"))
    out = parts.drop("rare").join(met, "row", "left")
    gain = F.coalesce("gain", F.lit(0.0))

    def unseen(norm):  # a rare word's share, were it unseen
        return F.col("n_rare") * F.lit(float(np.log10(ALPHA / norm)))

    return out.select("doc_id", "n_tokens", (F.col("known") + F.coalesce("met", F.lit(0))).alias("n_known"),
                      (F.col("base") + unseen(model.base_norm) + gain).alias("base_score"),
                      (F.col("chance") + unseen(model.rare_norm) + gain).alias("score"))


def language_scores(docs: DataFrame, doc: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of
    every row, learned from the rows that are not held out."""
    learn = training_rows(F.col(doc))
    part = F.floor(F.crc32(F.col(doc).cast("string").cast("binary")) / 10)
    model, rare = fit(docs, learn, text, part=part, **options)
    out = score_texts(docs, model, rare, doc, text)
    return out.select("doc_id", (~training_rows(F.col("doc_id"))).alias("held_out"), "n_tokens", "n_known",
                      F.lit(model.total).cast("bigint").alias("train_tokens"), "base_score", "score")
