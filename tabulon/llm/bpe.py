"""BPE encoding and decoding with a contiguous rank array.

A word (one piece of the pre-tokenizer) starts as its single bytes. Its part
boundaries and the merge rank of every adjacent pair of parts lie in one
contiguous row; the smallest rank is found by a scan, the boundary behind it
is deleted and the two neighbouring ranks are looked up anew, until no pair
has a rank. Words are short, so the scan beats a heap; here the rows of many
distinct words form one numpy matrix and each step serves all of them. Words
beyond ``SHORT`` bytes take a heap instead of the quadratic scan, with the
same result (smallest rank first, leftmost among equals).

The vocabulary file (a ``tokenizers`` JSON of a byte-level BPE) is read from
the path on the worker, once per Python process; it is a fixed public file
and part of the tokenizer's installation, not data. The path may be a function
that names it, called where the file is read. Results per word are remembered
in a table that loses its older half when full, so memory is bounded.

Null text counts as empty: no tokens, decoded as ''.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Callable
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from tabulon.llm.base import in_arrow

SHORT = 64               # bytes; longer words go to the heap
REMEMBERED = 500_000     # words kept with their ids per Python process
NO_RANK = np.int32(2**31 - 1)
#: The byte-level pre-tokenizer's pattern (fixed value of the format).
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_alphabet() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary:
    printable Latin-1 for itself, the rest from U+0100 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """Merge ranks and token bytes of one tokenizer file."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab = model["vocab"]
        if model["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError("a byte-level BPE tokenizer file is needed")
        if spec["pre_tokenizer"].get("add_prefix_space") or spec.get("normalizer") or model.get("ignore_merges"):
            raise ValueError("prefix spaces, normalizers and ignore_merges are not supported")
        alphabet = byte_alphabet()
        back = {c: b for b, c in enumerate(alphabet)}
        self.first = np.array([vocab[c] for c in alphabet], np.int32)
        pairs, ranks, ids = [], [], []
        for rank, merge in enumerate(model["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            pairs.append(vocab[a] << 32 | vocab[b])
            ranks.append(rank)
            ids.append(vocab[a + b])
        order = np.argsort(np.array(pairs, np.int64), kind="stable")
        self.pairs = np.array(pairs, np.int64)[order]
        self.ranks = np.array(ranks, np.int32)[order]
        self.merged = np.array(ids, np.int32)[order]
        self.by_pair = dict(zip(pairs, zip(ranks, ids)))
        self.bytes = {i: bytes(back[c] for c in t) for t, i in vocab.items()}
        self.added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        if any(x["lstrip"] or x["rstrip"] or x["single_word"] for x in spec["added_tokens"]):
            raise ValueError("added tokens that strip or need word borders are not supported")
        self.bytes |= {i: t.encode() for t, i in self.added.items()}
        self.pieces = regex.compile(PIECES)
        found = "|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True))
        self.special = regex.compile(f"({found})") if found else None
        # word -> its ids as int32 bytes, as decimal text, and decoded
        self.fixed = {t.encode(): self.entry(np.array([i], np.int32)) for t, i in self.added.items()}
        self.known: dict = dict(self.fixed)

    def entry(self, ids: np.ndarray) -> tuple[bytes, bytes, bytes]:
        """What is remembered of a word."""
        listed = ids.tolist()
        return ids.tobytes(), ",".join(map(str, listed)).encode(), b"".join([self.bytes[i] for i in listed])

    # ------------------------------------------------------------- words
    def lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged id of each pair; NO_RANK where there is none."""
        key = left.astype(np.int64) << 32 | right.astype(np.int64)
        at = np.searchsorted(self.pairs, key)
        at[at == len(self.pairs)] = 0
        hit = self.pairs[at] == key
        return np.where(hit, self.ranks[at], NO_RANK), self.merged[at]

    def merge_short(self, batch: list[bytes]) -> list[np.ndarray]:
        """Ids of words of one to SHORT bytes, all rows in step."""
        n = np.array([len(w) for w in batch])
        width = int(n.max())
        parts = np.full((len(batch), width + 1), -1, np.int32)
        inside = np.arange(width + 1) < n[:, None]
        parts[inside] = self.first[np.frombuffer(b"".join(batch), np.uint8)]
        rank = np.full((len(batch), width + 1), NO_RANK, np.int32)
        new = np.zeros((len(batch), width + 1), np.int32)
        two = np.arange(width + 1) < (n - 1)[:, None]
        r, m = self.lookup(parts[:, :-1][two[:, :-1]], parts[:, 1:][two[:, :-1]])
        rank[two], new[two] = r, m
        out: list = [None] * len(batch)
        rows = np.arange(len(batch))
        while len(rows):
            low = rank.argmin(axis=1)
            at = np.arange(len(rows))
            done = rank[at, low] == NO_RANK
            if done.any():
                for k in np.flatnonzero(done):
                    out[rows[k]] = parts[k, :n[k]].copy()
                go = ~done
                rows, parts, rank, new, n, low = rows[go], parts[go], rank[go], new[go], n[go], low[go]
                if not len(rows):
                    break
                width = int(n.max())
                parts, rank, new = parts[:, :width + 1], rank[:, :width + 1], new[:, :width + 1]
                at = np.arange(len(rows))
            parts[at, low] = new[at, low]
            # delete the boundary behind the merged pair: shift what follows
            col = np.arange(parts.shape[1] - 1)
            src = col + (col > low[:, None])
            keep = np.take_along_axis(parts, src, 1)
            parts = np.concatenate([keep, np.full((len(rows), 1), -1, np.int32)], 1)
            rank = np.concatenate([np.take_along_axis(rank, src, 1), np.full((len(rows), 1), NO_RANK, np.int32)], 1)
            new = np.concatenate([np.take_along_axis(new, src, 1), np.zeros((len(rows), 1), np.int32)], 1)
            n = n - 1
            for left in (low - 1, low):  # refresh the neighbours
                ok = (left >= 0) & (left < n - 1)
                k, c = at[ok], left[ok]
                rank[k, c], new[k, c] = self.lookup(parts[k, c], parts[k, c + 1])
                gone = at[(left >= 0) & ~ok]
                rank[gone, left[gone]] = NO_RANK
        return out

    def merge_long(self, word: bytes) -> np.ndarray:
        ids = self.first[np.frombuffer(word, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(*hit, i, ids[i], ids[i + 1]) for i in range(n - 1) if (hit := self.by_pair.get(ids[i] << 32 | ids[i + 1]))]
        heap = [(r, i, m, a, b) for r, m, i, a, b in heap]
        heapq.heapify(heap)
        while heap:
            _, i, m, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue  # one side has merged meanwhile
            ids[i], ids[j] = m, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for x in (before[i], i):
                if x >= 0 and after[x] < n and (hit := self.by_pair.get(ids[x] << 32 | ids[after[x]])):
                    heapq.heappush(heap, (hit[0], x, hit[1], ids[x], ids[after[x]]))
        return np.array([x for x in ids if x >= 0], np.int32)

    def learn(self, fresh: list[str]) -> None:
        """Encode words not seen yet, in blocks of similar length."""
        coded = sorted(((w.encode("utf-8", "surrogatepass"), w) for w in fresh), key=lambda x: len(x[0]))
        short = [x for x in coded if len(x[0]) <= SHORT]
        for i in range(0, len(short), 4096):
            part = short[i:i + 4096]
            for (_, w), ids in zip(part, self.merge_short([b for b, _ in part])):
                self.known[w] = self.entry(ids)
        for b, w in coded[len(short):]:
            self.known[w] = self.entry(self.merge_long(b))

    # ------------------------------------------------------------- texts
    def split(self, text: str) -> list:
        """Pieces of a text; an added token is a piece (as bytes: no word)."""
        if self.special is None or not any(t in text for t in self.added):
            return self.pieces.findall(text)
        out: list = []
        for part in self.special.split(text):
            if part in self.added:
                out.append(part.encode())
            else:
                out += self.pieces.findall(part)
        return out

    def look_up(self, texts: list[str]) -> list[list[tuple[bytes, bytes, bytes]]]:
        """The entries of the pieces of each text."""
        split = [self.split(t) for t in texts]
        pieces = set().union(*split)
        if len(self.known) + len(pieces - self.known.keys()) > REMEMBERED:
            half = len(self.known) // 2
            self.known = dict(islice(self.known.items(), half, None)) | self.fixed
        self.learn([w for w in pieces - self.known.keys() if isinstance(w, str)])
        look = self.known.__getitem__
        return [list(map(look, ws)) for ws in split]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        return [np.frombuffer(b"".join([e[0] for e in found]), np.int32) for found in self.look_up(texts)]

    def decode(self, ids) -> str:
        look = self.bytes
        return b"".join([look[i] for i in ids if i in look]).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def vocabulary(path: str | Callable[[], str]) -> Vocabulary:
    return Vocabulary(path() if callable(path) else path)


def _blocks(sizes, most: int = 2_000_000):
    """Ranges of rows whose sizes sum up to about ``most``."""
    start, total = 0, 0
    for i, s in enumerate(sizes):
        total += s
        if total >= most:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


def bpe_encode(df: DataFrame, path: str | Callable[[], str], text: str = "text", out: str = "ids") -> DataFrame:
    """``df`` with ``out``: the token ids of ``text`` as array<int>. Other
    columns stay as they are; a column already named ``out`` is replaced."""
    df = df.drop(out) if out in df.columns else df
    schema = StructType([*df.schema.fields, StructField(out, ArrayType(IntegerType()))])
    at = df.columns.index(text)

    def run(batches):
        v = vocabulary(path)
        for batch in batches:
            lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(at)), 0))
            for a, b in _blocks(lengths):
                rows = batch.slice(a, b - a)
                ids = v.encode([t or "" for t in rows.column(at).to_pylist()])
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
                col = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([*rows.columns, col], [*rows.schema.names, out])

    return in_arrow(df, run, schema)


def bpe_decode(df: DataFrame, path: str | Callable[[], str], ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with ``out``: the text that the ids stand for (null ids: '';
    ids outside the vocabulary are left out; bytes that are not UTF-8 become
    U+FFFD)."""
    df = df.drop(out) if out in df.columns else df
    schema = StructType([*df.schema.fields, StructField(out, StringType())])
    at = df.columns.index(ids)

    def run(batches):
        v = vocabulary(path)
        for batch in batches:
            lengths = np.asarray(pc.fill_null(pc.list_value_length(batch.column(at)), 0))
            for a, b in _blocks(lengths, 1_000_000):
                rows = batch.slice(a, b - a)
                texts = pa.array([v.decode(x or ()) for x in rows.column(at).to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([*rows.columns, texts], [*rows.schema.names, out])

    return in_arrow(df, run, schema)


def digests(ids: str = "ids", decoded: str = "decoded") -> list[Column]:
    """The digest columns of an encoded and decoded table."""
    return [F.size(F.coalesce(ids, F.array().cast("array<int>"))).cast("bigint").alias("n_tokens"),
            F.sha2(F.coalesce(F.array_join(F.col(ids).cast("array<string>"), ","), F.lit("")), 256).alias("ids_sha256"),
            F.sha2(F.col(decoded), 256).alias("decoded_sha256")]


def bpe_round_trip(df: DataFrame, path: str | Callable[[], str], doc: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``df``: doc_id, n_tokens, ids_sha256 (of the decimal
    ids joined by commas) and decoded_sha256 (of the text the ids stand for),
    encoded, decoded and hashed in one pass, so that neither the ids nor the
    decoded texts leave the worker."""
    src = df.select(F.col(doc).alias("doc_id"), F.col(text).alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()

    def run(batches):
        v = vocabulary(path)
        for batch in batches:
            lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(1)), 0))
            for a, b in _blocks(lengths):
                rows = batch.slice(a, b - a)
                n, ids, decoded = [], [], []
                for found in v.look_up([t or "" for t in rows.column(1).to_pylist()]):
                    n.append(sum([len(e[0]) for e in found]) // 4)
                    ids.append(hashlib.sha256(b",".join([e[1] for e in found])).hexdigest())
                    back = b"".join([e[2] for e in found]).decode("utf-8", "replace")
                    decoded.append(hashlib.sha256(back.encode()).hexdigest())
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                                                 ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return in_arrow(src, run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
