"""Problem 8: the whole corpus encoded with a public byte-level BPE vocabulary, without special tokens.

The distinct pieces of a batch are put into padded matrices of about equal length (length buckets). Every round
each row merges its leftmost pair of least rank, found in a hash table of pairs; rows are then compacted, and
rows without a pair left leave the matrix.

Null, empty and blank-free texts: null and empty texts give an empty list of ids. Text that looks like a special
token is ordinary text. Very long pieces are encoded whole: beyond LONG bytes, where rounds over a whole row cost too much,
the same merges in the same order come from a heap over a linked list. The vocabulary file is a parameter.
"""

from __future__ import annotations

import base64
import heapq
import os

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VOCABULARY = os.environ.get("PAPERLAKE_TOKENIZERS", "/opt/tokenizers") + "/byte_bpe_50k.tiktoken"
#: Fixed value: the public pattern by which this vocabulary's texts are cut into pieces.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_NONE = np.int32(2**31 - 1)
LONG = 1024  # bytes of a piece that goes into a matrix
_CACHE = 200_000  # pieces kept between batches


def read_vocabulary(path: str = VOCABULARY) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class PairTable:
    """Open-addressing hash table (left id, right id) -> id of the merged token."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs = {}
        for token, r in ranks.items():
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = r
        keys = np.array(list(pairs), dtype=np.int64)
        values = np.array(list(pairs.values()), dtype=np.int32)
        self.bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 4))))
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, _NONE, np.int32)
        at, left, self.reach = self._slot(keys), np.arange(len(keys)), 0
        while len(left):  # the first to reach a free slot takes it, the others go one on
            slot = at[left]
            free = self.keys[slot] == -1
            first = np.unique(slot[free], return_index=True)[1]
            won = np.flatnonzero(free)[first]
            self.keys[slot[won]], self.values[slot[won]] = keys[left[won]], values[left[won]]
            left = np.delete(left, won)
            at[left] = (at[left] + 1) & ((1 << self.bits) - 1)
            self.reach += 1

    def _slot(self, keys):
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Id of the merged pair, or the greatest int where there is none or a side is padding."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        out = np.full(keys.shape, _NONE, np.int32)
        at = self._slot(keys)
        todo = (left >= 0) & (right >= 0)
        for _ in range(self.reach):
            k = self.keys[at]
            hit = todo & (k == keys)
            out[hit] = self.values[at[hit]]
            todo &= ~hit & (k != -1)
            if not todo.any():
                break
            at = (at + 1) & ((1 << self.bits) - 1)
        return out


class Encoder:
    def __init__(self, ranks: dict[bytes, int]):
        self.table = PairTable(ranks)
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.whole = ranks
        self.pieces = regex.compile(PATTERN)
        self.cache: dict[str, np.ndarray] = {}

    def _merge(self, m: np.ndarray) -> list[np.ndarray]:
        """Ids of each padded row."""
        out: list = [None] * len(m)
        rows = np.arange(len(m))
        rank = self.table.ranks(m[:, :-1], m[:, 1:]) if m.shape[1] > 1 else np.full((len(m), 0), _NONE, np.int32)
        while len(rows):
            at = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(rows), int)
            low = rank[np.arange(len(rows)), at] if rank.shape[1] else np.full(len(rows), _NONE)
            done = low == _NONE
            if done.any():
                for i in np.flatnonzero(done):
                    r = m[i]
                    out[rows[i]] = r[r >= 0]
                keep = ~done
                rows, m, rank, at, low = rows[keep], m[keep], rank[keep], at[keep], low[keep]
                if not len(rows):
                    break
            i = np.arange(len(rows))
            m[i, at] = low
            col = np.arange(m.shape[1] - 1)
            m = np.take_along_axis(m, col + (col > at[:, None]), axis=1)  # the right part of the pair is taken out
            if rank.shape[1] > 1:
                col = np.arange(rank.shape[1] - 1)
                rank = np.take_along_axis(rank, col + (col >= at[:, None]), axis=1)
                left = np.maximum(at - 1, 0)
                has = at > 0
                rank[i[has], left[has]] = self.table.ranks(m[i[has], left[has]], m[i[has], at[has]])
                has = at < m.shape[1] - 1
                rank[i[has], at[has]] = self.table.ranks(m[i[has], at[has]], m[i[has], at[has] + 1])
            else:
                rank = rank[:, :0]
        return out

    def _merge_long(self, ids: np.ndarray) -> np.ndarray:
        """Ids of one long piece: the leftmost pair of least rank is merged until there is none, as in a matrix."""
        token, n = ids.tolist(), len(ids)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i) for i, r in enumerate(self.table.ranks(ids[:-1], ids[1:]).tolist()) if r != _NONE]
        rank = dict((i, r) for r, i in heap)  # of the pair that begins at a place; what the heap says otherwise is out of date
        heapq.heapify(heap)

        def pair(i):
            j = after[i]
            r = int(self.table.ranks(np.array([token[i]], np.int32), np.array([token[j]], np.int32))[0]) if j < n else int(_NONE)
            rank[i] = r
            if r != _NONE:
                heapq.heappush(heap, (r, i))

        while heap:
            r, i = heapq.heappop(heap)
            if rank.get(i) != r:
                continue
            j = after[i]
            token[i], rank[j] = r, int(_NONE)
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            token[j] = -1
            pair(i)
            if before[i] >= 0:
                pair(before[i])
        return np.array([t for t in token if t >= 0], np.int32)

    def encode_pieces(self, pieces: list[str]) -> list[np.ndarray]:
        raw = [p.encode("utf-8", "surrogatepass") for p in pieces]
        out: list = [None] * len(raw)
        buckets: dict[int, list[int]] = {}
        for i, b in enumerate(raw):
            r = self.whole.get(b)
            if r is not None:
                out[i] = np.array([r], np.int32)
            else:
                n = len(b)
                if n > LONG:
                    out[i] = self._merge_long(self.bytes[np.frombuffer(b, np.uint8)])
                    continue
                buckets.setdefault(n if n <= 24 else 1 << (n - 1).bit_length(), []).append(i)
        for width, group in buckets.items():
            step = max(1, 2_000_000 // width)  # bounds the memory of a matrix
            for lo in range(0, len(group), step):
                part = group[lo : lo + step]
                longest = max(len(raw[i]) for i in part)
                m = np.full((len(part), longest), -1, np.int32)
                for k, i in enumerate(part):
                    m[k, : len(raw[i])] = self.bytes[np.frombuffer(raw[i], np.uint8)]
                for i, ids in zip(part, self._merge(m)):
                    out[i] = ids
        return out

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Offsets and ids of the texts."""
        index: dict[str, int] = {}
        codes, counts = [], np.zeros(len(texts), np.int64)
        for k, t in enumerate(texts):
            if t:
                p = self.pieces.findall(t)
                counts[k] = len(p)
                codes += [index.setdefault(x, len(index)) for x in p]
        new = [p for p in index if p not in self.cache]
        if len(self.cache) + len(new) > _CACHE:
            self.cache.clear()
            new = list(index)
        for p, ids in zip(new, self.encode_pieces(new)):
            self.cache[p] = ids
        parts = [self.cache[p] for p in index]
        size = np.array([len(x) for x in parts], np.int64)
        flat = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        start = np.cumsum(size) - size
        codes = np.array(codes, np.int64)
        n = size[codes] if len(codes) else np.zeros(0, np.int64)
        ends = np.cumsum(n)
        ids = flat[np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - n, n) + np.repeat(start[codes] if len(codes) else n, n)]
        piece_end = np.concatenate([[0], ends])
        return piece_end[np.concatenate([[0], np.cumsum(counts)])], ids


_encoders: dict[str, Encoder] = {}


def encoder(path: str, ranks: dict[bytes, int]) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(ranks)
    return _encoders[path]


def encoded(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = VOCABULARY, counts: bool = False, keep: tuple = ()) -> DataFrame:
    """(key, *keep, ids), or with counts (key, *keep, tokens). The vocabulary (under 1 MB) is read once and broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))
    cols = [key, *keep]

    def run(batches):
        enc = encoder(path, shared.value)
        for b in batches:
            for lo in range(0, b.num_rows, 1000):
                part = b.slice(lo, 1000)
                off, ids = enc.encode(part.column(len(cols)).to_pylist())
                got = pa.array(np.diff(off)) if counts else pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(cols))), got], names=[*cols, "tokens" if counts else "ids"])

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in cols)
    return docs.select(*cols, text).mapInArrow(run, f"{fields}, " + ("tokens bigint" if counts else "ids array<int>"))


def p8_ids(spark: SparkSession, sf: str) -> DataFrame:
    """(doc_id, ids) of every document."""
    return encoded(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"))


def p8_lengths(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens per language and source."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "source", "text")
    return encoded(docs, counts=True, keep=("lang", "source")).groupBy("lang", "source").agg(F.count("*").alias("docs"), F.sum("tokens").alias("tokens"))
