"""Exact lookup of near texts by their rarest three-word sequences.

Two texts are near if they share at least 0.6 of the sequences of the smaller one. So of any n - ceil(0.6 n) + k of
the n sequences of the smaller text at least k are in the larger one (its prefix; k is MEET, or all 0.6 n of a very
short text). This holds for any fixed order of sequences; the order here is by rising frequency, so that prefixes
have few texts in common. No pair of near texts is lost, whatever its lengths and edits.

The prefixes go to the executors as sorted blocks of at most BLOCK sequences; each text looks up all its sequences
in each block and keeps the smaller texts of which it has k. Of the rest of each smaller text the block has short
hashes: those that the larger text lacks aren't shared for certain, so what can't reach 0.6 without them isn't near and
leaves the task no more. Every block is a pass over the texts, so memory is bounded, but passes grow with the number of
texts.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .work import Work

MEET = 6  # sequences of the prefix that must be shared; more make longer prefixes with more hits, fewer make more pairs to check
BLOCK = 1 << 21  # sequences of one broadcast block
COUNTER_BITS = 22  # counters of frequencies, 4 bits each: 2 MB broadcast; texts whose counters clash only rank worse
CHUNKS = 64  # parts of the counters, merged apart
COMMON = 26  # what more than one in COMMON texts has is at the highest level, in large tables; prefixes end well below that
EXPANDED = 4_000_000  # looked-up rows in memory at once
REST_BITS = 14  # of a hash of a sequence beyond the prefix; hashes that clash only keep a pair that is told by the exact check
MARKED = 256  # texts whose hashes are marked at once, 4 MB


def _at(g: np.ndarray) -> np.ndarray:
    return g & ((1 << COUNTER_BITS) - 1)


def frequencies(f: DataFrame, n: int | None = None) -> DataFrame:
    """(w, m): 16 counters of 4 bits a row, the rounded logarithm of how many of the n texts f (grams) have a sequence of
    that counter; 0: one text at most. The levels spread with n: if they ended at a fixed count, most sequences of a large
    table would be at the highest, and prefixes no longer rare. Every task sends its counters once, as CHUNKS arrays of
    16-bit counts."""
    size = 1 << COUNTER_BITS
    spread = 15 / np.log2(max(1024, (f.count() if n is None else n) / COMMON))

    def count(batches):
        c = np.zeros(size, np.int32)
        for b in batches:
            c += np.bincount(_at(b.column(0).flatten().to_numpy()), minlength=size).astype(np.int32)
        c = np.minimum(c, 65535).astype(np.uint16).reshape(CHUNKS, -1)
        some = np.flatnonzero(c.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array([c[i].tobytes() for i in some], pa.binary())], names=["chunk", "counts"])

    def levels(batches):
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for i, x in zip(b.column(0).to_pylist(), b.column(1)):
                part = np.frombuffer(x.as_buffer(), np.uint16).astype(np.int64)
                held[i] = held[i] + part if i in held else part
        for i, c in held.items():
            level = np.clip(np.floor(np.log2(np.maximum(c, 1)) * spread + 0.001), c > 1, 15).astype(np.int64).reshape(-1, 16)
            m = np.bitwise_or.reduce(level << (np.arange(16) * 4), axis=1)
            w = np.flatnonzero(m)
            yield pa.RecordBatch.from_arrays([pa.array((w + i * len(m)).astype(np.int32)), pa.array(m[w])], names=["w", "m"])

    return f.select("grams").mapInArrow(count, "chunk int, counts binary").repartition("chunk").mapInArrow(levels, "w int, m bigint")


def order(rows: DataFrame) -> np.ndarray:
    """The level of each counter: at most 2^COUNTER_BITS / 16 rows reach the driver."""
    t = rows.toArrow()
    out = np.zeros(1 << (COUNTER_BITS - 4), np.int64)
    out[t["w"].to_numpy()] = t["m"].to_numpy()
    return ((out[:, None] >> (np.arange(16) * 4)) & 15).astype(np.uint8).ravel()


def needed(n, meet: int = MEET):
    """How many sequences of its prefix a text of n sequences must share; n is an array."""
    return np.minimum(meet, (n * 6 + 9) // 10)


def ranks(n: np.ndarray, g: np.ndarray, levels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lists of n sequences each, laid end to end as g: the row of each and its place in the order within its row."""
    row = np.repeat(np.arange(len(n)), n)
    o = np.lexsort((g, levels[_at(g)], row))
    place = np.empty(len(g), np.int64)
    place[o] = np.arange(len(g)) - np.repeat(np.cumsum(n) - n, n)
    return row, place


def prefixes(f: DataFrame, levels: np.ndarray) -> DataFrame:
    """f (cls, grams) -> (cls, n, grams, rest): the prefix of each text and hashes of its other sequences, both without
    the sequences that no other text has."""
    shared = f.sparkSession.sparkContext.broadcast(levels)

    def run(batches):
        for b in batches:
            lists = b.column(1)
            n, g = lists.value_lengths().to_numpy().astype(np.int64), lists.flatten().to_numpy()
            row = np.repeat(np.arange(len(n)), n)
            level = shared.value[_at(g)]
            o = np.lexsort((g, level, row))
            g, level = g[o], level[o]
            place = np.arange(len(g)) - np.repeat(np.cumsum(n) - n, n)
            prefix = place < (n - (n * 6 + 9) // 10 + needed(n))[row]
            cols = [b.column(0), pa.array(n.astype(np.int32))]
            for take, x, kind in ((prefix & (level > 0), g, pa.int32()), (~prefix & (level > 0), _rest_hash(g), pa.int16())):
                off = np.concatenate([[0], np.cumsum(np.bincount(row[take], minlength=len(n)))]).astype(np.int32)
                cols.append(pa.ListArray.from_arrays(off, pa.array(x[take], kind)))
            yield pa.RecordBatch.from_arrays(cols, names=["cls", "n", "grams", "rest"])

    return f.select("cls", "grams").mapInArrow(run, "cls bigint, n int, grams array<int>, rest array<smallint>")


def _rest_hash(g: np.ndarray) -> np.ndarray:
    return (g & ((1 << REST_BITS) - 1)).astype(np.int16)


def _short(x: np.ndarray) -> np.ndarray:
    """Numbers from 0 in the least type that holds them."""
    return x.astype(np.min_scalar_type(int(x.max(initial=0))))


class Block:
    """Prefixes of texts, ready to be looked up: what is sent is sequences in rising order by their steps, the text of
    each, and cls, n and the rest's hashes of each text; each worker unpacks it once."""

    def __init__(self, cls, n, g, text, rest, m):
        o = np.lexsort((n[text], g))
        g = g[o].astype(np.int64)
        self.cls, self.n, self.first, self.steps, self.text, self.rest, self.m = cls, n, int(g[0]), _short(np.diff(g)), _short(text[o]), rest, _short(m)

    def __getstate__(self):
        return {k: self.__dict__[k] for k in ("cls", "n", "first", "steps", "text", "rest", "m")}

    @cached_property
    def key(self) -> np.ndarray:
        """Sequences in rising order, and the size of the text in the lower half."""
        g = np.concatenate([[self.first], self.first + np.cumsum(self.steps, dtype=np.int64)])
        return g << 32 | self.n[self.text]

    @cached_property
    def has(self) -> np.ndarray:
        has = np.zeros(1 << COUNTER_BITS, bool)
        has[_at(self.key >> 32)] = True
        return has

    @cached_property
    def need(self) -> np.ndarray:
        return needed(self.n.astype(np.int64))

    @cached_property
    def start(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.m, dtype=np.int64)])

    def reach(self, a: np.ndarray, met: np.ndarray, row: np.ndarray, lists: pa.ListArray) -> np.ndarray:
        """Whether text a of the block, of whose prefix met sequences are in list row, can share 0.6 of its sequences
        with it; row rises."""
        off, q = lists.offsets.to_numpy(), lists.values.to_numpy()
        out = np.zeros(len(a), bool)
        m = self.m[a].astype(np.int64)
        ends, k = np.cumsum(m), 0
        marks = np.zeros((MARKED, 1 << REST_BITS), bool)
        while k < len(a):  # in parts that fit the marks and the memory
            stop = min(int(np.searchsorted(row, row[k] + MARKED)), max(k + 1, int(np.searchsorted(ends, (ends[k - 1] if k else 0) + EXPANDED, "right"))))
            lo, hi = row[k], row[stop - 1] + 1
            marks[:] = False
            marks[np.repeat(np.arange(hi - lo), np.diff(off[lo : hi + 1])), _rest_hash(q[off[lo] : off[hi]])] = True
            w = m[k:stop]
            pair = np.repeat(np.arange(stop - k), w)
            at = np.arange(len(pair)) - np.repeat(np.cumsum(w) - w - self.start[a[k:stop]], w)
            shared = np.bincount(pair[marks[row[k:stop][pair] - lo, self.rest[at]]], minlength=stop - k)
            out[k:stop] = (met[k:stop] + shared) * 10 >= self.n[a[k:stop]].astype(np.int64) * 6
            k = stop
        return out


def _blocks(index: DataFrame, work: Work, name: str):
    """The written prefixes as Block objects."""
    index = work.table(index.where(F.size("grams") > 0), name)
    total = index.agg(F.sum(F.size("grams"))).first()[0] or 0
    parts = -(-total // BLOCK)
    for i in range(parts):
        t = index.where(F.pmod(F.xxhash64("cls"), F.lit(parts)) == i).toArrow().combine_chunks()
        if not t.num_rows:
            continue
        lists, rest = t["grams"].combine_chunks(), t["rest"].combine_chunks()
        text = np.repeat(np.arange(t.num_rows), lists.value_lengths().to_numpy())
        yield Block(t["cls"].to_numpy(), t["n"].to_numpy(), lists.flatten().to_numpy(), text, rest.flatten().to_numpy(), rest.value_lengths().to_numpy())
    work.drop(name)


def _looked_up(shared):
    def run(batches):
        block = shared.value
        key, text, cls, n, has, need = block.key, block.text, block.cls, block.n, block.has, block.need
        for batch in batches:
            for first in range(0, batch.num_rows, 4000):
                b = batch.slice(first, 4000)
                mine, lists = b.column(0).to_numpy(), b.column(1)
                size, q = lists.value_lengths().to_numpy().astype(np.int64), lists.flatten().to_numpy()
                row = np.repeat(np.arange(len(size)), size)
                at = np.flatnonzero(has[_at(q)])
                q, row = q[at], row[at]
                o = np.argsort(q)
                low = q[o].astype(np.int64) << 32
                lo, hi = np.empty(len(q), np.int64), np.empty(len(q), np.int64)
                lo[o] = np.searchsorted(key, low, "left")
                hi[o] = np.searchsorted(key, low | size[row[o]], "right")  # smaller texts only
                some = np.flatnonzero(hi > lo)
                lo, m, row = lo[some], (hi - lo)[some], row[some]
                if not len(lo):
                    continue
                ends = np.cumsum(m)
                cut = np.append(np.flatnonzero(row[1:] != row[:-1]) + 1, len(row))  # ends of texts
                start = 0
                while start < len(row):
                    done = ends[start - 1] if start else 0
                    k = np.searchsorted(ends[cut - 1], done + EXPANDED, "right")
                    stop = int(cut[max(k - 1, 0)])
                    if stop <= start:  # one text of many rows
                        stop = int(cut[np.searchsorted(cut, start, "right")])
                    w = m[start:stop]
                    a = text[np.arange(w.sum()) - np.repeat(np.cumsum(w) - w - lo[start:stop], w)]
                    pair = np.sort(np.repeat(row[start:stop] * len(cls), w) + a)
                    new = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
                    met = np.diff(np.append(new, len(pair)))
                    pair = pair[new]
                    a, r = pair % len(cls), pair // len(cls)
                    ok = np.flatnonzero((met >= need[a]) & (cls[a] != mine[r]))
                    ok = ok[block.reach(a[ok], met[ok], r[ok], lists)]
                    if len(ok):
                        x, y = cls[a[ok]], mine[r[ok]]
                        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"])
                    start = stop

    return run


def lookup(index: DataFrame, texts: DataFrame, levels: np.ndarray, work: Work, name: str) -> DataFrame | None:
    """index, texts (cls, grams) -> (a, b), a < b: all near pairs of an index text and one of the texts that is no
    smaller, and some more; None if there are none to look up. levels is the order, made from all the texts."""
    out = None
    for block in _blocks(prefixes(index, levels), work, f"{name}-prefixes"):
        got = texts.select("cls", "grams").mapInArrow(_looked_up(texts.sparkSession.sparkContext.broadcast(block)), "a bigint, b bigint")
        out = got if out is None else out.unionByName(got)
    return out
