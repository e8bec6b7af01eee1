"""Word shingles, winnowed passages and their fingerprints, computed per Arrow batch with numpy.

Words are maximal runs of letters and digits of the lower-cased text. A text becomes
* ``cls``: hash of its word sequence, equal for texts that differ only in case, spacing or signs,
* ``grams``: sorted distinct 32-bit hashes of its sequences of three words (exact comparison),
* ``passages``: for winnowed positions the hash ``key`` of eight words and ``ctx``, a 23-bit simhash
  of the five words before and after.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash

WORD = re.compile(r"[^\W_]+")
GRAM, PASSAGE, SIDE, WINDOW, BITS, SHORT = 3, 8, 5, 10, 23, 64
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3,
                 0x1D8E4E27C47D124F, 0xEB44ACCAB455D165, 0xAAAAAAAAAAAAAAAB, 0xBF58476D1CE4E5B9], dtype=np.uint64)
_cache: dict[str, int] = {}


def _hash_words(words: list[str]) -> np.ndarray:
    """64-bit hash of each word; the cache of hashes is emptied when it has grown large."""
    if len(_cache) > 500_000:
        _cache.clear()
    get, new = _cache.get, xxhash.xxh3_64_intdigest
    out = [get(w) for w in words]
    if None in out:
        for i, h in enumerate(out):
            if h is None:
                out[i] = _cache[words[i]] = new(words[i])
    return np.array(out, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


def rolling(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n words; the last n - 1 positions reach beyond the end and are not valid."""
    out = np.zeros(len(h), dtype=np.uint64)
    for k in range(min(n, len(h))):
        out[: len(h) - k] += _mix(h[k:] + np.uint64(k)) * _ODD[k]
    return _mix(out)


def batch_features(texts: list[str | None], passages: bool = True) -> dict:
    """Features of a list of texts. Null, empty and wordless texts have n_words 0 and empty lists."""
    words: list[str] = []
    lens = np.zeros(len(texts), dtype=np.int64)
    for i, t in enumerate(texts):
        if t:
            w = WORD.findall(t.lower())
            lens[i] = len(w)
            words += w
    ends = np.cumsum(lens)
    starts = ends - lens
    h = _hash_words(words)
    total = len(h)
    row = np.repeat(np.arange(len(texts)), lens)
    pos = np.arange(total) - starts[row] if total else np.zeros(0, dtype=np.int64)
    left = lens[row] - pos if total else np.zeros(0, dtype=np.int64)  # words from here to the end
    cls = np.zeros(len(texts), dtype=np.uint64)
    if total:
        spread = np.concatenate([[np.uint64(0)], np.cumsum(_mix(h * _ODD[0] + _mix(pos.astype(np.uint64) + _ODD[1])))])
        cls = _mix((spread[ends] - spread[starts]) ^ _mix(lens.astype(np.uint64) * _ODD[2]))
    gram = (rolling(h, GRAM) >> np.uint64(32)).astype(np.uint32).view(np.int32)
    ok = left >= GRAM
    grow, gval = row[ok], gram[ok]
    order = np.lexsort((gval, grow))
    grow, gval = grow[order], gval[order]
    if len(grow):
        keep = np.concatenate([[True], (grow[1:] != grow[:-1]) | (gval[1:] != gval[:-1])])
        grow, gval = grow[keep], gval[keep]
    goff = np.searchsorted(grow, np.arange(len(texts) + 1)).astype(np.int32)
    out = {"n_words": lens, "cls": cls.view(np.int64), "grams": pa.ListArray.from_arrays(goff, pa.array(gval, pa.int32()))}
    if not passages:
        return out
    key = rolling(h, PASSAGE)
    valid = left >= PASSAGE
    pick = np.zeros(total, dtype=bool)
    if total >= PASSAGE + WINDOW:
        view = np.lib.stride_tricks.sliding_window_view(key, WINDOW)
        at = np.flatnonzero(left[: len(view)] >= PASSAGE + WINDOW - 1)
        for lo in range(0, len(at), 200_000):
            part = at[lo : lo + 200_000]
            pick[part + view[part].argmin(axis=1)] = True
    if total:  # of short texts all positions count, of the shortest the whole text
        n = lens[row]
        pick |= (n < SHORT) & (left >= PASSAGE)
        pick |= (n < PASSAGE) & (n >= GRAM) & (pos == 0)
    p = np.flatnonzero(pick)
    prow = row[p]
    pkey = np.where(valid[p], key[p], cls[prow]) if len(p) else key[:0]
    sums = np.zeros((len(p), BITS), dtype=np.int16)
    shifts = np.arange(BITS, dtype=np.uint64)
    for d in [*range(-SIDE, 0), *range(PASSAGE, PASSAGE + SIDE)]:
        q = p + d
        inside = (q >= starts[prow]) & (q < ends[prow])
        hw = h[np.clip(q, 0, max(0, total - 1))] if total else h
        sums += np.where(inside[:, None], ((hw[:, None] >> shifts) & np.uint64(1)).astype(np.int16) * 2 - 1, 0).astype(np.int16)
    ctx = ((sums > 0).astype(np.int32) << np.arange(BITS, dtype=np.int32)).sum(axis=1).astype(np.int32)
    poff = np.searchsorted(prow, np.arange(len(texts) + 1)).astype(np.int32)
    items = pa.StructArray.from_arrays([pa.array(pkey.view(np.int64)), pa.array(ctx, pa.int32())], names=["key", "ctx"])
    out["passages"] = pa.ListArray.from_arrays(poff, items)
    return out


FEATURES = "n_words int, cls bigint, grams array<int>, passages array<struct<key:bigint,ctx:int>>"


def features(df, keep: list[str], text: str, passages: bool = True):
    """keep columns of df plus FEATURES of column text; without passages only n_words, cls and grams."""
    fields = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)
    last = ["passages"] if passages else []

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 2000):  # bounds the memory of a batch of long texts
                part = b.slice(lo, 2000)
                f = batch_features(part.column(len(keep)).to_pylist(), passages)
                cols = [part.column(i) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays(
                    [*cols, pa.array(f["n_words"].astype(np.int32)), pa.array(f["cls"]), f["grams"], *(f[c] for c in last)],
                    names=[*keep, "n_words", "cls", "grams", *last],
                )

    return df.select(*keep, text).mapInArrow(run, f"{fields}, {FEATURES if passages else FEATURES.rsplit(', passages', 1)[0]}")
