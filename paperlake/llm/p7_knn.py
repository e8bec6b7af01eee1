"""Problem 7: the k most similar vectors of every vector.

Block matrix join of int8 tiles. Unit vectors are rotated into DIM dimensions (a seeded orthogonal
projection) and quantised to int8. A seeded, bounded sample of vectors (at most MAX_CELLS) gives the
centres of cells; every vector is placed in the CELLS_EACH cells whose centres are nearest, and each cell
is joined with itself in tiles of integer products. A cell of more than TILE vectors (their number is told by a sample) is
split into parts, and every pair of parts is a task of its own. An integer product gives the projected cosine with
an error of at most the two quantisation residuals (``slack``); pairs whose upper bound reaches the floor
survive. The floor is NOISE times the spread of the projected cosines of random pairs of the sample.
Surviving pairs are recomputed in float on the full vectors (moved as 16-bit codes, whose cosines are off by
about a millionth), each pair at one place, and merged by rank to the k nearest. Vectors left with fewer than k are compared with all rows, in blocks of at most BLOCK.

Of equal vectors only the k + 1 of least ids are searched for and found: the others' nearest are the first k of them, and
for any other vector they tie with these and come later. So a group of copies costs nothing, however large.

The cells are chosen from a bounded sample, but every vector is indexed. Recall is measured against
brute force in the tests (at least 0.9; see the README for the figures).

Valid vectors have DIMENSION finite values, not all zero; all others, and null ids, are left out. Rows
repeated with the same id count once. Equal cosines are ordered by id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .work import Work

DIMENSION, DIM, K, NOISE, TILE, BLOCK = 256, 128, 5, 4.5, 4096, 4096
CELLS_EACH, CELL_ROWS, MAX_CELLS, SAMPLED = 12, 110, 16384, 16


def valid_vectors(df: DataFrame, ident: str = "id", vector: str = "embedding") -> DataFrame:
    """(id, v): one row per id with a valid vector."""
    v = F.col(vector)
    fine = (F.size(v) == DIMENSION) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return df.where(F.col(ident).isNotNull() & v.isNotNull()).where(fine).select(F.col(ident).alias("id"), v.alias("v"))


def rotation(seed: int = 11) -> np.ndarray:
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((DIMENSION, DIMENSION)))
    return q[:, :DIM].astype(np.float32) * np.float32(np.sqrt(DIMENSION / DIM))


def _matrix(col: pa.Array) -> np.ndarray:
    x = col.flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(len(col), -1)
    return x / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True).astype(np.float32)


def quantise(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """int8 rows and their scales: p is about q * scale."""
    scale = np.maximum(np.abs(p).max(axis=1), 1e-9) / 127
    return np.rint(p / scale[:, None]).astype(np.int8), scale.astype(np.float32)


def coded(vectors: DataFrame) -> DataFrame:
    """(id, v) -> (id, code): unit vectors in 16 bits a dimension, and last their scale."""

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 4096):
                part = b.slice(lo, 4096)
                if not part.num_rows:
                    continue
                x = _matrix(part.column(1))
                q = np.rint(x * (32767 / np.abs(x).max(axis=1, keepdims=True))).astype("<i2")
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([r.tobytes() for r in q], pa.binary())], names=["id", "code"])

    return vectors.select("id", "v").mapInArrow(run, "id bigint, code binary")


def crowded(vectors: DataFrame, centres: np.ndarray) -> dict[int, int]:
    """{cell: parts} of the cells that hold more than TILE vectors, by a sample of one in SAMPLED; at most one entry a cell."""
    some = placed(vectors.where(F.pmod(F.xxhash64(F.lit(5), "id"), F.lit(SAMPLED)) == 0), centres, {})
    rows = some.groupBy("cell").agg(F.count("*").alias("n")).where(F.col("n") * SAMPLED > TILE).collect()
    return {r.cell: -(-r.n * SAMPLED // TILE) for r in rows}


def placed(vectors: DataFrame, centres: np.ndarray, split: dict[int, int]) -> DataFrame:
    """(cell, tile, part, id, q, scale) for the nearest cells of each vector. In a cell of several parts a vector goes to the
    tiles of its part with every part."""
    each = min(CELLS_EACH, len(centres))
    b = vectors.sparkSession.sparkContext.broadcast(centres)
    rot = rotation()

    def tiled(cell, ids, rows):
        """Rows repeated for the tiles of crowded cells."""
        parts = np.array([split.get(c, 1) for c in cell.tolist()], np.int64)
        part = ((ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % parts
        k = np.repeat(np.arange(len(cell)), parts)
        other = np.arange(len(k)) - np.repeat(np.cumsum(parts) - parts, parts)
        mine = part[k]
        return cell[k], (np.minimum(mine, other) * parts[k] + np.maximum(mine, other)).astype(np.int32), mine.astype(np.int32), rows[k]

    def run(batches):
        c = b.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                part = batch.slice(lo, 2048)
                if not part.num_rows:
                    continue
                p = _matrix(part.column(1)) @ rot
                q, scale = quantise(p)
                sim = p @ c.T
                near = np.argpartition(-sim, each - 1, axis=1)[:, :each] if each < len(c) else np.tile(np.arange(each), (len(p), 1))
                n = len(p)
                rows = np.repeat(np.arange(n), each)
                cell, tile, own, rows = near.ravel().astype(np.int32), np.zeros(len(rows), np.int32), np.zeros(len(rows), np.int32), rows
                if split:
                    cell, tile, own, rows = tiled(cell, part.column(0).to_numpy()[rows], rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(cell),
                        pa.array(tile),
                        pa.array(own),
                        part.column(0).take(pa.array(rows)),
                        pa.array([x.tobytes() for x in q], pa.binary()).take(pa.array(rows)),
                        pa.array(scale[rows]),
                    ],
                    names=["cell", "tile", "part", "id", "q", "scale"],
                )

    return vectors.select("id", "v").mapInArrow(run, "cell int, tile int, part int, id bigint, q binary, scale float")


def tile_pairs(ids_a, qa, sa, ids_b, qb, sb, norm_a, norm_b, floor):
    """Pairs of one tile whose upper bound of the projected cosine reaches floor."""
    est = (qa.astype(np.float32) @ qb.astype(np.float32).T) * sa[:, None] * sb[None, :]  # exact integers below 2^24
    # |p.q - est| <= |ep| |q'| + |eq| |p'| with residuals of at most half a step in each dimension
    half = np.float32(0.5 * np.sqrt(DIM))
    est += half * (sa[:, None] * norm_b[None, :] + norm_a[:, None] * sb[None, :])
    i, j = np.nonzero(est >= floor)
    return ids_a[i], ids_b[j]


def _join_cells(batches, floor):
    """Batches sorted by cell and tile -> surviving pairs (a < b)."""
    held, rows = [], 0

    def pairs(ids, q, scale, part):
        """Of one tile: all pairs of one part, or those between two parts."""
        norm = np.linalg.norm(q.astype(np.float32), axis=1) * scale
        one = part == part[0]
        left, right = (np.flatnonzero(one), np.flatnonzero(~one)) if not one.all() else (np.arange(len(ids)),) * 2
        for lo in range(0, len(left), 512):
            a = left[lo : lo + 512]
            for lo2 in range(0 if right is not left else lo, len(right), TILE):
                b = right[lo2 : lo2 + TILE]
                x, y = tile_pairs(ids[a], q[a], scale[a], ids[b], q[b], scale[b], norm[a], norm[b], floor)
                ok = x != y
                if ok.any():
                    yield np.minimum(x, y)[ok], np.maximum(x, y)[ok]

    def flush(final):
        nonlocal held
        key, part, ids, scale = (np.concatenate([h[k] for h in held]) for k in (0, 1, 2, 4))
        q = np.concatenate([h[3] for h in held])
        cut = len(key) if final else int(np.searchsorted(key, key[-1], "left"))
        bounds = np.flatnonzero(np.concatenate([[True], key[1:cut] != key[: max(0, cut - 1)]])) if cut else np.zeros(0, int)
        out = []
        for lo, hi in zip(bounds, np.append(bounds[1:], cut)):
            keep = np.unique(ids[lo:hi], return_index=True)[1] + lo  # a repeated row counts once
            got = list(pairs(ids[keep], q[keep], scale[keep], part[keep]))
            if got:
                out.append(np.unique(np.stack([np.concatenate([g[0] for g in got]), np.concatenate([g[1] for g in got])], axis=1), axis=0))
        held = [(key[cut:], part[cut:], ids[cut:], q[cut:], scale[cut:])] if cut < len(key) else []
        return out

    def send(out):
        for ab in out:
            for lo in range(0, len(ab), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(ab[lo : lo + 100_000, 0].copy()), pa.array(ab[lo : lo + 100_000, 1].copy())], names=["a", "b"])

    for b in batches:
        if b.num_rows:
            q = np.frombuffer(b"".join(b.column(4).to_pylist()), np.int8).reshape(b.num_rows, DIM)
            held.append((b.column(0).to_numpy().astype(np.int64) << 32 | b.column(1).to_numpy(), b.column(2).to_numpy(), b.column(3).to_numpy(), q, b.column(5).to_numpy()))
            rows += b.num_rows
        if rows > 40_000:
            yield from send(flush(False))
            rows = sum(len(h[0]) for h in held)
    if held:
        yield from send(flush(True))


def _rescore(batches):
    """Rows (key, id, code, others) sorted by key: exact cosines of the pairs placed there."""
    held_key, held = None, []

    def solve(rows):
        ids = np.array([r[0] for r in rows], np.int64)
        order = np.argsort(ids, kind="stable")
        ids, first = np.unique(ids[order], return_index=True)
        rows = [rows[i] for i in order[first]]
        x = np.stack([np.frombuffer(r[1], "<i2") for r in rows]).astype(np.float64)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        ii, jj = [], []
        for i, r in enumerate(rows):
            if r[2]:
                o = np.unique(np.asarray(r[2], np.int64))
                at = np.searchsorted(ids, o)
                at = at[(at < len(ids)) & (ids[np.minimum(at, len(ids) - 1)] == o)]
                ii.append(np.full(len(at), i))
                jj.append(at)
        if ii:
            i, j = np.concatenate(ii), np.concatenate(jj)
            for lo in range(0, len(i), 20_000):
                yield ids[i[lo : lo + 20_000]], ids[j[lo : lo + 20_000]], np.einsum("ij,ij->i", x[i[lo : lo + 20_000]], x[j[lo : lo + 20_000]])

    def send(rows):
        for a, b, c in solve(rows):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(c)], names=["a", "b", "cosine"])

    for batch in batches:
        keys = batch.column(0).to_numpy()
        ids = batch.column(1).to_numpy()
        flat = batch.column(2).to_pylist()
        others = batch.column(3).to_pylist()
        for i in range(len(ids)):
            if keys[i] != held_key:
                if held:
                    yield from send(held)
                held_key, held = keys[i], []
            held.append((ids[i], flat[i], others[i]))
    if held:
        yield from send(held)


def _against_all(some: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    """(id, other, cosine): exact nearest of a bounded block of vectors, the best k of every batch of all rows."""
    block = some.toArrow()
    ids = block.column("id").to_numpy()
    x = np.stack([np.asarray(v, np.float32) for v in block.column("v").to_pylist()]) if len(ids) else np.zeros((0, DIMENSION), np.float32)
    shared = vectors.sparkSession.sparkContext.broadcast((ids, x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-30)))

    def run(batches):
        qid, q = shared.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                if not part.num_rows or not len(qid):
                    continue
                other = part.column(0).to_numpy()
                sim = q @ _matrix(part.column(1)).T
                sim[qid[:, None] == other[None, :]] = -2
                m = min(k, sim.shape[1])
                j = np.argpartition(-sim, m - 1, axis=1)[:, :m]
                i = np.repeat(np.arange(len(qid)), m)
                j = j.ravel()
                ok = sim[i, j] > -2
                yield pa.RecordBatch.from_arrays([pa.array(qid[i[ok]]), pa.array(other[j[ok]]), pa.array(sim[i[ok], j[ok]].astype(np.float64))], names=["id", "other", "cosine"])

    return vectors.select("id", "v").mapInArrow(run, "id bigint, other bigint, cosine double")


def neighbours(vectors: DataFrame, rows: int, k: int = K, work: Work | None = None) -> DataFrame:
    """(id, other, cosine, rank): the k nearest other vectors of each, ties by id. rows: about how many."""
    spark = vectors.sparkSession
    work = work or Work(spark, "p7")
    # of equal vectors the k + 1 of least ids stand for all
    mine = Window.partitionBy("h").orderBy("id")
    hashed = vectors.select("id", F.xxhash64("v").alias("h")).distinct().withColumn("r", F.row_number().over(mine))
    more = work.table(hashed.where(F.col("r") > k + 1).select("id", "h"), "more")
    first = vectors.select("id", F.xxhash64("v").alias("h")).distinct().join(more.select("h").distinct(), "h", "left_semi").withColumn("r", F.row_number().over(mine)).where(F.col("r") <= k)
    copies = more.join(first.withColumnRenamed("id", "other"), "h").select("id", "other", F.lit(1.0).alias("cosine"), F.col("r").alias("rank"))
    vectors = vectors.join(more.select("id"), "id", "left_anti")
    cells = int(min(MAX_CELLS, max(1, rows // CELL_ROWS)))
    # the centres: vectors with small hashes, a bounded sample that doesn't depend on the partitions
    want = max(cells, 500)
    share = min(1.0, 1.3 * want / max(1, rows))
    few = vectors.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30))).dropDuplicates(["id"]).limit(2 * want).toArrow()
    few = few.sort_by("id").slice(0, want).column("v").combine_chunks()
    if not len(few):
        return vectors.select("id", F.col("id").alias("other"), F.lit(0.0).alias("cosine"), F.lit(0).alias("rank")).limit(0)
    sample = _matrix(few) @ rotation()
    some = sample[:1500]
    off = (some @ some.T)[np.triu_indices(len(some), 1)]
    floor = float(NOISE * np.median(np.abs(off)) / 0.6745) if len(off) > 100 else -2.0
    centres = sample[:cells] / np.linalg.norm(sample[:cells], axis=1, keepdims=True)
    centres = centres.astype(np.float32)
    tiles = placed(vectors, centres, crowded(vectors, centres)).repartition("cell", "tile").sortWithinPartitions("cell", "tile")
    pairs = work.table(tiles.mapInArrow(lambda b: _join_cells(b, floor), "a bigint, b bigint").distinct(), "pairs")
    # each pair is recomputed at the lesser of the two least neighbours, so that a group of near vectors meets once
    least = pairs.select(F.col("a").alias("id"), F.col("a").alias("m")).union(pairs.select(F.col("b").alias("id"), F.col("a").alias("m"))).groupBy("id").agg(F.min("m").alias("m"))
    at = pairs.join(least.withColumnsRenamed({"id": "a", "m": "ma"}), "a").join(least.withColumnsRenamed({"id": "b", "m": "mb"}), "b").select("a", "b", F.least("ma", "mb").alias("key"))
    both = at.select("key", F.col("a").alias("id"), F.col("b").alias("o")).union(at.select("key", F.col("b").alias("id"), F.lit(None).cast("bigint").alias("o")))
    seats = both.groupBy("key", "id").agg(F.collect_list("o").alias("others"))
    scored = seats.join(coded(vectors), "id").select("key", "id", "code", "others").repartition("key").sortWithinPartitions("key").mapInArrow(_rescore, "a bigint, b bigint, cosine double")
    both = scored.select(F.col("a").alias("id"), F.col("b").alias("other"), "cosine").union(scored.select(F.col("b").alias("id"), F.col("a").alias("other"), "cosine"))
    best = Window.partitionBy("id").orderBy(F.desc("cosine"), "other")
    near = work.table(both.distinct().withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k), "near")
    full = near.where(F.col("rank") == k).select("id")
    rest = work.table(vectors.join(full, "id", "left_anti").dropDuplicates(["id"]), "rest")
    left = rest.count()
    out = near
    if left:
        blocks = -(-left // BLOCK)
        parts = [_against_all(rest.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == i) if blocks > 1 else rest, vectors, k) for i in range(blocks)]
        found = parts[0]
        for x in parts[1:]:
            found = found.union(x)
        found = found.dropDuplicates(["id", "other"]).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        out = near.join(rest.select("id"), "id", "left_anti").unionByName(found)
    return out.unionByName(copies)


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    """(id_a, id_b), id_a < id_b, of which at least one is among the 5 nearest of the other."""
    chunks = spark.read.parquet(f"{sf}/core_chunks.parquet").select("id", "embedding")
    near = neighbours(valid_vectors(chunks), chunks.count())
    return near.select(F.least("id", "other").alias("id_a"), F.greatest("id", "other").alias("id_b")).distinct()
