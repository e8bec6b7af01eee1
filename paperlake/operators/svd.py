"""Low-rank vectors of sparse rows: randomized range finding with matrices kept as rows.

What is held on the driver is bounded by the vocabulary: one matrix of terms x (dim + EXTRA)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..work import Work
from . import sparse
from .retrieval import top_k
from .tfidf import weights

EXTRA, ROUNDS, SEED = 16, 7, 42
TOLERANCE = 0.02  # a smaller dimension is taken if its overlap is so near to the best


def _products(rows: DataFrame, q: np.ndarray) -> np.ndarray:
    """A'A q for the sparse rows A (terms are places): each task sends one matrix of the size of q to be added up."""
    shared = rows.sparkSession.sparkContext.broadcast(q)

    def run(batches):
        q = shared.value
        total = np.zeros_like(q)
        for b in batches:
            i, t, w = sparse._flat(b.column(1), b.column(2))
            if len(t):
                start = np.flatnonzero(np.concatenate([[True], i[1:] != i[:-1]]))
                y = np.add.reduceat(w[:, None] * q[t], start, axis=0)
                np.add.at(total, t, w[:, None] * np.repeat(y, np.diff(np.append(start, len(i))), axis=0))
        at = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array([x.tobytes() for x in total[at]], pa.binary())], names=["t", "v"])

    out = np.zeros_like(q)
    for b in rows.mapInArrow(run, "t int, v binary").toArrow().to_batches():  # tasks x terms rows
        np.add.at(out, b.column(0).to_numpy(), np.frombuffer(b"".join(b.column(1).to_pylist()), np.float64).reshape(b.num_rows, -1))
    return out


class Svd:
    """The right factor of rows (ident, term, w): fit, then vectors of any rows over the same terms."""

    def __init__(self, w: DataFrame, ident: str, most: int, work: Work):
        """most: the largest dimension asked for later."""
        terms = [r[0] for r in w.select("term").distinct().orderBy("term").toLocalIterator()]  # at most the vocabulary
        self.spark, self.places = w.sparkSession, {t: i for i, t in enumerate(terms)}
        self.index = work.table(self.spark.createDataFrame(list(self.places.items()), "term string, t int"), "terms")
        rows = work.table(self.placed(w, ident), "rows")
        k = max(1, min(most + EXTRA, len(terms)))
        q = np.linalg.qr(np.random.default_rng(SEED).standard_normal((max(1, len(terms)), k)))[0]
        for _ in range(ROUNDS):
            q = np.linalg.qr(_products(rows, q))[0]
        s, u = np.linalg.eigh(q.T @ _products(rows, q))
        self.right = q @ u[:, np.argsort(-s)[: min(most, k)]]
        self.rows = rows

    def placed(self, w: DataFrame, ident: str) -> DataFrame:
        """(ident, terms array<int>, ws array<double>) with the places of known terms."""
        x = w.join(F.broadcast(self.index), "term").groupBy(ident).agg(F.array_sort(F.collect_list(F.struct("t", "w"))).alias("x"))
        return x.select(ident, F.col("x.t").alias("terms"), F.col("x.w").alias("ws"))

    def vectors(self, placed: DataFrame, dim: int, unit: bool = True) -> DataFrame:
        """(ident, v): rows in dim dimensions, of unit length; null for rows that are zero there."""
        ident = placed.columns[0]
        shared = self.spark.sparkContext.broadcast(self.right[:, :dim])

        def run(batches):
            for b in batches:
                vs = []
                for t, x in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                    v = np.array(x) @ shared.value[np.array(t, int)] if t else np.zeros(dim)
                    n = np.linalg.norm(v)
                    vs.append((v / n if unit else v).tolist() if n > 1e-12 else None)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(vs, pa.list_(pa.float64()))], names=[ident, "v"])

        return placed.mapInArrow(run, f"{ident} bigint, v array<double>")

    def explained(self, dim: int) -> float:
        """Share of the rows' variance that dim dimensions keep."""
        n = self.rows.count()
        z = self.vectors(self.rows, dim, False).where("v is not null").select(F.posexplode("v").alias("d", "x")).groupBy("d").agg(F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("q"))
        kept = z.agg(F.sum(F.col("q") / n - (F.col("s") / n) ** 2)).first()[0] or 0.0
        e = self.rows.select(F.explode(F.arrays_zip("terms", "ws")).alias("e")).groupBy("e.terms").agg(F.sum("e.ws").alias("s"), F.sum(F.col("e.ws") * F.col("e.ws")).alias("q"))
        total = e.agg(F.sum(F.col("q") / n - (F.col("s") / n) ** 2)).first()[0] or 0.0
        return kept / total if total else 0.0


def overlap(w: DataFrame, ident: str, dims: list[int], work: Work, k: int = 10) -> DataFrame:
    """(dim, query_id, overlap): common part of the k nearest by the rows and by their SVD, for ids divisible by 20."""
    rows = work.table(sparse.term_rows(w, ident).withColumnRenamed(ident, "row_id"), "sparse")
    near = work.table(sparse.top_k(rows.where("row_id % 20 = 0").withColumnRenamed("row_id", "query_id"), rows, k).select("query_id", "row_id"), "near")
    svd = Svd(w, ident, max(dims), work)
    out = None
    for d in dims:
        v = work.table(svd.vectors(svd.rows, d).withColumnRenamed(ident, "row_id"), f"v{d}")
        dense = top_k(v.where("row_id % 20 = 0").withColumnRenamed("row_id", "query_id"), v, k).select("query_id", "row_id", F.lit(1).alias("hit"))
        x = near.join(dense, ["query_id", "row_id"], "left").groupBy("query_id").agg((F.count("hit") / F.lit(float(k))).alias("overlap")).select(F.lit(d).alias("dim"), F.lit(round(svd.explained(d), 6)).alias("explained"), "query_id", "overlap")
        out = x if out is None else out.unionByName(x)
    return out


def report(docs: DataFrame, ident: str, text: str, dims: list[int], work: Work) -> DataFrame:
    """(dim, explained, mean, median, least, most, chosen): what each dimension keeps; chosen is the smallest whose mean
    overlap is within TOLERANCE of the best."""
    w = work.table(weights(docs, ident, text), "weights")
    g = overlap(w, ident, dims, work).groupBy("dim", "explained").agg(F.avg("overlap").alias("mean"), F.median("overlap").alias("median"), F.min("overlap").alias("least"), F.max("overlap").alias("most"))
    g = work.table(g, "report")  # a row for each dimension
    best = g.agg((F.max("mean") - TOLERANCE).alias("floor"))
    low = g.join(F.broadcast(best)).where("mean >= floor").agg(F.min("dim").alias("choice"))
    return g.join(F.broadcast(low)).withColumn("chosen", F.col("dim") == F.col("choice")).drop("choice")
