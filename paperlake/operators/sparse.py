"""Sparse rows (ident, terms, ws) of unit length: search and evaluation block by block, and documents told by their best chunk.

Scores are sums over common terms, so a term that nearly all rows have costs what its entries cost in each pair of
blocks, and no key is joined in one task. Rows without terms score 0 with everything."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .retrieval import blocks

PART = 512  # rows scored at once


def term_rows(w: DataFrame, ident: str) -> DataFrame:
    """(ident, term, w) -> (ident, terms array<bigint>, ws array<double>): terms by their hash, in order."""
    g = w.groupBy(ident).agg(F.array_sort(F.collect_list(F.struct(F.xxhash64("term").alias("t"), "w"))).alias("x"))
    return g.select(ident, F.col("x.t").alias("terms"), F.col("x.w").alias("ws"))


def _flat(terms, ws) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    terms, ws = (c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in (terms, ws))
    if terms.null_count:
        terms, ws = (pa.array([x or [] for x in c.to_pylist()], c.type) for c in (terms, ws))
    n = terms.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    return np.repeat(np.arange(len(n)), n), terms.flatten().to_numpy(zero_copy_only=False), ws.flatten().to_numpy(zero_copy_only=False)


def scored(q: pa.Table, r: pa.Table, at: int):
    """(first row, scores to 6 digits) of the query table with parts of the row table; terms and ws are columns at, at + 1."""
    qi, qt, qw = _flat(q.column(at), q.column(at + 1))
    o = np.argsort(qt, kind="stable")
    qi, qt, qw = qi[o], qt[o], qw[o]
    for lo in range(0, r.num_rows, PART):
        part = r.slice(lo, PART)
        ri, rt, rw = _flat(part.column(at), part.column(at + 1))
        a, b = np.searchsorted(qt, rt, "left"), np.searchsorted(qt, rt, "right")
        n = b - a
        k = np.repeat(np.arange(len(rt)), n)
        j = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(a, n)
        s = np.bincount(qi[j] * part.num_rows + ri[k], qw[j] * rw[k], q.num_rows * part.num_rows) if len(j) else np.zeros(q.num_rows * part.num_rows)
        yield lo, np.round(s.reshape(q.num_rows, part.num_rows), 6)


def _best(qids, rids, s, k):
    """Rows (query, row, score) of the k best columns of each row of s, ties by row id; -2 is left out."""
    n = min(k, s.shape[1])
    least = -np.partition(-s, n - 1, axis=1)[:, n - 1 : n] if n < s.shape[1] else np.full((len(s), 1), -9.0)
    i, j = np.nonzero(s >= least)
    o = np.lexsort((rids[j], -s[i, j], i))
    i, j = i[o], j[o]
    keep = (np.arange(len(i)) - np.searchsorted(i, i) < n) & (s[i, j] > -2)
    return qids[i[keep]], rids[j[keep]], s[i[keep], j[keep]]


def top_k(queries: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """queries (query_id, terms, ws), rows (row_id, terms, ws) -> (query_id, row_id, score, place); a row isn't its own."""

    def run(q, r):
        qids, rids = q.column(0).to_numpy(), r.column(0).to_numpy()
        out = [[], [], []]
        for lo, s in scored(q, r, 1):
            ids = rids[lo : lo + s.shape[1]]
            s[qids[:, None] == ids[None, :]] = -2
            for c, x in zip(out, _best(qids, ids, s, k)):
                c.append(x)
        cols = [np.concatenate(c) if c else np.zeros(0) for c in out]
        return pa.table({"query_id": cols[0].astype(np.int64), "row_id": cols[1].astype(np.int64), "score": cols[2].astype(np.float64)})

    out = blocks(queries.select("query_id", "terms", "ws"), rows.select("row_id", "terms", "ws"), run, "query_id bigint, row_id bigint, score double")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "row_id")
    return out.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)


def _documents(q, r, at: int):
    """Query ids, document ids, and scores of the documents by their best row in this pair of blocks; a document isn't its
    own. The row table has (row_id, document_id, ...)."""
    qids, docs = q.column(0).to_numpy(), r.column(1).to_numpy()
    ids, place = np.unique(docs, return_inverse=True)
    best = np.full((len(qids), len(ids)), -2.0)
    for lo, s in scored(q, r, at):
        p = place[lo : lo + s.shape[1]]
        o = np.argsort(p, kind="stable")
        start = np.flatnonzero(np.concatenate([[True], p[o][1:] != p[o][:-1]])) if len(o) else np.zeros(0, int)
        if len(start):
            d = p[o][start]
            best[:, d] = np.maximum(best[:, d], np.maximum.reduceat(s[:, o], start, axis=1))
    best[qids[:, None] == ids[None, :]] = -2
    return qids, ids, best


def evaluated(queries: DataFrame, rows: DataFrame, labels: DataFrame, k: int) -> DataFrame:
    """queries (query_id, label, terms, ws), rows (row_id, document_id, terms, ws), labels (document_id, label) ->
    (query_id, precision, recall, hit1, rr, ndcg).

    A query is a document's title, a document's score that of its best chunk, relevant is what has the same label. The first k
    are searched for; the rank of the first relevant document comes from counts of the documents before it."""
    from .retrieval import metrics

    kept = rows.join(labels, "document_id").select("row_id", "document_id", "label", "terms", "ws")

    def first_k(q, r):
        x = _best(*_documents(q, r, 3), k)
        return pa.table({"query_id": x[0], "document_id": x[1], "score": x[2]})

    q = queries.select("query_id", F.lit(0).alias("_a"), F.lit(0).alias("_b"), "terms", "ws")
    best = blocks(q, kept, first_k, "query_id bigint, document_id bigint, score double").groupBy("query_id", "document_id").agg(F.max("score").alias("score"))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "document_id")
    hits = best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    own = queries.select("query_id", F.col("label").alias("ql"))
    hits = hits.join(labels, "document_id").join(own, "query_id").select("query_id", "rank", (F.col("label").eqNullSafe(F.col("ql"))).cast("int").alias("rel"))

    def relevant(q, r):
        qids, ids, s = _documents(q, r, 3)
        label = dict(zip(r.column(1).to_pylist(), r.column(2).to_pylist()))
        mine = np.array([label[d] for d in ids.tolist()], object)
        s = np.where(np.array(q.column(1).to_pylist(), object)[:, None] == mine[None, :], s, -2) if len(ids) else s
        x = _best(qids, ids, s, 1)
        return pa.table({"query_id": x[0], "score": x[2], "document_id": x[1]})

    asked = queries.select("query_id", "label", F.lit(0).alias("_b"), "terms", "ws")
    top = blocks(asked, kept, relevant, "query_id bigint, score double, document_id bigint").groupBy("query_id").agg(F.min_by(F.struct("score", "document_id"), F.struct(-F.col("score"), "document_id")).alias("t")).select("query_id", "t.*")

    def before(q, r):
        qids, ids, s = _documents(q, r, 3)
        score, doc = (q.column(c).to_numpy(zero_copy_only=False) for c in (1, 2))
        i, j = np.nonzero((s > score[:, None]) | (s == score[:, None]) & (ids[None, :] < doc[:, None]))
        return pa.table({"query_id": qids[i], "document_id": ids[j]})

    told = queries.join(top, "query_id").select("query_id", "score", "document_id", "terms", "ws")
    n = blocks(told, kept, before, "query_id bigint, document_id bigint").groupBy("query_id").agg(F.countDistinct("document_id").alias("n"))
    first = top.select("query_id").join(n, "query_id", "left").select("query_id", (F.coalesce("n", F.lit(0)) + 1).alias("first"))
    per = labels.join(rows.select("document_id").distinct(), "document_id", "left_semi").groupBy("label").agg(F.count("*").alias("c"))
    in_rows = rows.select(F.col("document_id").alias("query_id")).distinct().withColumn("_in", F.lit(1))
    totals = own.join(in_rows, "query_id", "left").join(per, own.ql.eqNullSafe(per.label), "left").select("query_id", (F.coalesce("c", F.lit(0)) - F.coalesce("_in", F.lit(0))).alias("relevant"))
    return metrics(hits, first, totals, k)

