"""Exact cosine search, the quality gate after it, one passage a document, and ranking metrics."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.quality import gated

QUERY_BLOCK, ROW_BLOCK = 4096, 16384  # queries and rows of one block


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def blocks(queries: DataFrame, rows: DataFrame, fn, schema: str) -> DataFrame:
    """fn(query table, row table) -> arrow table, for every pair of a query block and a row block.

    Up to QUERY_BLOCK queries go to all rows as one broadcast block, without a shuffle. More are joined block by block: each
    task holds one block of either side, whatever the number of queries, and nothing passes through the driver."""
    spark = rows.sparkSession
    head = queries.limit(QUERY_BLOCK + 1).toArrow()
    if head.num_rows <= QUERY_BLOCK:
        shared = spark.sparkContext.broadcast(head)

        def run(batches):
            for b in batches:
                for lo in range(0, b.num_rows, QUERY_BLOCK):
                    yield from fn(shared.value, pa.Table.from_batches([b.slice(lo, QUERY_BLOCK)])).to_batches()

        return rows.mapInArrow(run, schema)
    nq, nr = (max(1, -(-df.count() // size)) for df, size in ((queries, QUERY_BLOCK), (rows, ROW_BLOCK)))
    part = lambda df, n: F.pmod(F.xxhash64(df.columns[0]), F.lit(n)).cast("int")
    names = queries.columns  # the sides may come from one table: other names keep their columns apart
    queries = queries.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(names)])
    q = queries.withColumn("_q", part(queries, nq)).withColumn("_r", F.explode(F.sequence(F.lit(0), F.lit(nr - 1))))
    r = rows.withColumn("_r", part(rows, nr)).withColumn("_q", F.explode(F.sequence(F.lit(0), F.lit(nq - 1))))

    types = {"bigint": pa.int64(), "double": pa.float64()}
    none = pa.table({n: pa.array([], types[t]) for n, t in (f.split() for f in schema.split(", "))})

    def pair(left, right):
        return fn(left.drop(["_q", "_r"]).rename_columns(names), right.drop(["_q", "_r"])) if left.num_rows and right.num_rows else none

    return q.groupBy("_q", "_r").cogroup(r.groupBy("_q", "_r")).applyInArrow(pair, schema)


def _unit(col, width: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of a list column and the mask of its valid rows: not null, finite, not zero, of the given width."""
    vs = col.to_pylist()
    width = width or max((len(v) for v in vs if v), default=0)
    ok = np.array([v is not None and len(v) == width > 0 and None not in v for v in vs], bool)
    x = np.array([v for v, o in zip(vs, ok) if o], dtype=np.float64).reshape(int(ok.sum()), width)
    n = np.linalg.norm(x, axis=1)
    fine = np.isfinite(n) & (n > 0)
    ok[np.flatnonzero(ok)[~fine]] = False
    return x[fine] / n[fine, None], ok


def _scores(q, r, exclude_self: bool):
    """Ids and rounded cosines of the valid rows of two tables (id, v, ...); -2 on the diagonal."""
    m, okq = _unit(q.column(1))
    x, okr = _unit(r.column(1), m.shape[1] or None)
    qid, rid = q.column(0).to_numpy()[okq], r.column(0).to_numpy()[okr]
    s = np.round(m @ x.T, 6) if len(qid) and len(rid) else np.zeros((len(qid), len(rid)))
    if exclude_self:
        s[qid[:, None] == rid[None, :]] = -2
    return qid, rid, s, okq, okr


def top_k(queries: DataFrame, rows: DataFrame, k: int, qid: str = "query_id", rid: str = "row_id", vector: str = "v", exclude_self: bool = True) -> DataFrame:
    """(qid, rid, score, place): the k rows of largest cosine for each query, ties by row id; scores to 6 digits.

    Each pair of blocks keeps only the best k of a query, and a window merges them. Null vectors, zero vectors and
    vectors of another length match nothing."""

    def run(q, r):
        qids, rids, s, _, _ = _scores(q, r, exclude_self)
        if not s.size:
            return pa.table({qid: pa.array([], pa.int64()), rid: pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        n = min(k, s.shape[1])
        if n < s.shape[1]:  # all that tie with the k-th stay in, then the order by id decides
            least = -np.partition(-s, n - 1, axis=1)[:, n - 1 : n]
            i, j = np.nonzero(s >= least)
        else:
            i, j = (x.ravel() for x in np.indices(s.shape))
        o = np.lexsort((rids[j], -s[i, j], i))
        i, j = i[o], j[o]
        place = np.arange(len(i)) - np.searchsorted(i, i)
        keep = (place < n) & (s[i, j] > -2)
        i, j = i[keep], j[keep]
        return pa.table({qid: qids[i], rid: rids[j], "score": s[i, j]})

    out = blocks(queries.select(qid, vector), rows.select(rid, vector), run, f"{qid} bigint, {rid} bigint, score double")
    w = Window.partitionBy(qid).orderBy(F.desc("score"), rid)
    return out.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)


def first_relevant(queries: DataFrame, rows: DataFrame, qid: str = "query_id", rid: str = "row_id") -> DataFrame:
    """queries (qid, v, label), rows (rid, v, label) -> (qid, first): the rank of the best row of the query's label in the
    whole ranking, without ranking all rows: the best such row is found first, then the rows before it are counted."""

    def best(q, r):
        qids, rids, s, okq, okr = _scores(q, r, True)
        rel = q.column(2).to_numpy(zero_copy_only=False)[okq][:, None] == r.column(2).to_numpy(zero_copy_only=False)[okr][None, :]
        s = np.where(rel & (s > -2), s, -3)
        if not s.size:
            return pa.table({qid: pa.array([], pa.int64()), "score": pa.array([], pa.float64()), "id": pa.array([], pa.int64())})
        top = s.max(axis=1)
        least = np.where(s == top[:, None], rids[None, :], np.iinfo(np.int64).max).min(axis=1)
        ok = top > -3
        return pa.table({qid: qids[ok], "score": top[ok], "id": least[ok]})

    def before(q, r):
        qids, rids, s, okq, _ = _scores(q, r, True)
        score, ident = (q.column(k).to_numpy(zero_copy_only=False)[okq] for k in (2, 3))
        n = ((s > score[:, None]) | (s == score[:, None]) & (rids[None, :] < ident[:, None])).sum(axis=1) if s.size else np.zeros(len(qids), int)
        return pa.table({qid: qids, "n": n.astype(np.int64)})

    found = blocks(queries.select(qid, "v", "label"), rows.select(rid, "v", "label"), best, f"{qid} bigint, score double, id bigint")
    top = found.groupBy(qid).agg(F.min_by(F.struct("score", "id"), F.struct(-F.col("score"), "id")).alias("b")).select(qid, "b.*")
    asked = queries.select(qid, "v").join(top, qid).select(qid, "v", "score", "id")
    return blocks(asked, rows.select(rid, "v"), before, f"{qid} bigint, n bigint").groupBy(qid).agg((F.sum("n") + 1).alias("first"))


def evidence(found: DataFrame, chunks: DataFrame, k: int, qid: str = "query_id", rid: str = "row_id") -> DataFrame:
    """The gate on the candidates of a search, then the best passage of each document, then the first k.

    Each chunk passes the gate once, not once for each query that found it. The gate comes after the candidates' limit,
    so it can leave fewer than k; complete says whether it did not."""
    fine = gated(chunks.select(F.col("id").alias(rid), "document_id", "chunk_text"), "chunk_text").where("accepted").select(rid, "document_id")
    x = found.select(qid, rid, "score").join(fine, rid)
    # the best passage of each document is an aggregate, so hot documents cost one row a task
    best = x.groupBy(qid, "document_id").agg(F.min_by(F.struct("score", rid), F.struct(-F.col("score"), rid)).alias("b")).select(qid, "document_id", "b.*")
    order = Window.partitionBy(qid).orderBy(F.desc("score"), rid)
    out = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return out.withColumn("complete", F.count("*").over(Window.partitionBy(qid)) == k).select(qid, rid, "document_id", "score", "rank", "complete")


def metrics(hits: DataFrame, first: DataFrame, totals: DataFrame, k: int, qid: str = "query_id") -> DataFrame:
    """hits (qid, rank, rel) of the first k, first (qid, first) and totals (qid, relevant) -> the metrics of each query."""
    r = F.col("rel").cast("double")
    g = hits.groupBy(qid).agg(F.sum(r).alias("hits"), F.max(F.when(F.col("rank") == 1, r).otherwise(0.0)).alias("hit1"), F.sum(r / F.log2(F.col("rank") + 1.0)).alias("dcg"))
    ideal = F.aggregate(F.sequence(F.lit(1), F.lit(k)), F.lit(0.0), lambda s, i: s + F.when(i <= F.col("relevant"), 1.0 / F.log2(i + 1.0)).otherwise(0.0))
    return g.join(totals, qid).join(first, qid, "left").select(
        qid,
        (F.col("hits") / k).alias("precision"),
        F.when(F.col("relevant") > 0, F.col("hits") / F.col("relevant")).otherwise(0.0).alias("recall"),
        F.col("hit1"),
        F.coalesce(1.0 / F.col("first"), F.lit(0.0)).alias("rr"),
        F.when(F.col("relevant") > 0, F.col("dcg") / ideal).otherwise(0.0).alias("ndcg"),
    )
