"""TF-IDF, dense search and ranking metrics."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators.retrieval import dot, evidence, first_relevant, metrics, norm, top_k
from ..operators.retriever import Retriever
from ..operators.sparse import evaluated, term_rows
from ..operators.svd import Svd, overlap, report
from ..operators.tfidf import counts, vocabulary, weights
from ..sources.tables import chunk_columns, documents, table
from ..work import Work
from .registry import query
from .texts import GATE_SQL
from .verify import CHUNKS

FULL = "SELECT vec_id, embedding::DOUBLE[] AS v, label FROM embeddings"


@query(f"SELECT b.vec_id AS row_id, round(list_inner_product(a.v, b.v) / sqrt(list_inner_product(a.v, a.v) * list_inner_product(b.v, b.v)), 6) AS score FROM ({FULL}) a, ({FULL}) b WHERE a.vec_id = (SELECT min(vec_id) FROM embeddings) AND b.vec_id <> a.vec_id ORDER BY score DESC, row_id LIMIT 10")
def cosine_topk(spark, sf):
    """One query: higher-order functions and a top-k without a shuffle of the rows."""
    e = table(spark, sf, "embeddings").select("vec_id", "embedding")
    first = e.agg(F.min_by(F.struct("vec_id", "embedding"), "vec_id").alias("q"))
    x = e.join(F.broadcast(first)).where(F.col("vec_id") != F.col("q.vec_id"))
    s = F.round(dot(F.col("embedding"), F.col("q.embedding")) / (norm(F.col("embedding")) * norm(F.col("q.embedding"))), 6)
    return x.select(F.col("vec_id").alias("row_id"), s.alias("score")).orderBy(F.desc("score"), "row_id").limit(10)


def _found(spark, sf, k):
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("row_id"), F.col("embedding").alias("v"), "label")
    q = e.where("row_id % 20 = 0").select(F.col("row_id").alias("query_id"), "v")
    return e, q, top_k(q, e, k)


PAIRS = f"SELECT a.vec_id AS query_id, b.vec_id AS row_id, a.label AS ql, b.label AS rl, round(list_inner_product(a.v, b.v) / sqrt(list_inner_product(a.v, a.v) * list_inner_product(b.v, b.v)), 6) AS score FROM ({FULL}) a JOIN ({FULL}) b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id"


@query(f"SELECT query_id, row_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, row_id) AS place FROM ({PAIRS}) QUALIFY place <= 10")
def vector_search(spark, sf):
    """Stated query set (ids divisible by 20) against all rows, in blocks."""
    return _found(spark, sf, 10)[2].select("query_id", "row_id", "place")


RANK_SQL = f"""WITH p AS ({PAIRS}), r AS (SELECT query_id, ql, (ql = rl)::INT AS rel, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, row_id) AS rank FROM p),
    m AS (SELECT query_id, ql, sum(CASE WHEN rank <= 6 THEN rel ELSE 0 END) AS hits, max(CASE WHEN rank = 1 THEN rel ELSE 0 END) AS hit1, min(CASE WHEN rel = 1 THEN rank END) AS first,
      sum(CASE WHEN rank <= 6 THEN rel / log2(rank + 1.0::DOUBLE) ELSE 0 END) AS dcg, sum(rel) AS relevant FROM r GROUP BY ALL),
    q AS (SELECT query_id, ql, hits / 6.0::DOUBLE AS precision, CASE WHEN relevant > 0 THEN hits::DOUBLE / relevant ELSE 0 END AS recall, hit1::DOUBLE AS hit1, coalesce(1.0::DOUBLE / first, 0) AS rr,
      CASE WHEN relevant > 0 THEN dcg / list_sum(list_transform(range(1, least(6, relevant)::BIGINT + 1), lambda i: 1.0::DOUBLE / log2(i + 1.0::DOUBLE))) ELSE 0 END AS ndcg FROM m)"""


def _metrics(spark, sf, k=6):
    """Relevance is the label. The first k are searched for; the rank of the first relevant row counts for the
    reciprocal rank and comes from counts, so no query ranks all rows."""
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("row_id"), F.col("embedding").alias("v"), F.col("label").cast("bigint").alias("label"))
    q = e.where("row_id % 20 = 0").select(F.col("row_id").alias("query_id"), "v", "label")
    labels = e.select("row_id", "label")
    own = q.select("query_id", F.col("label").alias("ql"))
    hits = top_k(q, e, k).join(labels, "row_id").join(own, "query_id").select("query_id", F.col("place").alias("rank"), (F.col("label") == F.col("ql")).cast("int").alias("rel"))
    per = labels.groupBy("label").agg((F.count("*") - 1).alias("relevant"))  # as many rows as labels
    totals = own.join(per, F.col("ql") == F.col("label")).select("query_id", "relevant", "ql")
    return metrics(hits, first_relevant(q, e), totals.select("query_id", "relevant"), k).join(totals.select("query_id", F.col("ql").alias("label")), "query_id")


@query(f"{RANK_SQL} SELECT query_id, round(precision, 4) AS precision, round(recall, 4) AS recall, hit1, round(rr, 4) AS rr, round(ndcg, 4) AS ndcg FROM q")
def ranking_metrics(spark, sf):
    return _metrics(spark, sf).select("query_id", *[F.round(c, 4).alias(c) for c in ("precision", "recall")], "hit1", *[F.round(c, 4).alias(c) for c in ("rr", "ndcg")])


@query(f"{RANK_SQL} SELECT ql AS label, count(*) AS queries, round(avg(precision), 4) AS precision, round(avg(recall), 4) AS recall, round(avg(hit1), 4) AS hit1, round(avg(rr), 4) AS mrr, round(avg(ndcg), 4) AS ndcg FROM q GROUP BY 1")
def metrics_by_axis(spark, sf):
    a = lambda c, n=None: F.round(F.avg(c), 4).alias(n or c)
    return _metrics(spark, sf).groupBy("label").agg(F.count("*").alias("queries"), a("precision"), a("recall"), a("hit1"), a("rr", "mrr"), a("ndcg"))


@query(f"{RANK_SQL} SELECT ql AS label, round(avg(ndcg), 4) AS ndcg, round(avg(precision), 4) AS precision, round(avg(rr), 4) AS mrr FROM q GROUP BY 1 ORDER BY ndcg DESC, precision DESC, mrr DESC, label LIMIT 1")
def best_config(spark, sf):
    """Lexicographic choice by nDCG, precision and MRR."""
    g = _metrics(spark, sf).groupBy("label").agg(F.round(F.avg("ndcg"), 4).alias("ndcg"), F.round(F.avg("precision"), 4).alias("precision"), F.round(F.avg("rr"), 4).alias("mrr"))
    return g.orderBy(F.desc("ndcg"), F.desc("precision"), F.desc("mrr"), "label").limit(1)


TOK = "regexp_extract_all(strip_accents(lower(coalesce(title, '') || ' ' || coalesce(abstract, ''))), '[a-z0-9]{2,}')"
TF_SQL = f"""WITH t AS (SELECT id, {TOK} AS w FROM core_documents), g AS (SELECT id, unnest(list_concat(w, list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1]))) AS term FROM t),
    tf AS (SELECT id, term, count(*) AS tf FROM g GROUP BY ALL), n AS (SELECT count(*) AS n FROM core_documents),
    v AS (SELECT term, ln((1.0::DOUBLE + n) / (1.0::DOUBLE + count(*))) + 1.0::DOUBLE AS idf FROM tf, n GROUP BY term, n HAVING count(*) >= 2 AND count(*) <= 0.95::DOUBLE * n ORDER BY sum(tf) DESC, term LIMIT 50000),
    r AS (SELECT id, term, (1.0::DOUBLE + ln(tf)) * idf AS w FROM tf JOIN v USING (term)), x AS (SELECT id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS w FROM r)"""


def _texts(spark, sf):
    t = F.concat(F.coalesce("title", F.lit("")), F.lit(" "), F.coalesce("abstract", F.lit("")))
    return documents(spark, sf).select("id", t.alias("text"))


@query(f"{TF_SQL} SELECT id, term, round(w, 5) AS w FROM x")
def tfidf_weights(spark, sf):
    return weights(_texts(spark, sf), "id", "text").select("id", "term", F.round("w", 5).alias("w"))


@query(f"{TF_SQL} SELECT *, round(entries::DOUBLE / (docs * terms), 8) AS density FROM (SELECT count(DISTINCT id) AS docs, count(DISTINCT term) AS terms, count(*) AS entries FROM x)")
def tfidf_stats(spark, sf):
    return weights(_texts(spark, sf), "id", "text").agg(F.countDistinct("id").alias("docs"), F.countDistinct("term").alias("terms"), F.count("*").alias("entries")).withColumn("density", F.round(F.col("entries") / (F.col("docs") * F.col("terms")), 8))


QUERY_TEXT = "cautious rover planner under dust storms"
QTOK = f"regexp_extract_all('{QUERY_TEXT}', '[a-z0-9]{{2,}}')"


@query(f"{TF_SQL}, q AS (SELECT unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term FROM (SELECT {QTOK} AS w)), qv AS (SELECT term, idf / sqrt(sum(idf * idf) OVER ()) AS w FROM q JOIN v USING (term)) SELECT id, round(sum(x.w * qv.w), 5) AS score FROM x JOIN qv USING (term) GROUP BY id ORDER BY score DESC, id LIMIT 20")
def tfidf_query(spark, sf):
    """A query meets only the rows of its own terms: an equi-join with a handful of broadcast rows."""
    docs = _texts(spark, sf)
    w = weights(docs, "id", "text")
    tf = counts(docs, "id", "text")
    v = vocabulary(tf, "id", docs.count())
    q = counts(spark.createDataFrame([(0, QUERY_TEXT)], "q int, text string"), "q", "text").join(v, "term").select("term", "idf")
    qv = q.select("term", (F.col("idf") / F.sqrt(F.sum(F.col("idf") * F.col("idf")).over(Window.partitionBy(F.lit(1))))).alias("qw"))
    return w.join(F.broadcast(qv), "term").groupBy("id").agg(F.round(F.sum(F.col("w") * F.col("qw")), 5).alias("score")).orderBy(F.desc("score"), "id").limit(20)


EVIDENCE_SQL = f"""b AS (SELECT query_id, document_id, min(score) AS score, min(row_id) AS row_id FROM (SELECT *, row_number() OVER (PARTITION BY query_id, document_id ORDER BY score DESC, row_id) AS one FROM found
      JOIN (SELECT id AS row_id, document_id FROM {CHUNKS}) USING (row_id) JOIN (SELECT id AS row_id FROM ({GATE_SQL}) WHERE len(reasons) = 0 AND score >= 0.7) USING (row_id)) WHERE one = 1 GROUP BY ALL),
    e AS (SELECT query_id, row_id, document_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, row_id) AS rank FROM b QUALIFY rank <= 6) SELECT *, count(*) OVER (PARTITION BY query_id) = 6 AS complete FROM e"""
_VALID = "SELECT DISTINCT ON (id) id, document_id, embedding::DOUBLE[] AS v FROM core_chunks WHERE len(embedding) = 256 AND len(list_filter(embedding, lambda y: NOT isfinite(y))) = 0 AND len(list_filter(embedding, lambda y: y <> 0)) > 0"


@query(
    f"""WITH c AS ({_VALID}), found AS (SELECT a.id AS query_id, b.id AS row_id, round(list_inner_product(a.v, b.v) / sqrt(list_inner_product(a.v, a.v) * list_inner_product(b.v, b.v)), 6) AS score FROM c a JOIN c b ON a.id % 20 = 0 AND a.id <> b.id
    QUALIFY row_number() OVER (PARTITION BY a.id ORDER BY score DESC, b.id) <= 200), {EVIDENCE_SQL}"""
)
def diverse_evidence(spark, sf):
    """Top 200 by cosine, then the gate, then one passage a document, 6 of each query (chunk ids divisible by 20)."""
    c = table(spark, sf, "core_chunks").select("id", "embedding").dropDuplicates(["id"])
    rows = c.where(F.size("embedding") == 256).select(F.col("id").alias("row_id"), F.col("embedding").alias("v"))
    q = rows.where("row_id % 20 = 0").select(F.col("row_id").alias("query_id"), "v")
    return evidence(top_k(q, rows, 200), chunk_columns(spark, sf, "document_id", "chunk_text"), 6)


@query()
def svd_neighbours(spark, sf):
    """Ten nearest by TF-IDF and by its truncated SVD for a stated set of documents: the overlap of both."""
    work = Work(spark, "svd")
    w = work.table(weights(_texts(spark, sf), "id", "text", pairs=False), "weights")
    return overlap(w, "id", [64], work).select("query_id", "overlap")


@query()
def svd_report(spark, sf):
    """What dimensions of the SVD keep of variance and neighbours, and the one chosen for now."""
    return report(_texts(spark, sf), "id", "text", [16, 32, 64], Work(spark, "svd"))


@query()
def model_choice(spark, sf):
    """Models of 16, 32 and 64 dimensions asked with titles (ids divisible by 20) for documents of the same axis; chosen is the
    best by nDCG, precision and MRR, then the smaller."""
    work = Work(spark, "models")
    docs = _texts(spark, sf)
    vocab = work.table(vocabulary(counts(docs, "id", "text"), "id", docs.count()), "vocabulary")
    label = documents(spark, sf).select("id", F.xxhash64("topic_axis").alias("label"))
    svd = Svd(work.table(weights(docs, "id", "text", vocab=vocab), "weights"), "id", 64, work)
    titles = documents(spark, sf).where("id % 20 = 0").select("id", "title")
    asked = work.table(svd.placed(weights(titles, "id", "title", vocab=vocab), "id"), "asked")
    totals = label.groupBy("label").agg((F.count("*") - 1).alias("relevant"))
    rows = []
    for d in (16, 32, 64):
        r = work.table(svd.vectors(svd.rows, d).join(label, "id").select(F.col("id").alias("row_id"), "v", "label"), f"rows{d}")
        q = work.table(svd.vectors(asked, d).where("v is not null").join(label, "id").select(F.col("id").alias("query_id"), "v", "label"), f"asked{d}")
        own = q.select("query_id", F.col("label").alias("ql"))
        hits = top_k(q, r, 6).join(r.select("row_id", "label"), "row_id").join(own, "query_id").select("query_id", F.col("place").alias("rank"), (F.col("label") == F.col("ql")).cast("int").alias("rel"))
        m = metrics(hits, first_relevant(q, r), own.join(totals, own.ql == totals.label).select("query_id", "relevant"), 6)
        rows.append((d, *m.agg(*[F.coalesce(F.round(F.avg(c), 6), F.lit(0.0)) for c in ("ndcg", "precision", "rr")]).first()))
    best = max(rows, key=lambda x: (*x[1:], -x[0]))[0]
    return spark.createDataFrame([(*x, x[0] == best) for x in rows], "dim int, ndcg double, precision double, mrr double, chosen boolean")


CHUNK_TF = """WITH c AS (SELECT DISTINCT ON (id) id, document_id, chunk_text, retrieval_text FROM core_chunks), n AS (SELECT count(*) AS n FROM c),
    t AS (SELECT id, regexp_extract_all(strip_accents(lower(retrieval_text)), '[a-z0-9]{2,}') AS w FROM c), g AS (SELECT id, unnest(list_concat(w, list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1]))) AS term FROM t),
    tf AS (SELECT id, term, count(*) AS tf FROM g GROUP BY ALL),
    v AS (SELECT term, ln((1.0::DOUBLE + n) / (1.0::DOUBLE + count(*))) + 1.0::DOUBLE AS idf FROM tf, n GROUP BY term, n HAVING count(*) >= 2 AND count(*) <= 0.95::DOUBLE * n ORDER BY sum(tf) DESC, term LIMIT 50000),
    r AS (SELECT id, term, (1.0::DOUBLE + ln(tf)) * idf AS w FROM tf JOIN v USING (term)), x AS (SELECT id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS w FROM r)"""
TITLE, IDEA = "Cautious planning for a rover under dust storms", "onboard fault recovery without ground contact"


def _asked(source: str) -> str:
    """Normalised weights (query_id, term, w) of texts (query_id, text)."""
    return f"""qt AS (SELECT query_id, regexp_extract_all(strip_accents(lower(text)), '[a-z0-9]{{2,}}') AS w FROM ({source})), qg AS (SELECT query_id, unnest(list_concat(w, list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1]))) AS term FROM qt),
    qr AS (SELECT query_id, term, (1.0::DOUBLE + ln(count(*))) * any_value(idf) AS w FROM qg JOIN v USING (term) GROUP BY ALL), q AS (SELECT query_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY query_id)) AS w FROM qr)"""


@query(
    f"""{CHUNK_TF}, {_asked(f"SELECT 0 AS query_id, '{TITLE}' || chr(10) || '{IDEA}' AS text")}, found AS (SELECT query_id, x.id AS row_id, round(sum(x.w * q.w), 6) AS score FROM x JOIN q USING (term) GROUP BY ALL HAVING score > 0 ORDER BY score DESC, row_id LIMIT 200), {EVIDENCE_SQL}"""
)
def retrieve(spark, sf):
    """The public call for one title and idea: candidates, gate, one passage a document."""
    work = Work(spark, "retriever")
    return Retriever(spark, work.path("kept")).fit(_chunks(spark, sf)).retrieve(f'"{TITLE}"', IDEA)


def _chunks(spark, sf):
    return chunk_columns(spark, sf, "document_id", "chunk_text", "retrieval_text")


@query(
    f"""{CHUNK_TF}, {_asked("SELECT id AS query_id, title AS text FROM core_documents WHERE id % 20 = 0")}, d AS (SELECT id AS document_id, topic_axis FROM core_documents WHERE id IN (SELECT document_id FROM c)),
    s AS (SELECT query_id, x.id, round(sum(x.w * q.w), 6) AS score FROM x JOIN q USING (term) GROUP BY ALL), sd AS (SELECT query_id, document_id, max(score) AS score FROM s JOIN c USING (id) GROUP BY ALL),
    a AS (SELECT qs.query_id, d.document_id, coalesce(sd.score, 0) AS score, (d.topic_axis IS NOT DISTINCT FROM o.topic_axis)::INT AS rel FROM (SELECT DISTINCT query_id FROM q) qs JOIN core_documents o ON o.id = qs.query_id JOIN d ON d.document_id <> qs.query_id LEFT JOIN sd ON sd.query_id = qs.query_id AND sd.document_id = d.document_id),
    k AS (SELECT query_id, rel, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, document_id) AS rank FROM a),
    m AS (SELECT query_id, sum(CASE WHEN rank <= 6 THEN rel ELSE 0 END) AS hits, max(CASE WHEN rank = 1 THEN rel ELSE 0 END)::DOUBLE AS hit1, min(CASE WHEN rel = 1 THEN rank END) AS first, sum(CASE WHEN rank <= 6 THEN rel / log2(rank + 1.0::DOUBLE) ELSE 0 END) AS dcg, sum(rel) AS relevant FROM k GROUP BY 1)
    SELECT query_id, round(hits / 6.0::DOUBLE, 4) AS precision, round(CASE WHEN relevant > 0 THEN hits::DOUBLE / relevant ELSE 0 END, 4) AS recall, hit1, round(coalesce(1.0::DOUBLE / first, 0), 4) AS rr,
    round(CASE WHEN relevant > 0 THEN dcg / list_sum(list_transform(range(1, least(6, relevant)::BIGINT + 1), lambda i: 1.0::DOUBLE / log2(i + 1.0::DOUBLE))) ELSE 0 END, 4) AS ndcg FROM m"""
)
def title_evaluation(spark, sf):
    """Titles of the documents with ids divisible by 20 ask for documents of their axis, told by their best chunk."""
    return _evaluated(spark, sf).select("query_id", *[F.round(c, 4).alias(c) for c in ("precision", "recall")], "hit1", *[F.round(c, 4).alias(c) for c in ("rr", "ndcg")])


def _evaluated(spark, sf):
    work = Work(spark, "evaluation")
    c = _chunks(spark, sf)
    vocab = work.table(vocabulary(counts(c, "id", "retrieval_text"), "id", c.count()), "vocabulary")
    rows = term_rows(weights(c, "id", "retrieval_text", vocab=vocab), "id").join(c.select("id", "document_id"), "id", "right")
    rows = work.table(rows.select(F.col("id").alias("row_id"), "document_id", "terms", "ws"), "rows")
    d = documents(spark, sf).select(F.col("id").alias("document_id"), F.col("topic_axis").alias("label"))
    titles = documents(spark, sf).where("id % 20 = 0").select(F.col("id").alias("query_id"), "title")
    q = term_rows(weights(titles, "query_id", "title", vocab=vocab), "query_id").join(d.withColumnRenamed("document_id", "query_id"), "query_id")
    return evaluated(work.table(q.select("query_id", "label", "terms", "ws"), "queries"), rows, d, 6)
