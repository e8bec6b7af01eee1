"""Joins between documents, candidates and resolutions; deduplication; merging of candidates."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.text import base_id, title_key, version
from ..operators.dedup import duplicate_of, first_of, without_repeats
from ..operators.upsert import upsert
from ..sources.tables import candidates, chunk_columns, documents, table
from .registry import query
from .verify import CHUNKS

CAND = "(SELECT DISTINCT ON (candidate_id) * FROM candidates)"
BASE = "regexp_replace({0}, 'v[0-9]+$', '')"


@query(f"SELECT candidate_id, source, source_id FROM {CAND} c WHERE NOT EXISTS (SELECT 1 FROM core_documents d WHERE d.source = c.source AND {BASE.format('d.source_id')} = {BASE.format('c.source_id')})")
def anti_existing(spark, sf):
    d = documents(spark, sf).select("source", base_id(F.col("source_id")).alias("base"))
    c = candidates(spark, sf).select("candidate_id", "source", "source_id", base_id(F.col("source_id")).alias("base"))
    return c.join(d, ["source", "base"], "left_anti").select("candidate_id", "source", "source_id")


@query(f"SELECT candidate_id FROM {CAND} c WHERE EXISTS (SELECT 1 FROM core_documents d WHERE d.content_hash = c.content_hash)")
def semi_existing_hash(spark, sf):
    return candidates(spark, sf).join(documents(spark, sf).select("content_hash"), "content_hash", "left_semi").select("candidate_id")


@query(
    f"""SELECT c.candidate_id, coalesce(min(e.id), min(b.id)) AS document_id, CASE WHEN min(e.id) IS NOT NULL THEN 'exact' ELSE 'base' END AS how
    FROM {CAND} c LEFT JOIN core_documents e ON e.source = c.source AND e.source_id = c.source_id
    LEFT JOIN core_documents b ON b.source = c.source AND {BASE.format('b.source_id')} = {BASE.format('c.source_id')}
    GROUP BY 1 HAVING min(e.id) IS NOT NULL OR min(b.id) IS NOT NULL"""
)
def base_id_fallback(spark, sf):
    """Exact id first; only what is left over is looked up by base id."""
    c = candidates(spark, sf).select("candidate_id", "source", "source_id")
    d = documents(spark, sf).select("id", "source", "source_id")
    exact = c.join(d, ["source", "source_id"]).groupBy("candidate_id").agg(F.min("id").alias("document_id")).withColumn("how", F.lit("exact"))
    rest = c.join(exact.select("candidate_id"), "candidate_id", "left_anti").withColumn("base", base_id(F.col("source_id")))
    based = rest.join(d.withColumn("base", base_id(F.col("source_id"))).select("id", "source", "base"), ["source", "base"]).groupBy("candidate_id").agg(F.min("id").alias("document_id")).withColumn("how", F.lit("base"))
    return exact.unionByName(based)


@query(
    """WITH r AS (SELECT DISTINCT source, source_id, topic_axis, title FROM resolutions)
    SELECT r.source, r.source_id, CASE WHEN d.id IS NULL THEN 'missing' WHEN d.topic_axis IS DISTINCT FROM r.topic_axis THEN 'axis_mismatch' WHEN d.title IS DISTINCT FROM r.title THEN 'title_mismatch' ELSE 'ok' END AS state
    FROM r LEFT JOIN core_documents d ON d.source = r.source AND d.source_id = r.source_id"""
)
def verify_selected(spark, sf):
    r = table(spark, sf, "resolutions").select("source", "source_id", "topic_axis", "title").distinct()
    d = documents(spark, sf).select("id", "source", "source_id", F.col("topic_axis").alias("a"), F.col("title").alias("t"))
    state = F.when(F.col("id").isNull(), "missing").when(~F.col("a").eqNullSafe(F.col("topic_axis")), "axis_mismatch").when(~F.col("t").eqNullSafe(F.col("title")), "title_mismatch").otherwise("ok")
    return r.join(d, ["source", "source_id"], "left").select("source", "source_id", state.alias("state"))


@query(
    f"""SELECT c.id, list_filter([CASE WHEN d.id IS NULL THEN 'missing_document' END, CASE WHEN c.char_count <> length(c.chunk_text) THEN 'char_count' END,
    CASE WHEN c.content_hash <> sha256(c.chunk_text) THEN 'content_hash' END], lambda x: x IS NOT NULL) AS failed
    FROM {CHUNKS} c LEFT JOIN core_documents d ON d.id = c.document_id WHERE d.id IS NULL OR c.char_count <> length(c.chunk_text) OR c.content_hash <> sha256(c.chunk_text)"""
)
def manifest_mismatch(spark, sf):
    c = chunk_columns(spark, sf, "document_id", "char_count", "content_hash", "chunk_text").select("id", "document_id", (F.col("char_count") != F.length("chunk_text")).alias("n"), (F.col("content_hash") != F.sha2("chunk_text", 256)).alias("h"))
    d = documents(spark, sf).select(F.col("id").alias("document_id"), F.lit(True).alias("there"))
    failed = F.array_compact(F.array(F.when(F.col("there").isNull(), "missing_document"), F.when(F.col("n"), "char_count"), F.when(F.col("h"), "content_hash")))
    return c.join(d, "document_id", "left").select("id", failed.alias("failed")).where(F.size("failed") > 0)


@query(
    f"""WITH n AS (SELECT source, source_id, min_by(title, candidate_id) AS title FROM {CAND} WHERE source IS NOT NULL AND source_id IS NOT NULL GROUP BY ALL),
    o AS (SELECT source, source_id, min(id) AS id, min_by(title, id) AS title FROM core_documents GROUP BY ALL),
    m AS (SELECT coalesce(o.source, n.source) AS source, coalesce(o.source_id, n.source_id) AS source_id, o.id, CASE WHEN n.source IS NOT NULL THEN n.title ELSE o.title END AS title,
      CASE WHEN o.id IS NULL THEN 'inserted' WHEN n.source IS NULL THEN 'kept' ELSE 'updated' END AS action FROM o FULL JOIN n ON o.source = n.source AND o.source_id = n.source_id)
    SELECT CASE WHEN action = 'inserted' THEN (SELECT max(id) FROM o) + row_number() OVER (PARTITION BY action ORDER BY source, source_id) ELSE id END AS id, source, source_id, title, action FROM m"""
)
def upsert_result(spark, sf):
    new = candidates(spark, sf).where("source is not null and source_id is not null").groupBy("source", "source_id").agg(F.min_by("title", "candidate_id").alias("title"))
    old = documents(spark, sf).groupBy("source", "source_id").agg(F.min("id").alias("id"), F.min_by("title", "id").alias("title"))
    return upsert(old, new, ["source", "source_id"]).select("id", "source", "source_id", "title", "action")


@query(f"SELECT source, {BASE.format('source_id')} AS base, list_sort(list(DISTINCT topic_axis)) AS axes FROM {CAND} WHERE topic_axis IS NOT NULL GROUP BY ALL HAVING count(DISTINCT topic_axis) > 1")
def axis_overlap(spark, sf):
    c = candidates(spark, sf).where("topic_axis is not null")
    return c.groupBy("source", base_id(F.col("source_id")).alias("base")).agg(F.array_sort(F.collect_set("topic_axis")).alias("axes")).where(F.size("axes") > 1)


@query("SELECT id, min(id) OVER (PARTITION BY content_hash) AS duplicate_of FROM core_documents WHERE content_hash IS NOT NULL QUALIFY id <> min(id) OVER (PARTITION BY content_hash)", "duplicate_of")
def _duplicate_of(spark, sf):
    return duplicate_of(documents(spark, sf).select("id", "content_hash"), "content_hash", "id").where("duplicate_of is not null").select("id", "duplicate_of")


@query("SELECT content_hash, min(id) AS id, min_by(source_id, id) AS source_id FROM core_documents WHERE content_hash IS NOT NULL GROUP BY 1")
def dedup_keep_first(spark, sf):
    d = documents(spark, sf).where("content_hash is not null").select("content_hash", "id", "source_id")
    return first_of(d, ["content_hash"], [F.col("id")])


@query(f"SELECT id, document_id, section_heading FROM (SELECT id, document_id, section_heading, row_number() OVER w AS n, lag(section_heading) OVER w AS before FROM {CHUNKS} WINDOW w AS (PARTITION BY document_id ORDER BY chunk_index, id)) WHERE n = 1 OR before IS DISTINCT FROM section_heading")
def consecutive_dedup(spark, sf):
    c = chunk_columns(spark, sf, "document_id", "chunk_index", "section_heading")
    return without_repeats(c, ["document_id"], ["chunk_index", "id"], "section_heading").select("id", "document_id", "section_heading")


KEY = "trim(regexp_replace(lower({0}), '[^a-z0-9]+', ' ', 'g'), ' ')"


@query(f"SELECT {KEY.format('title')} AS key, count(*) AS n, min(id) AS first_id FROM core_documents WHERE title IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def duplicate_titles(spark, sf):
    return documents(spark, sf).where("title is not null").groupBy(title_key(F.col("title")).alias("key")).agg(F.count("*").alias("n"), F.min("id").alias("first_id")).where("n > 1")


@query(
    """SELECT id, topic_axis, CASE WHEN r <= greatest(1, round_even(n * 0.1, 0)) THEN 'validation' ELSE 'train' END AS part FROM
    (SELECT id, topic_axis, row_number() OVER (PARTITION BY topic_axis ORDER BY md5(id::VARCHAR || ':42'), id) AS r, count(*) OVER (PARTITION BY topic_axis) AS n FROM core_documents)"""
)
def stratified_split(spark, sf):
    """Holdout of a tenth of every axis in a seeded order.

    The threshold of each axis is a rank: the histogram of hash prefixes tells in which prefix it lies, and only the
    rows of that prefix are ranked, so no axis is sorted in one task."""
    d = documents(spark, sf).select("id", "topic_axis", F.md5(F.concat(F.col("id").cast("string"), F.lit(":42")).cast("binary")).alias("h"))
    d = d.withColumn("p", F.substring("h", 1, 3))
    hist = d.groupBy("topic_axis", "p").agg(F.count("*").alias("k"))  # at most 4096 rows an axis
    run = Window.partitionBy("topic_axis").orderBy("p")
    hist = hist.withColumn("till", F.sum("k").over(run)).withColumn("n", F.sum("k").over(Window.partitionBy("topic_axis")))
    hist = hist.withColumn("want", F.greatest(F.lit(1), F.bround(F.col("n") * F.lit(0.1).cast("double"), 0))).withColumn("left", F.col("want") - (F.col("till") - F.col("k")))
    rank = F.row_number().over(Window.partitionBy("topic_axis", "p").orderBy("h", "id"))
    x = d.join(F.broadcast(hist.select(F.col("topic_axis").alias("a"), F.col("p").alias("q"), "left")), F.col("topic_axis").eqNullSafe(F.col("a")) & (F.col("p") == F.col("q")))
    return x.withColumn("r", rank).select("id", "topic_axis", F.when(F.col("r") <= F.col("left"), "validation").otherwise("train").alias("part"))


@query(
    """WITH s AS (SELECT id, content_hash, CASE WHEN substr(md5(id::VARCHAR || ':42'), 1, 1) IN ('0', '1') THEN 'validation' ELSE 'train' END AS part FROM core_documents WHERE content_hash IS NOT NULL)
    SELECT content_hash, count(*) FILTER (WHERE part = 'train') AS train, count(*) FILTER (WHERE part = 'validation') AS validation FROM s GROUP BY 1 HAVING count(DISTINCT part) = 2"""
)
def leakage_check(spark, sf):
    h = F.substring(F.md5(F.concat(F.col("id").cast("string"), F.lit(":42")).cast("binary")), 1, 1)
    s = documents(spark, sf).where("content_hash is not null").select("content_hash", h.isin("0", "1").alias("v"))
    return s.groupBy("content_hash").agg(F.count_if(~F.col("v")).alias("train"), F.count_if("v").alias("validation")).where("train > 0 and validation > 0")


RANKED = f"""WITH c AS (SELECT *, {BASE.format('source_id')} AS base, coalesce(TRY_CAST(nullif(regexp_extract(source_id, 'v([0-9]+)$', 1), '') AS INTEGER), 0) AS ver FROM {CAND} WHERE source_id IS NOT NULL),
    q AS (SELECT source, base, u.key AS query, min(u.value) AS rank FROM (SELECT source, base, unnest(map_entries(query_ranks)) AS u FROM c) GROUP BY ALL),
    m AS (SELECT source, base, list(query ORDER BY query) AS queries, min(rank) AS best_rank FROM q GROUP BY ALL),
    t AS (SELECT source, base, max_by(source_id, (ver, -candidate_id)) AS source_id, max_by(topic_axis, (ver, -candidate_id)) AS topic_axis, max_by(published_at, (ver, -candidate_id)) AS published_at, count(*) AS versions FROM c GROUP BY ALL)"""
MERGED = "SELECT t.source, t.base, t.source_id, t.topic_axis, t.published_at, t.versions, coalesce(m.queries, []) AS queries, coalesce(m.best_rank, 999999) AS best_rank FROM t LEFT JOIN m USING (source, base)"


def merged(spark, sf):
    """Versions of one record merged: the latest stays, queries are united, the best rank of each is kept."""
    c = candidates(spark, sf).where("source_id is not null").withColumn("base", base_id(F.col("source_id"))).withColumn("ver", version(F.col("source_id")))
    q = c.select("source", "base", F.explode("query_ranks").alias("query", "rank")).groupBy("source", "base", "query").agg(F.min("rank").alias("rank"))
    m = q.groupBy("source", "base").agg(F.array_sort(F.collect_list("query")).alias("queries"), F.min("rank").alias("best_rank"))
    latest = F.max_by(F.struct("source_id", "topic_axis", "published_at"), F.struct(F.col("ver"), -F.col("candidate_id")))
    t = c.groupBy("source", "base").agg(latest.alias("l"), F.count("*").alias("versions")).select("source", "base", "l.*", "versions")
    return t.join(m, ["source", "base"], "left").withColumn("queries", F.coalesce("queries", F.array().cast("array<string>"))).withColumn("best_rank", F.coalesce("best_rank", F.lit(999999)))


@query(f"{RANKED} {MERGED}")
def candidate_merge(spark, sf):
    return merged(spark, sf).select("source", "base", "source_id", "topic_axis", "published_at", "versions", "queries", "best_rank")


@query(f"{RANKED}, x AS ({MERGED}) SELECT topic_axis, source, base, row_number() OVER (PARTITION BY topic_axis ORDER BY len(queries) DESC, best_rank, published_at DESC NULLS LAST, source, base) AS place FROM x QUALIFY place <= 90")
def review_pool(spark, sf):
    """The review pool is the feature: the best 90 of each axis (three times the target of 30)."""
    w = Window.partitionBy("topic_axis").orderBy(F.desc(F.size("queries")), "best_rank", F.desc_nulls_last("published_at"), "source", "base")
    return merged(spark, sf).withColumn("place", F.row_number().over(w)).where("place <= 90").select("topic_axis", "source", "base", "place")


@query(f"SELECT q AS query, count(*) AS n FROM (SELECT unnest(matched_queries) AS q FROM {CAND}) GROUP BY 1")
def query_histogram(spark, sf):
    return candidates(spark, sf).select(F.explode("matched_queries").alias("query")).groupBy("query").agg(F.count("*").alias("n"))


@query("SELECT source, selected_format, success, count(*) AS n FROM (SELECT DISTINCT * FROM resolutions) GROUP BY ALL")
def resolution_formats(spark, sf):
    return table(spark, sf, "resolutions").distinct().groupBy("source", "selected_format", "success").agg(F.count("*").alias("n"))


@query("SELECT a.format AS format, a.success AS success, count(*) AS n FROM (SELECT unnest(attempts) AS a FROM (SELECT DISTINCT * FROM resolutions)) GROUP BY ALL")
def attempt_counts(spark, sf):
    return table(spark, sf, "resolutions").distinct().select(F.explode("attempts").alias("a")).groupBy(F.col("a.format").alias("format"), F.col("a.success").alias("success")).agg(F.count("*").alias("n"))


@query("SELECT source, source_id, list_filter(attempts, lambda x: x.success)[1].format AS format FROM (SELECT DISTINCT * FROM resolutions) WHERE list_filter(attempts, lambda x: x.success)[1].format IS DISTINCT FROM selected_format")
def fallback_decision(spark, sf):
    """The first attempt that succeeded decides; rows stored otherwise come out."""
    r = table(spark, sf, "resolutions").distinct()
    first = F.get(F.filter("attempts", lambda x: x["success"]), 0)["format"]
    return r.where(~first.eqNullSafe(F.col("selected_format"))).select("source", "source_id", first.alias("format"))


@query("SELECT source, source_id FROM (SELECT DISTINCT source, source_id FROM core_documents) EXCEPT SELECT source, source_id FROM resolutions WHERE success")
def unresolved(spark, sf):
    """Work left over: documents without a successful resolution."""
    r = table(spark, sf, "resolutions").where("success").select("source", "source_id")
    return documents(spark, sf).select("source", "source_id").distinct().join(r, ["source", "source_id"], "left_anti")


@query("SELECT name, trim(n, ' ') AS value FROM (SELECT unnest(authors) AS n, 'author' AS name FROM core_documents) WHERE n IS NOT NULL GROUP BY ALL HAVING count(*) > 5")
def frequent_authors(spark, sf):
    a = documents(spark, sf).select(F.explode("authors").alias("n")).where("n is not null")
    return a.groupBy(F.col("n")).agg(F.count("*").alias("k")).groupBy(F.trim("n").alias("value")).agg(F.sum("k").alias("k")).where("k > 5").select(F.lit("author").alias("name"), "value")


@query("SELECT o_orderpriority AS priority, count(*) AS orders, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1")
def order_revenue(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("r"))
    return o.join(li, "o_orderkey").groupBy(F.col("o_orderpriority").alias("priority")).agg(F.count("*").alias("orders"), F.round(F.sum("r"), 2).alias("revenue"))
