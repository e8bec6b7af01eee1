"""Collection plans: records of search interfaces, merging and ranking of candidates, checks of schemas and manifests."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..sources.cache import query_key
from ..sources.records import entries, reports
from ..sources.tables import candidates, chunk_columns, documents, table
from .joins import CAND
from .registry import query
from .verify import CHUNKS

SITE = "https://reports.example"
SQUEEZE = r"trim(regexp_replace({0}, '[\s\x{{000B}}\x{{00A0}}\x{{1680}}\x{{2000}}-\x{{200A}}\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{3000}}]+', ' ', 'g'), ' ')"


def _lines(name: str) -> str:
    return SQUEEZE.format(name)


@query(
    f"""SELECT candidate_id, source_id, {_lines('title')} AS title, array_to_string(list_distinct(list_filter(list_transform(coalesce(authors, []), lambda a: {_lines('a')}), lambda a: length(a) > 0)).list_sort(), '|') AS authors,
    strftime(published_at, '%Y-%m-%d') AS published_at, CASE WHEN candidate_id % 2 = 0 THEN url ELSE '{SITE}/files/' || candidate_id END AS pdf_url FROM {CAND} WHERE source_id IS NOT NULL AND length(source_id) > 0"""
)
def report_records(spark, sf):
    """Candidates as records of a report interface, read back: names in place, links made absolute, dates found."""
    c = candidates(spark, sf).where(F.length("source_id") > 0)
    link = F.when(F.col("candidate_id") % 2 == 0, F.col("url")).otherwise(F.concat(F.lit("/files/"), "candidate_id"))
    record = F.struct(
        F.col("source_id").alias("id"), "title", "abstract", F.date_format("published_at", "yyyy-MM-dd'T'00:00:00").alias("distributionDate"),
        F.transform("authors", lambda a: F.struct(F.struct(F.struct(a.alias("name")).alias("author")).alias("meta"))).alias("authorAffiliations"),
        F.array(F.struct(F.struct(link.alias("pdf")).alias("links"))).alias("downloads"),
    )
    x = reports(c.select("candidate_id", F.to_json(record).alias("json")), "json", SITE)
    return x.select("candidate_id", "source_id", "title", F.array_join(F.array_sort("authors"), "|").alias("authors"), "published_at", "pdf_url")


@query(
    f"""SELECT candidate_id, source_id, regexp_replace(source_id, 'v[0-9]+$', '') AS source_base_id, {_lines('title')} AS title, len(list_filter(coalesce(authors, []), lambda a: length({_lines('a')}) > 0)) AS authors,
    strftime(published_at, '%Y-%m-%d') AS published_at, '{SITE}/pdf/' || source_id AS pdf_url FROM {CAND} WHERE regexp_full_match(source_id, '[0-9]{{4}}\\.[0-9]{{4,5}}(v[0-9]+)?') AND title IS NOT NULL"""
)
def atom_entries(spark, sf):
    """Candidates as Atom entries, read back."""
    c = candidates(spark, sf).where(F.col("source_id").rlike(r"^[0-9]{4}\.[0-9]{4,5}(v[0-9]+)?$") & F.col("title").isNotNull())
    safe = lambda s: F.replace(F.replace(F.replace(s, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    tag = lambda t, s: F.when(s.isNotNull(), F.concat(F.lit(f"<{t}>"), safe(s), F.lit(f"</{t}>"))).otherwise("")
    names = F.array_join(F.transform(F.coalesce("authors", F.array().cast("array<string>")), lambda a: F.concat(F.lit("<author>"), tag("name", a), F.lit("</author>"))), "")
    link = F.concat(F.lit(f'<link href="{SITE}/abs/'), "source_id", F.lit(f'" rel="alternate"/><link href="{SITE}/pdf/'), "source_id", F.lit('" type="application/pdf" title="pdf"/>'))
    xml = F.concat(F.lit("<entry>"), tag("id", F.concat(F.lit(f"{SITE}/abs/"), "source_id")), tag("title", F.col("title")), tag("published", F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss")), names, link, F.lit("</entry>"))
    x = entries(c.select("candidate_id", xml.alias("xml")), "xml", SITE)
    return x.select("candidate_id", "source_id", "source_base_id", "title", F.size("authors").alias("authors"), "published_at", "pdf_url")


@query(f"SELECT DISTINCT q AS query, substr(sha256(q), 1, 12) AS key FROM (SELECT unnest(matched_queries) AS q FROM {CAND}) WHERE q IS NOT NULL")
def query_cache_keys(spark, sf):
    return candidates(spark, sf).select(F.explode("matched_queries").alias("query")).where("query is not null").distinct().select("query", query_key(F.col("query")).alias("key"))


#: What tells a reviewer that a text belongs to an axis.
KEYWORDS = {
    "rover_autonomy": ["rover", "planetary", "lunar", "mars", "navigation", "path planning", "localization", "traversability", "terrain", "hazard avoidance", "obstacle avoidance", "mobility", "autonomy", "autonomous science"],
    "onboard_ai": ["spacecraft", "deep space", "onboard", "on-board", "autonomy", "autonomous", "artificial intelligence", "machine learning", "decision", "planning", "navigation", "guidance", "mission autonomy"],
    "satellite_autonomy": ["spacecraft", "satellite", "fault", "anomaly", "diagnosis", "detection", "isolation", "recovery", "fdir", "health management", "fault management", "monitoring", "autonomous operations", "autonomy"],
}
_CASE = " ".join(f"WHEN '{a}' THEN [{', '.join(repr(k) for k in ks)}]" for a, ks in KEYWORDS.items())
HITS_SQL = f"list_sort(list_filter(CASE topic_axis {_CASE} ELSE []::VARCHAR[] END, lambda k: contains(lower(coalesce(title, '') || ' ' || coalesce(abstract, '')), k)))"


def hits(axis="topic_axis", text=None):
    """Keywords of the axis that stand in title or abstract."""
    t = text if text is not None else F.lower(F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("abstract", F.lit(""))))
    words = F.coalesce(*[F.when(F.col(axis) == a, F.array(*map(F.lit, ks))) for a, ks in KEYWORDS.items()], F.array().cast("array<string>"))
    return F.array_sort(F.filter(words, lambda k: F.contains(t, k)))


@query(f"SELECT candidate_id, array_to_string({HITS_SQL}, ',') AS hits FROM {CAND}")
def keyword_hits(spark, sf):
    return candidates(spark, sf).select("candidate_id", F.array_join(hits(), ",").alias("hits"))


SCORED_SQL = f"""WITH c AS (SELECT *, trim(source_id, ' ') AS sid FROM {CAND} WHERE length(trim(source_id, ' ')) > 0),
    s AS (SELECT sid, u.key AS query, max(1000.0::DOUBLE - u.value) AS score FROM (SELECT sid, unnest(map_entries(query_ranks)) AS u FROM c) GROUP BY ALL),
    m AS (SELECT sid, count(*) AS queries, max(score) AS best FROM s GROUP BY 1),
    f AS (SELECT sid, min(candidate_id) AS candidate_id FROM c GROUP BY 1),
    x AS (SELECT c.candidate_id, c.sid AS source_id, c.topic_axis, c.published_at, coalesce(m.queries, 0) AS queries, m.best, len({HITS_SQL}) AS hits FROM f JOIN c USING (candidate_id) LEFT JOIN m ON m.sid = c.sid)"""


def scored(spark, sf):
    """Candidates of one source id merged: the first stays, each query keeps its largest score."""
    c = candidates(spark, sf).withColumn("source_id", F.trim("source_id")).where(F.length("source_id") > 0)
    s = c.select("source_id", F.explode("query_ranks").alias("query", "rank")).groupBy("source_id", "query").agg(F.max(1000.0 - F.col("rank")).alias("score"))
    m = s.groupBy("source_id").agg(F.count("*").alias("queries"), F.max("score").alias("best"))
    first = F.min_by(F.struct("candidate_id", "topic_axis", "published_at", "title", "abstract"), "candidate_id")
    f = c.groupBy("source_id").agg(first.alias("f")).select("source_id", "f.*")
    x = f.join(m, "source_id", "left")
    return x.select("candidate_id", "source_id", "topic_axis", "published_at", F.coalesce("queries", F.lit(0)).alias("queries"), "best", F.size(hits()).alias("hits"))


@query(f"{SCORED_SQL} SELECT * FROM x")
def scored_merge(spark, sf):
    return scored(spark, sf)


TARGETS = {"rover_autonomy": 17, "onboard_ai": 17, "satellite_autonomy": 16}  # report papers still wanted of each axis
_TARGET = " ".join(f"WHEN '{a}' THEN {n}" for a, n in TARGETS.items())


@query(f"{SCORED_SQL} SELECT topic_axis, candidate_id, row_number() OVER (PARTITION BY topic_axis ORDER BY hits DESC, queries DESC, coalesce(best, 0) DESC, published_at DESC NULLS LAST, candidate_id) AS place FROM x WHERE topic_axis IS NOT NULL QUALIFY place <= 4 * CASE topic_axis {_TARGET} ELSE 0 END")
def report_review_pool(spark, sf):
    """The review pool of report papers is the feature: the best of each axis, four times as many as are wanted."""
    w = Window.partitionBy("topic_axis").orderBy(F.desc("hits"), F.desc("queries"), F.desc(F.coalesce("best", F.lit(0.0))), F.desc_nulls_last("published_at"), "candidate_id")
    wanted = F.coalesce(*[F.when(F.col("topic_axis") == a, F.lit(n)) for a, n in TARGETS.items()], F.lit(0))
    return scored(spark, sf).where("topic_axis is not null").withColumn("place", F.row_number().over(w)).where(F.col("place") <= 4 * wanted).select("topic_axis", "candidate_id", "place")


@query("SELECT source, source_id FROM core_documents WHERE source IS NOT NULL AND source_id IS NOT NULL INTERSECT SELECT source, source_id FROM resolutions")
def resolved_documents(spark, sf):
    d = documents(spark, sf).where("source is not null and source_id is not null").select("source", "source_id")
    return d.intersect(table(spark, sf, "resolutions").select("source", "source_id"))


WANTED = ["id", "source", "source_id", "clean_content", "content_hash", "embedding", "checksum"]


@query(f"SELECT * FROM (SELECT unnest({WANTED}) AS column_name) EXCEPT SELECT column_name FROM (DESCRIBE core_documents)")
def missing_columns(spark, sf):
    """Required columns the stored table doesn't have."""
    have = documents(spark, sf).columns
    return spark.createDataFrame([(c,) for c in WANTED if c not in have], "column_name string")


TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "date": "DATE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT", "double": "DOUBLE", "boolean": "BOOLEAN", "array<string>": "VARCHAR[]", "array<float>": "FLOAT[]"}


@query("SELECT 'core_documents' AS table_name, column_name, column_type FROM (DESCRIBE core_documents) UNION ALL SELECT 'core_chunks', column_name, column_type FROM (DESCRIBE core_chunks)")
def catalog_columns(spark, sf):
    """Names and types of the stored columns, from the schema alone."""
    rows = [(t, f.name, TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())) for t in ("core_documents", "core_chunks") for f in table(spark, sf, t).schema]
    return spark.createDataFrame(rows, "table_name string, column_name string, column_type string")


@query(f"SELECT candidate_id, array_to_string(list_sort(list_distinct(list_concat(coalesce(matched_queries, []), coalesce(map_keys(query_ranks), [])))), ',') AS queries FROM {CAND}")
def united_queries(spark, sf):
    """Matched queries and those with a rank, each once, in the order they were found; sorted here to compare."""
    none = F.array().cast("array<string>")
    both = F.array_distinct(F.concat(F.coalesce("matched_queries", none), F.coalesce(F.map_keys("query_ranks"), none)))
    return candidates(spark, sf).select("candidate_id", F.array_join(F.array_sort(both), ",").alias("queries"))


@query("SELECT id, sha256(to_json({'stage': 'load', 'source': coalesce(source, ''), 'chars': coalesce(char_count, 0), 'axis': coalesce(topic_axis, '')})::VARCHAR) AS h FROM core_documents")
def metadata_json(spark, sf):
    s = F.struct(F.lit("load").alias("stage"), F.coalesce("source", F.lit("")).alias("source"), F.coalesce("char_count", F.lit(0)).alias("chars"), F.coalesce("topic_axis", F.lit("")).alias("axis"))
    return documents(spark, sf).select("id", F.sha2(F.to_json(s), 256).alias("h"))


MANIFEST = f"(SELECT id + CASE WHEN id % 101 = 0 THEN 1000000000 ELSE 0 END AS chunk_id, document_id + CASE WHEN id % 97 = 0 THEN 1 ELSE 0 END AS document_id, chunk_index + CASE WHEN id % 89 = 0 THEN 1 ELSE 0 END AS chunk_index, CASE WHEN id % 83 = 0 THEN upper(content_hash) || 'x' ELSE content_hash END AS content_hash FROM {CHUNKS})"


@query(
    f"""SELECT m.chunk_id, CASE WHEN c.id IS NULL THEN 'missing_chunk_id' ELSE array_to_string(list_filter([CASE WHEN c.document_id IS DISTINCT FROM m.document_id THEN 'document_id' END, CASE WHEN c.chunk_index IS DISTINCT FROM m.chunk_index THEN 'chunk_index' END,
    CASE WHEN c.content_hash IS DISTINCT FROM m.content_hash THEN 'content_hash' END], lambda x: x IS NOT NULL), ',') END AS failed FROM {MANIFEST} m LEFT JOIN {CHUNKS} c ON c.id = m.chunk_id
    WHERE c.id IS NULL OR c.document_id IS DISTINCT FROM m.document_id OR c.chunk_index IS DISTINCT FROM m.chunk_index OR c.content_hash IS DISTINCT FROM m.content_hash"""
)
def vector_manifest_faults(spark, sf):
    """A manifest with faults of four kinds against the stored chunks."""
    c = chunk_columns(spark, sf, "document_id", "chunk_index", "content_hash")
    m = c.select(
        (F.col("id") + F.when(F.col("id") % 101 == 0, 1000000000).otherwise(0)).alias("chunk_id"), (F.col("document_id") + F.when(F.col("id") % 97 == 0, 1).otherwise(0)).alias("md"),
        (F.col("chunk_index") + F.when(F.col("id") % 89 == 0, 1).otherwise(0)).alias("mi"), F.when(F.col("id") % 83 == 0, F.concat(F.upper("content_hash"), F.lit("x"))).otherwise(F.col("content_hash")).alias("mh"),
    )
    x = m.join(c.withColumnRenamed("id", "chunk_id").withColumn("there", F.lit(True)), "chunk_id", "left")
    checks = [F.when(~F.col(a).eqNullSafe(F.col(b)), b) for a, b in (("md", "document_id"), ("mi", "chunk_index"), ("mh", "content_hash"))]
    failed = F.when(F.col("there").isNull(), "missing_chunk_id").otherwise(F.array_join(F.array_compact(F.array(*checks)), ","))
    return x.select("chunk_id", failed.alias("failed")).where("failed <> ''")


@query(f"SELECT id, document_id, (row_number() OVER (ORDER BY document_id, chunk_index, id) - 1)::BIGINT AS vector_index FROM {CHUNKS} WHERE document_id IS NOT NULL")
def vector_index(spark, sf):
    """Places of the chunks in the matrix of vectors, in the order of documents and chunks."""
    from ..operators.upsert import numbered

    c = chunk_columns(spark, sf, "document_id", "chunk_index").where("document_id is not null")
    return numbered(c, ["document_id", "chunk_index", "id"], "place").select("id", "document_id", (F.col("place") - 1).alias("vector_index"))
