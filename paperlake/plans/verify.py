"""Verification of the stored tables: counts, sizes, gates that should have no rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources.tables import chunk_columns, documents, table
from .registry import query

AXES = ["rover_autonomy", "onboard_ai", "satellite_autonomy"]


def blank(c):
    return F.col(c).isNull() | (F.length(F.trim(c)) == 0)


@query("SELECT count(*) AS total_documents FROM core_documents")
def doc_total(spark, sf):
    return documents(spark, sf).agg(F.count("*").alias("total_documents"))


def _count_by(*keys):
    return lambda spark, sf: documents(spark, sf).groupBy(*keys).agg(F.count("*").alias("document_count"))


for _name, _keys in (("docs_by_source", ["source"]), ("docs_by_axis", ["topic_axis"]), ("source_axis_matrix", ["source", "topic_axis"]), ("parse_status_counts", ["parse_status"]), ("language_counts", ["language"]), ("normalization_versions", ["normalization_version"])):
    query(f"SELECT {', '.join(_keys)}, count(*) AS document_count FROM core_documents GROUP BY ALL", _name)(_count_by(*_keys))


@query("SELECT id, source, source_id, topic_axis, title, published_at, document_type, language, char_count, parse_status FROM core_documents")
def doc_listing(spark, sf):
    return documents(spark, sf).select("id", "source", "source_id", "topic_axis", "title", "published_at", "document_type", "language", "char_count", "parse_status")


@query("SELECT id, source, source_id FROM core_documents WHERE raw_content IS NULL OR clean_content IS NULL OR length(trim(coalesce(raw_content, ''), ' ')) = 0 OR length(trim(coalesce(clean_content, ''), ' ')) = 0")
def empty_content(spark, sf):
    return documents(spark, sf).where(blank("raw_content") | blank("clean_content")).select("id", "source", "source_id")


@query("SELECT id, length(raw_content) AS raw_chars, length(clean_content) AS clean_chars, round((1 - length(clean_content)::DOUBLE / nullif(length(raw_content), 0)) * 100, 2) AS reduction FROM core_documents")
def length_reduction(spark, sf):
    d = documents(spark, sf)
    return d.select("id", F.length("raw_content").alias("raw_chars"), F.length("clean_content").alias("clean_chars"), F.round((1 - F.length("clean_content").cast("double") / F.nullif(F.length("raw_content"), F.lit(0))) * 100, 2).alias("reduction"))


@query("SELECT id, source_id, length(clean_content) AS chars FROM core_documents WHERE clean_content IS NOT NULL AND length(clean_content) < 5000")
def short_docs(spark, sf):
    return documents(spark, sf).where(F.length("clean_content") < 5000).select("id", "source_id", F.length("clean_content").alias("chars"))


@query("SELECT id, char_count, length(clean_content) AS actual FROM core_documents WHERE char_count IS DISTINCT FROM length(clean_content)")
def char_count_mismatch(spark, sf):
    d = documents(spark, sf)
    return d.where(~F.col("char_count").eqNullSafe(F.length("clean_content"))).select("id", "char_count", F.length("clean_content").alias("actual"))


@query(
    """SELECT id, CASE WHEN title IS NULL OR length(trim(title, ' ')) = 0 THEN 'missing_title' WHEN topic_axis IS NULL THEN 'missing_topic_axis'
    WHEN url IS NULL THEN 'missing_url' WHEN metadata IS NULL THEN 'missing_metadata' ELSE 'ok' END AS label FROM core_documents"""
)
def missing_label(spark, sf):
    c = F.when(blank("title"), "missing_title").when(F.col("topic_axis").isNull(), "missing_topic_axis").when(F.col("url").isNull(), "missing_url").when(F.col("metadata").isNull(), "missing_metadata").otherwise("ok")
    return documents(spark, sf).select("id", c.alias("label"))


@query("SELECT source, regexp_replace(source_id, 'v[0-9]+$', '') AS base, count(*) AS n FROM core_documents GROUP BY ALL HAVING count(*) > 1")
def dup_source_id(spark, sf):
    from ..functions.text import base_id

    return documents(spark, sf).groupBy("source", base_id(F.col("source_id")).alias("base")).agg(F.count("*").alias("n")).where("n > 1")


@query("SELECT content_hash, count(*) AS n, string_agg(source || ':' || source_id, ' | ' ORDER BY source, source_id) AS members FROM core_documents WHERE content_hash IS NOT NULL GROUP BY content_hash HAVING count(*) > 1")
def dup_hash_groups(spark, sf):
    d = documents(spark, sf).where("content_hash is not null")
    # groups of one are dropped before their members are gathered
    twice = d.groupBy("content_hash").agg(F.count("*").alias("n")).where("n > 1")
    members = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("source", "source_id"))), lambda x: F.concat(x["source"], F.lit(":"), x["source_id"])), " | ")
    return d.join(twice, "content_hash").groupBy("content_hash", "n").agg(members.alias("members"))


@query("SELECT id, length(content_hash) AS n FROM core_documents WHERE content_hash IS NOT NULL AND length(content_hash) <> 64")
def hash_length_bad(spark, sf):
    return documents(spark, sf).where(F.length("content_hash") != 64).select("id", F.length("content_hash").alias("n"))


@query("SELECT id FROM core_documents WHERE clean_content IS NOT NULL AND content_hash IS NOT NULL AND content_hash <> sha256(clean_content)")
def hash_recomputed(spark, sf):
    return documents(spark, sf).where(F.col("content_hash") != F.sha2("clean_content", 256)).select("id")


@query("SELECT count(*) AS groups FROM (SELECT content_hash FROM core_documents WHERE content_hash IS NOT NULL GROUP BY 1 HAVING count(*) > 1)")
def dup_group_count(spark, sf):
    return documents(spark, sf).where("content_hash is not null").groupBy("content_hash").count().where("count > 1").agg(F.count("*").alias("groups"))


@query("SELECT source, count(*) AS documents, round(avg(length(raw_content))) AS avg_raw_chars, round(avg(length(clean_content))) AS avg_clean_chars, min(length(clean_content)) AS min_clean_chars, max(length(clean_content)) AS max_clean_chars FROM core_documents GROUP BY source")
def size_by_source(spark, sf):
    n, m = F.length("raw_content"), F.length("clean_content")
    return documents(spark, sf).groupBy("source").agg(F.count("*").alias("documents"), F.round(F.avg(n)).alias("avg_raw_chars"), F.round(F.avg(m)).alias("avg_clean_chars"), F.min(m).alias("min_clean_chars"), F.max(m).alias("max_clean_chars"))


@query("SELECT topic_axis, count(*) AS documents, round(avg(length(clean_content))) AS avg_clean_chars, min(length(clean_content)) AS min_clean_chars, max(length(clean_content)) AS max_clean_chars FROM core_documents GROUP BY topic_axis")
def size_by_axis(spark, sf):
    m = F.length("clean_content")
    return documents(spark, sf).groupBy("topic_axis").agg(F.count("*").alias("documents"), F.round(F.avg(m)).alias("avg_clean_chars"), F.min(m).alias("min_clean_chars"), F.max(m).alias("max_clean_chars"))


@query(
    """SELECT (SELECT count(*) FROM core_documents) AS total_documents, (SELECT count(*) FROM core_documents WHERE source = 'arxiv') AS arxiv_documents,
    (SELECT count(*) FROM core_documents WHERE source = 'ntrs') AS ntrs_documents, (SELECT count(*) FROM core_documents WHERE topic_axis = 'rover_autonomy') AS rover_documents,
    (SELECT count(*) FROM core_documents WHERE topic_axis = 'onboard_ai') AS onboard_documents, (SELECT count(*) FROM core_documents WHERE topic_axis = 'satellite_autonomy') AS satellite_documents,
    (SELECT count(*) FROM core_documents WHERE parse_status = 'parsed') AS parsed_documents,
    (SELECT count(*) FROM core_documents WHERE raw_content IS NULL OR clean_content IS NULL OR length(trim(raw_content, ' ')) = 0 OR length(trim(clean_content, ' ')) = 0) AS empty_documents,
    (SELECT count(*) FROM (SELECT content_hash FROM core_documents WHERE content_hash IS NOT NULL GROUP BY 1 HAVING count(*) > 1)) AS duplicate_hash_groups"""
)
def final_summary(spark, sf):
    """One pass: rows are first summed by hash, so that the duplicate groups come from the same scan."""
    d = documents(spark, sf)
    n = lambda c, name: F.count_if(c).alias(name)
    per = d.groupBy("content_hash").agg(
        F.count("*").alias("total_documents"), n(F.col("source") == "arxiv", "arxiv_documents"), n(F.col("source") == "ntrs", "ntrs_documents"), n(F.col("topic_axis") == AXES[0], "rover_documents"),
        n(F.col("topic_axis") == AXES[1], "onboard_documents"), n(F.col("topic_axis") == AXES[2], "satellite_documents"), n(F.col("parse_status") == "parsed", "parsed_documents"), n(blank("raw_content") | blank("clean_content"), "empty_documents"),
    )
    cols = [c for c in per.columns if c != "content_hash"]
    return per.agg(*[F.sum(c).alias(c) for c in cols], F.count_if(F.col("content_hash").isNotNull() & (F.col("total_documents") > 1)).alias("duplicate_hash_groups"))


@query("SELECT id, json_extract_string(metadata, '$.collector') AS collector, TRY_CAST(json_extract_string(metadata, '$.pages') AS INTEGER) AS pages FROM core_documents WHERE json_extract_string(metadata, '$.collector') IS DISTINCT FROM source")
def json_path_mismatch(spark, sf):
    d = documents(spark, sf)
    c = F.get_json_object("metadata", "$.collector")
    return d.where(~c.eqNullSafe(F.col("source"))).select("id", c.alias("collector"), F.get_json_object("metadata", "$.pages").try_cast("int").alias("pages"))


@query("SELECT count(*) AS n, count(CASE WHEN list_contains(json_keys(metadata), 'batch') THEN 1 END) AS with_batch FROM core_documents")
def json_key_exists(spark, sf):
    has = F.array_contains(F.json_object_keys("metadata"), "batch")
    return documents(spark, sf).agg(F.count("*").alias("n"), F.count_if(has).alias("with_batch"))


@query("SELECT id, topic_axis, language FROM core_documents WHERE topic_axis IS NULL OR topic_axis NOT IN ('rover_autonomy', 'onboard_ai', 'satellite_autonomy') OR language IS DISTINCT FROM 'en'")
def domain_violations(spark, sf):
    return documents(spark, sf).where(F.col("topic_axis").isNull() | ~F.col("topic_axis").isin(AXES) | ~F.col("language").eqNullSafe("en")).select("id", "topic_axis", "language")


CHUNKS = "(SELECT DISTINCT ON (id) * FROM core_chunks)"


@query(f"SELECT d.source, d.topic_axis, count(*) AS chunks, sum(c.word_count) AS words FROM {CHUNKS} c JOIN core_documents d ON d.id = c.document_id GROUP BY ALL")
def chunk_doc_join(spark, sf):
    c = chunk_columns(spark, sf, "document_id", "word_count")
    # one document may hold a tenth of the chunks: they are summed before the join
    per = c.groupBy("document_id").agg(F.count("*").alias("k"), F.sum("word_count").alias("w"))
    d = documents(spark, sf).select(F.col("id").alias("document_id"), "source", "topic_axis")
    return per.join(d, "document_id").groupBy("source", "topic_axis").agg(F.sum("k").alias("chunks"), F.sum("w").alias("words"))


@query(f"SELECT count(*) AS documents, min(n) AS fewest, max(n) AS most, round(avg(n), 4) AS mean FROM (SELECT document_id, count(*) AS n FROM {CHUNKS} GROUP BY 1)")
def chunks_per_doc(spark, sf):
    per = chunk_columns(spark, sf, "document_id").groupBy("document_id").agg(F.count("*").alias("n"))
    return per.agg(F.count("*").alias("documents"), F.min("n").alias("fewest"), F.max("n").alias("most"), F.round(F.avg("n"), 4).alias("mean"))


@query(f"SELECT count(*) AS chunks, count(DISTINCT document_id) AS documents, count(embedding) AS embedded, count(*) FILTER (WHERE embedding_version = 'svd_256_v1') AS versioned, count(*) FILTER (WHERE len(embedding) = 256) AS full_size FROM {CHUNKS}")
def embedding_readiness(spark, sf):
    c = table(spark, sf, "core_chunks").select("id", "document_id", F.size("embedding").alias("dims"), "embedding_version").dropDuplicates(["id"])
    return c.agg(F.count("*").alias("chunks"), F.countDistinct("document_id").alias("documents"), F.count_if(F.col("dims") >= 0).alias("embedded"), F.count_if(F.col("embedding_version") == "svd_256_v1").alias("versioned"), F.count_if(F.col("dims") == 256).alias("full_size"))


@query(f"SELECT document_id, min(chunk_index) AS first, max(chunk_index) AS last, count(*) AS n FROM {CHUNKS} GROUP BY 1 HAVING min(chunk_index) <> 0 OR max(chunk_index) <> count(*) - 1 OR count(DISTINCT chunk_index) <> count(*)")
def broken_index_docs(spark, sf):
    c = chunk_columns(spark, sf, "document_id", "chunk_index")
    per = c.groupBy("document_id").agg(F.min("chunk_index").alias("first"), F.max("chunk_index").alias("last"), F.count("*").alias("n"), F.countDistinct("chunk_index").alias("k"))
    return per.where("first <> 0 or last <> n - 1 or k <> n").drop("k")


@query(f"SELECT id FROM {CHUNKS} WHERE chunk_index < 0 OR section_index < 0 OR word_count <= 0 OR token_estimate <= 0 OR char_count <= 0 OR length(trim(chunk_text, ' ')) = 0 OR length(content_hash) <> 64 OR char_count <> length(chunk_text)")
def chunk_violations(spark, sf):
    c = chunk_columns(spark, sf, "chunk_index", "section_index", "word_count", "token_estimate", "char_count", "chunk_text", "content_hash")
    return c.where("chunk_index < 0 or section_index < 0 or word_count <= 0 or token_estimate <= 0 or char_count <= 0 or length(trim(chunk_text)) = 0 or length(content_hash) <> 64 or char_count <> length(chunk_text)").select("id")


@query(f"SELECT id, document_id FROM {CHUNKS} c WHERE NOT EXISTS (SELECT 1 FROM core_documents d WHERE d.id = c.document_id)")
def orphan_chunks(spark, sf):
    d = documents(spark, sf).select(F.col("id").alias("document_id"))
    return chunk_columns(spark, sf, "document_id").join(d, "document_id", "left_anti").select("id", "document_id")


@query(f"SELECT content_hash, count(*) AS n, count(DISTINCT document_id) AS documents FROM {CHUNKS} GROUP BY 1 HAVING count(*) > 1")
def duplicate_chunk_groups(spark, sf):
    c = chunk_columns(spark, sf, "document_id", "content_hash")
    return c.groupBy("content_hash").agg(F.count("*").alias("n"), F.countDistinct("document_id").alias("documents")).where("n > 1")


@query("SELECT column_name FROM (DESCRIBE core_documents)")
def schema_columns(spark, sf):
    """The catalog's view of the stored table: its schema, without reading rows."""
    return spark.createDataFrame([(c,) for c in documents(spark, sf).columns], "column_name string")


@query("SELECT topic_axis, count(*) AS n, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 2) AS share FROM core_documents GROUP BY topic_axis")
def axis_distribution(spark, sf):
    d = documents(spark, sf).groupBy("topic_axis").agg(F.count("*").alias("n"))
    total = d.agg(F.sum("n").alias("total"))
    return d.join(F.broadcast(total)).select("topic_axis", "n", F.round(F.col("n") * 100.0 / F.col("total"), 2).alias("share"))
