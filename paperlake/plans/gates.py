"""Gates and reports over stored tables that go beyond single counts: vectors, identities, candidates, stages, expectations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import base_id
from ..operators.sinks import expected_counts, stage_report
from ..operators.upsert import update_columns
from ..sources.tables import candidates, chunk_columns, documents, table
from .joins import CAND
from .registry import query
from .verify import AXES, CHUNKS

DOI = r"regexp_replace(lower(trim(doi, ' ')), '^(?:https?://(?:dx\.)?doi\.org/|doi:\s*)', '')"


@query(f"SELECT k AS doi, count(*) AS n, min(id) AS first_id FROM (SELECT id, {DOI} AS k FROM core_documents WHERE doi IS NOT NULL) WHERE starts_with(k, '10.') GROUP BY 1 HAVING count(*) > 1")
def duplicate_dois(spark, sf):
    k = F.regexp_replace(F.lower(F.trim("doi")), r"^(?:https?://(?:dx\.)?doi\.org/|doi:\s*)", "")
    return documents(spark, sf).select("id", k.alias("doi")).where(F.startswith("doi", F.lit("10."))).groupBy("doi").agg(F.count("*").alias("n"), F.min("id").alias("first_id")).where("n > 1")


@query(
    """SELECT DISTINCT ON (id) id, CASE WHEN embedding IS NULL THEN 'missing' WHEN len(embedding) <> 256 THEN 'shape' WHEN len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) > 0 THEN 'not_finite'
    WHEN len(list_filter(embedding, lambda x: x <> 0)) = 0 THEN 'zero' ELSE 'fine' END AS fault, CASE WHEN len(embedding) = 256 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 THEN (abs(sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])) - 1) < 0.001)::INTEGER END AS unit FROM core_chunks"""
)
def vector_faults(spark, sf):
    """What is wrong with each chunk's vector, and whether it has unit length."""
    v = F.col("embedding")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fault = F.when(v.isNull(), "missing").when(F.size(v) != 256, "shape").when(bad, "not_finite").when(~F.exists(v, lambda x: x != 0), "zero").otherwise("fine")
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    c = table(spark, sf, "core_chunks").select("id", fault.alias("fault"), F.when((F.size(v) == 256) & ~bad, (F.abs(norm - 1) < 0.001).cast("int")).alias("unit"))
    return c.dropDuplicates(["id"])


@query(
    r"""SELECT id, array_to_string(list_filter([CASE WHEN source = 'arxiv' AND NOT regexp_matches(source_id, '^\d{4}\.\d{4,5}(v\d+)?$') THEN 'arxiv_id' END, CASE WHEN source = 'ntrs' AND NOT regexp_matches(source_id, '^\d+$') THEN 'ntrs_id' END,
    CASE WHEN source IS NULL OR source NOT IN ('arxiv', 'ntrs') THEN 'source' END, CASE WHEN normalization_version IS NULL AND clean_content IS NOT NULL THEN 'version' END, CASE WHEN updated_at < created_at THEN 'times' END], lambda x: x IS NOT NULL), ',') AS faults FROM core_documents"""
)
def identity_faults(spark, sf):
    """Ids that don't have the form of their source, unknown sources, cleaned rows without a version, impossible times."""
    c = F.col
    rules = [
        ((c("source") == "arxiv") & ~c("source_id").rlike(r"^\d{4}\.\d{4,5}(v\d+)?$"), "arxiv_id"), ((c("source") == "ntrs") & ~c("source_id").rlike(r"^\d+$"), "ntrs_id"),
        (c("source").isNull() | ~c("source").isin("arxiv", "ntrs"), "source"), (c("normalization_version").isNull() & c("clean_content").isNotNull(), "version"), (c("updated_at") < c("created_at"), "times"),
    ]
    return documents(spark, sf).select("id", F.array_join(F.array_compact(F.array(*[F.when(k, F.lit(n)) for k, n in rules])), ",").alias("faults"))


@query(
    f"""SELECT candidate_id, array_to_string(list_filter([CASE WHEN EXISTS (SELECT 1 FROM core_documents d WHERE d.source = c.source AND regexp_replace(d.source_id, 'v[0-9]+$', '') = regexp_replace(c.source_id, 'v[0-9]+$', '')) THEN 'stored' END,
    CASE WHEN topic_axis IS NULL OR topic_axis NOT IN ('{"', '".join(AXES)}') THEN 'axis' END, CASE WHEN title IS NULL OR length(trim(title, ' ')) = 0 THEN 'title' END, CASE WHEN abstract IS NULL OR length(trim(abstract, ' ')) = 0 THEN 'abstract' END,
    CASE WHEN url IS NULL OR NOT regexp_matches(url, '^https?://') THEN 'url' END], lambda x: x IS NOT NULL), ',') AS faults FROM {CAND} c"""
)
def candidate_faults(spark, sf):
    """What keeps a candidate from being loaded: it is stored, or parts are missing."""
    d = documents(spark, sf).where("source is not null and source_id is not null").select("source", base_id(F.col("source_id")).alias("base")).distinct().withColumn("stored", F.lit(True))
    x = candidates(spark, sf).withColumn("base", base_id(F.col("source_id"))).join(d, ["source", "base"], "left")
    blank = lambda c: F.col(c).isNull() | (F.length(F.trim(c)) == 0)
    rules = [(F.col("stored"), "stored"), (F.col("topic_axis").isNull() | ~F.col("topic_axis").isin(AXES), "axis"), (blank("title"), "title"), (blank("abstract"), "abstract"), (F.col("url").isNull() | ~F.col("url").rlike("^https?://"), "url")]
    return x.select("candidate_id", F.array_join(F.array_compact(F.array(*[F.when(k, F.lit(n)) for k, n in rules])), ",").alias("faults"))


_N = "len(regexp_extract_all(coalesce({0}, ''), '\\S+'))"


@query(
    f"""SELECT source, count(*) AS documents, count(*) FILTER (WHERE length(clean_content) > 0) AS done, sum(b)::BIGINT AS words_before, sum(a)::BIGINT AS words_after, min(a) AS least, max(a) AS most,
    round((1 - sum(a)::DOUBLE / nullif(sum(b), 0)) * 100, 2) AS reduction FROM (SELECT source, clean_content, {_N.format('raw_content')} AS b, {_N.format('clean_content')} AS a FROM core_documents) GROUP BY 1"""
)
def cleaning_report(spark, sf):
    """The report of a stage: documents, those done, words before and after, and what was cut."""
    return stage_report(documents(spark, sf).select("source", "raw_content", "clean_content"), ["source"], "raw_content", "clean_content")


EXPECTED = [("rover_autonomy", 34), ("onboard_ai", 33), ("satellite_autonomy", 33), ("deep_space", 1)]


@query(
    f"""SELECT coalesce(e.topic_axis, d.topic_axis) AS topic_axis, coalesce(e.expected, 0)::BIGINT AS expected, coalesce(d.n, 0) AS found, coalesce(e.expected, 0) = coalesce(d.n, 0) AS ok FROM (VALUES {", ".join(f"('{a}', {n})" for a, n in EXPECTED)}) e(topic_axis, expected)
    FULL JOIN (SELECT topic_axis, count(*) AS n FROM core_documents GROUP BY 1) d ON d.topic_axis IS NOT DISTINCT FROM e.topic_axis"""
)
def axis_expectations(spark, sf):
    want = spark.createDataFrame(EXPECTED, "topic_axis string, expected long")
    return expected_counts(documents(spark, sf), want, "topic_axis")


@query(f"SELECT id, CASE WHEN id % 7 = 0 THEN 3 ELSE len(embedding) END AS dims, CASE WHEN id % 7 = 0 THEN 'svd_3_v2' ELSE embedding_version END AS version FROM {CHUNKS}")
def vector_update(spark, sf):
    """New vectors put in the place of old ones by id; all other rows and columns stay."""
    c = chunk_columns(spark, sf, "embedding", "embedding_version")
    new = c.where("id % 7 = 0").select("id", F.array(*[F.lit(x).cast("float") for x in (1, 0, 0)]).alias("embedding"), F.lit("svd_3_v2").alias("embedding_version"))
    return update_columns(c, new, ["id"]).select("id", F.when(F.col("embedding").isNotNull(), F.size("embedding")).alias("dims"), F.col("embedding_version").alias("version"))
