"""Text normalisation, quality features and gates over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import quality as Q
from ..functions import text as N
from ..sources.tables import chunk_columns, documents, table
from .registry import query
from .verify import CHUNKS

WS = r"[\s\x{000B}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


def squeeze_sql(x: str) -> str:
    return f"trim(regexp_replace({x}, '{WS}', ' ', 'g'), ' ')"



@query(f"SELECT doc_id, sha256({squeeze_sql('text')}) AS h FROM documents WHERE text IS NOT NULL")
def norm_space(spark, sf):
    return table(spark, sf, "documents").where("text is not null").select("doc_id", F.sha2(N.squeeze(F.col("text")), 256).alias("h"))


@query(
    r"""SELECT id, length(regexp_replace(regexp_replace(regexp_replace(x, '[ \t\x{00A0}\x{2009}\x{202F}]+', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g')) AS n FROM
    (SELECT id, replace(replace(replace(replace(replace(regexp_replace(regexp_replace(raw_content, '\r\n?', chr(10), 'g'), '[\x00\x{00AD}\x{FEFF}]', '', 'g'), 'ﬀ', 'ff'), 'ﬁ', 'fi'), 'ﬂ', 'fl'), 'ﬃ', 'ffi'), 'ﬄ', 'ffl') AS x FROM core_documents WHERE raw_content IS NOT NULL)"""
)
def norm_lines(spark, sf):
    return documents(spark, sf).where("raw_content is not null").select("id", F.length(N.lines_normal(F.col("raw_content"))).alias("n"))


@query("SELECT id, trim(regexp_replace(lower(title), '[^a-z0-9]+', ' ', 'g'), ' ') AS key FROM core_documents")
def title_keys(spark, sf):
    return documents(spark, sf).select("id", N.title_key(F.col("title")).alias("key"))


@query(f"SELECT section_heading, regexp_replace(regexp_replace(regexp_replace(lower({squeeze_sql('section_heading')}), '^#+\\s*', ''), '^(?:[0-9]+(?:\\.[0-9]+)*|[ivxl]+|[a-z])[.)]?\\s+', ''), '^[ .:\\-]+|[ .:\\-]+$', '', 'g') AS key, count(*) AS n FROM {CHUNKS} WHERE section_heading IS NOT NULL GROUP BY ALL")
def heading_keys(spark, sf):
    c = chunk_columns(spark, sf, "section_heading").where("section_heading is not null")
    return c.groupBy("section_heading").agg(F.count("*").alias("n")).select("section_heading", N.heading_key(F.col("section_heading")).alias("key"), "n")


@query("SELECT id, regexp_replace(source_id, 'v[0-9]+$', '') AS base, coalesce(TRY_CAST(nullif(regexp_extract(source_id, 'v([0-9]+)$', 1), '') AS INTEGER), 0) AS version FROM core_documents")
def strip_version(spark, sf):
    return documents(spark, sf).select("id", N.base_id(F.col("source_id")).alias("base"), N.version(F.col("source_id")).alias("version"))


@query("SELECT id, lower(regexp_extract(regexp_replace(pdf_url, '[?#].*$', ''), '\\.([A-Za-z0-9]{1,5})$', 1)) AS ext FROM core_documents WHERE pdf_url IS NOT NULL")
def url_extensions(spark, sf):
    return documents(spark, sf).where("pdf_url is not null").select("id", N.extension(F.col("pdf_url")).alias("ext"))


@query(f"SELECT id, len(regexp_extract_all({squeeze_sql('chunk_text')}, '[A-Za-z]+(?:[''’\\-][A-Za-z]+)*')) AS words, round(coalesce(length(regexp_replace(chunk_text, '[^\\p{{L}}]', '', 'g'))::DOUBLE / nullif(length(regexp_replace(chunk_text, '\\s', '', 'g')), 0), 0), 4) AS alpha FROM {CHUNKS}")
def word_and_alpha(spark, sf):
    c = chunk_columns(spark, sf, "chunk_text")
    t = F.col("chunk_text")
    return c.select("id", F.size(Q.word_tokens(N.squeeze(t))).alias("words"), F.round(Q.alpha_ratio(t), 4).alias("alpha"))


USUAL_RE2 = Q.USUAL.replace("'", "''")
PIECES = "list_filter(string_split(t, ' '), lambda x: x <> '')"
FEATURES_SQL = f"""SELECT id, t, length(t) AS chars, len(regexp_extract_all(t, '[A-Za-z]+(?:[''’\\-][A-Za-z]+)*')) AS words, greatest(len({PIECES}), 1) AS n,
    coalesce(length(regexp_replace(t, '[^\\p{{L}}]', '', 'g'))::DOUBLE / nullif(length(regexp_replace(t, '\\s', '', 'g')), 0), 0) AS alpha,
    coalesce(len(regexp_extract_all(t, '{USUAL_RE2}'))::DOUBLE / nullif(length(regexp_replace(t, '\\s', '', 'g')), 0), 1) AS weird,
    coalesce(list_max(list_transform(string_split(array_to_string(list_transform({PIECES}, lambda x: CASE WHEN length(regexp_replace(x, '^[^A-Za-z]+|[^A-Za-z]+$', '', 'g')) = 1 THEN '1' ELSE '0' END), ''), '0'), lambda y: length(y))), 0) AS run,
    len(list_filter({PIECES}, lambda x: regexp_matches(regexp_replace(x, '^[^A-Za-z]+|[^A-Za-z]+$', '', 'g'), '^[B-HJ-Zb-hj-z]$'))) AS single,
    len(regexp_extract_all(t, '\\b[B-HJ-Z]\\s+[a-z]{{5,}}\\b')) AS split,
    len(list_filter({PIECES}, lambda x: regexp_matches(x, '{Q.BROKEN}'))) AS broken
    FROM (SELECT id, {squeeze_sql("coalesce(chunk_text, '')")} AS t FROM {CHUNKS})"""
GATE_SQL = f"""SELECT id, list_filter([CASE WHEN chars < 160 THEN 'too_short_chars' END, CASE WHEN words < 30 THEN 'too_few_words' END, CASE WHEN alpha < 0.5 THEN 'low_alpha' END, CASE WHEN run >= 3 THEN 'letter_run' END,
    CASE WHEN single >= 6 AND single::DOUBLE / n >= 0.05 THEN 'single_letters' END, CASE WHEN split >= 3 THEN 'split_words' END, CASE WHEN broken >= 2 THEN 'broken_tokens' END, CASE WHEN weird > 0.12 THEN 'weird_signs' END,
    CASE WHEN contains(t, chr(65533)) THEN 'replacement_chars' END, CASE WHEN regexp_matches(lower(t), '^(?:\\[figure|\\[fig\\.|figure caption)') AND words < 120 THEN 'figure_caption' END], lambda x: x IS NOT NULL) AS reasons,
    round(greatest(0.0::DOUBLE, least(1.0::DOUBLE, 1.0::DOUBLE - (CASE WHEN alpha >= 0.5 AND alpha < 0.6 THEN 0.1 ELSE 0 END + CASE WHEN NOT (single >= 6 AND single::DOUBLE / n >= 0.05) AND single >= 3 AND single::DOUBLE / n >= 0.03 THEN 0.1 ELSE 0 END
    + CASE WHEN split < 3 THEN split * 0.1 ELSE 0 END + CASE WHEN broken = 1 THEN 0.15 ELSE 0 END + CASE WHEN weird <= 0.12 AND weird > 0.05 THEN 0.1 ELSE 0 END)::DOUBLE)), 4) AS score FROM ({FEATURES_SQL})"""


def gated(spark, sf):
    return Q.gated(chunk_columns(spark, sf, "chunk_text"), "chunk_text").select("id", "accepted", "score", "reasons")


@query(f"SELECT id, len(reasons) = 0 AND score >= 0.7 AS accepted, score, array_to_string(reasons, ',') AS reasons FROM ({GATE_SQL})")
def quality_gate(spark, sf):
    return gated(spark, sf).withColumn("reasons", F.array_join("reasons", ","))


@query(f"SELECT r AS reason, count(*) AS n FROM (SELECT unnest(reasons) AS r FROM ({GATE_SQL})) GROUP BY 1")
def quality_reasons(spark, sf):
    return gated(spark, sf).select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


@query(
    f"""SELECT d.id, array_to_string(list_filter([CASE WHEN length(coalesce(clean_content, '')) < 5000 THEN 'too_few_chars' END, CASE WHEN len(list_filter(string_split({squeeze_sql("coalesce(clean_content, '')")}, ' '), lambda x: x <> '')) < 800 THEN 'too_few_words' END,
    CASE WHEN coalesce(length(regexp_replace(lower(coalesce(clean_content, '')), '[^a-z]', '', 'g'))::DOUBLE / nullif(length(regexp_replace(coalesce(clean_content, ''), '\\s', '', 'g')), 0), 0) < 0.45 THEN 'low_alpha' END,
    CASE WHEN coalesce(s.k, 0) < 2 THEN 'too_few_sections' END], lambda x: x IS NOT NULL), ',') AS reasons
    FROM core_documents d LEFT JOIN (SELECT document_id, count(DISTINCT section_index) AS k FROM core_chunks GROUP BY 1) s ON s.document_id = d.id"""
)
def document_gate(spark, sf):
    s = table(spark, sf, "core_chunks").groupBy(F.col("document_id").alias("id")).agg(F.countDistinct("section_index").alias("k"))
    d = documents(spark, sf).select("id", "clean_content").join(s, "id", "left")
    return d.select("id", F.array_join(Q.document_reasons(F.col("clean_content"), F.coalesce("k", F.lit(0))), ",").alias("reasons"))


@query(
    r"""SELECT lang, count(*) AS lines, count(*) FILTER (WHERE regexp_matches(line, '[\x{FFFD}\x00]') OR (length(s) >= 80 AND length(regexp_replace(s, '[^\p{L}]', '', 'g'))::DOUBLE / length(s) < 0.30)) AS garbage FROM
    (SELECT lang, line, regexp_replace(line, '\s', '', 'g') AS s FROM (SELECT lang, unnest(string_split(text, chr(10))) AS line FROM documents WHERE text IS NOT NULL)) GROUP BY 1"""
)
def garbage_lines(spark, sf):
    x = table(spark, sf, "documents").where("text is not null").select("lang", F.explode(F.split("text", "\n")).alias("line"))
    s = F.regexp_replace("line", r"\s", "")
    bad = F.col("line").rlike(r"[\x{FFFD}\x00]") | ((F.length(s) >= 80) & (F.length(F.regexp_replace(s, r"[^\p{L}]", "")) / F.length(s) < 0.30))
    return x.groupBy("lang").agg(F.count("*").alias("lines"), F.count_if(bad).alias("garbage"))


@query(
    """SELECT id, m AS line, n FROM (SELECT id, m, count(*) AS n FROM (SELECT id, regexp_replace(trim(unnest(string_split(raw_content, chr(10))), ' '), '[0-9]', '9', 'g') AS m FROM core_documents WHERE raw_content IS NOT NULL)
    WHERE length(m) BETWEEN 1 AND 100 GROUP BY ALL) WHERE n >= 3"""
)
def repeated_lines(spark, sf):
    """Short lines that, with digits masked, occur three times or more in a document: its running heads."""
    x = documents(spark, sf).where("raw_content is not null").select("id", F.explode(F.split("raw_content", "\n")).alias("l"))
    m = x.select("id", F.regexp_replace(F.trim("l"), "[0-9]", "9").alias("line")).where(F.length("line").between(1, 100))
    return m.groupBy("id", "line").agg(F.count("*").alias("n")).where("n >= 3")


@query("SELECT id, TRY_CAST(substr(published_at::VARCHAR, 1, 10) AS DATE) AS day, year(published_at) AS y FROM core_documents")
def published_days(spark, sf):
    return documents(spark, sf).select("id", N.first_date(F.col("published_at").cast("string")).alias("day"), F.year("published_at").alias("y"))
