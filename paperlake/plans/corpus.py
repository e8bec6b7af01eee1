"""Chunking, language-model corpus and parsing plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.chunking import chunked, hard_split, sections
from ..operators.html import html_blocks
from ..sources.tables import documents, table, usable
from .registry import query

WORDS = "list_filter(string_split(trim(regexp_replace(clean_content, '\\s+', ' ', 'g'), ' '), ' '), lambda x: x <> '')"


@query(f"SELECT id, part::INT AS part, sha256(array_to_string(w[part * 420 + 1:part * 420 + 420], ' ')) AS h FROM (SELECT id, w, unnest(range(0, (len(w) - 1) // 420 + 1)) AS part FROM (SELECT id, {WORDS} AS w FROM core_documents WHERE clean_content IS NOT NULL) WHERE len(w) > 0)")
def hard_word_split(spark, sf):
    d = documents(spark, sf).where("clean_content is not null").select("id", "clean_content")
    return hard_split(d, "id", "clean_content").select("id", "part", F.sha2("body", 256).alias("h"))


def markdown(spark, sf):
    """Short lines set apart become headings: the stored text has its sections as plain lines."""
    d = usable(documents(spark, sf)).select("id", "title", "clean_content")
    body = F.regexp_replace("clean_content", r"(?m)^([A-Z][A-Za-z ]{3,40})$\n\n", "# $1\n\n")
    return d.select("id", "title", body.alias("text"))


@query()
def document_sections(spark, sf):
    return sections(markdown(spark, sf), "id", "text").select("id", "section", "heading", F.length("body").alias("chars"))


@query()
def chunk_pack(spark, sf):
    """Chunks of every usable document, packed anew."""
    m = markdown(spark, sf)
    s = sections(m, "id", "text").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("section", "heading", "body"))).alias("sections"))
    return chunked(m.select("id", "title").join(s, "id").select(F.col("id").alias("document_id"), "title", "sections")).select("document_id", "chunk_index", "section_index", "section_heading", "word_count", "content_hash")


@query("SELECT doc_id, sha256('<|bos|>' || chr(10) || '<|title|>' || chr(10) || string_split(text, chr(10))[1] || chr(10) || '<|body|>' || chr(10) || text || chr(10) || '<|eos|>') AS framed FROM documents WHERE length(text) > 0")
def lm_framed(spark, sf):
    d = table(spark, sf, "documents").where(F.length("text") > 0)
    t = F.concat_ws("\n", F.lit("<|bos|>"), F.lit("<|title|>"), F.substring_index("text", "\n", 1), F.lit("<|body|>"), "text", F.lit("<|eos|>"))
    return d.select("doc_id", F.sha2(t, 256).alias("framed"))


@query("SELECT source, lang, count(*) AS docs, sum(n_chars)::BIGINT AS chars, round(avg(n_chars), 2) AS mean_chars FROM documents WHERE text IS NOT NULL GROUP BY ALL")
def corpus_stats(spark, sf):
    d = table(spark, sf, "documents").where("text is not null")
    return d.groupBy("source", "lang").agg(F.count("*").alias("docs"), F.sum("n_chars").alias("chars"), F.round(F.avg("n_chars"), 2).alias("mean_chars"))


@query(
    """SELECT id, CASE WHEN n < 1000 THEN 'too_short' WHEN id <> first THEN 'exact_duplicate' ELSE 'kept' END AS state FROM
    (SELECT id, length(clean_content) AS n, min(CASE WHEN length(clean_content) >= 1000 THEN id END) OVER (PARTITION BY sha256(clean_content)) AS first FROM core_documents WHERE clean_content IS NOT NULL)"""
)
def lm_prepare(spark, sf):
    d = documents(spark, sf).where("clean_content is not null").select("id", F.length("clean_content").alias("n"), F.sha2("clean_content", 256).alias("h"))
    first = d.where("n >= 1000").groupBy("h").agg(F.min("id").alias("first"))
    state = F.when(F.col("n") < 1000, "too_short").when(F.col("id") != F.col("first"), "exact_duplicate").otherwise("kept")
    return d.join(first, "h", "left").select("id", state.alias("state"))


@query()
def html_block_stats(spark, sf):
    """Blocks by type of the documents stored as HTML."""
    d = documents(spark, sf).where(F.col("raw_content").rlike("(?i)</(?:p|h[1-6]|li|div)>")).select("id", "raw_content")
    return html_blocks(d, "id", "raw_content").groupBy("id", "type").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))


@query()
def html_cleaned(spark, sf):
    """Clean text of the documents stored as HTML: hash and numbers of blocks before and after."""
    from ..operators.cleaning import clean

    d = documents(spark, sf).where(F.col("raw_content").rlike("(?i)</(?:p|h[1-6]|li|div)>")).select("id", "raw_content")
    return clean(html_blocks(d, "id", "raw_content"), "id", False).select("id", "content_hash", "blocks_before", "blocks_after")
