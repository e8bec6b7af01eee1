"""Parsed documents of any format as one table of blocks, and the sections cleaning keeps.

A block is (ident, pos, type, level, text, in_bibliography), whatever it was read from: HTML, TeX, pages or lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import heading_key
from .html import html_blocks
from .pages import page_sections, report_blocks
from .tex import tex_blocks

#: Headings that open the list of references, and sections left out of clean text, of papers and of reports.
REFERENCE_HEADINGS = ["reference", "references", "bibliography", "bibliographies", "literature cited", "works cited"]
PAPER_REMOVED = ["acknowledgment", "acknowledgments", "acknowledgement", "acknowledgements", "funding", "funding statement", "conflict of interest", "conflicts of interest", "competing interests", "author contributions"]
REPORT_REMOVED = ["acknowledgment", "acknowledgments", "acknowledgement", "acknowledgements", "funding", "funding information", "funding statement", "conflict of interest", "conflicts of interest", "competing interests", "declaration of competing interest", "author contribution", "author contributions", "authors contributions", "data availability", "data availability statement", "ethics statement"]
MIN_CHARS, MIN_WORDS, MIN_SECTIONS = 500, 80, 1  # what a parsed document must have


def detected(text: Column) -> Column:
    """'html', 'tex', 'pages' (form feeds), 'text', or null for what is null or blank."""
    return (
        F.when(F.length(F.trim(text)).isNull() | (F.length(F.trim(text)) == 0), F.lit(None).cast("string"))
        .when(text.rlike(r"(?i)</(?:p|h[1-6]|li|div|table)>|<(?:p|h[1-6]|html|body)[ >]"), "html")
        .when(text.rlike(r"\\(?:sub)*section\*?[\[{]|\\begin\{|\\documentclass"), "tex")
        .when(F.contains(text, F.lit("\f")), "pages")
        .otherwise("text")
    )


def parsed(df: DataFrame, ident: str, text: str, title: str) -> DataFrame:
    """Blocks of each document by the reader of its format; blank documents have none."""
    x = df.select(ident, text, title, detected(F.col(text)).alias("_format"))
    of = lambda f: x.where(F.col("_format") == f)
    sections = page_sections(of("pages"), ident, text)
    heads = sections.where("heading <> 'Document Body'").groupBy(ident, "section").agg(F.min("pos").alias("pos"), F.first("heading").alias("text"), F.first("level").alias("level"))
    # a section's heading goes before its first paragraph
    paged = heads.select(ident, (F.col("pos") * 2).alias("pos"), F.lit("heading").alias("type"), (F.col("level") + 1).alias("level"), "text", F.lit(False).alias("in_bibliography"))
    paged = paged.unionByName(sections.select(ident, (F.col("pos") * 2 + 1).alias("pos"), "type", F.lit(0).alias("level"), "text", F.lit(False).alias("in_bibliography")))
    return html_blocks(of("html"), ident, text).unionByName(tex_blocks(of("tex"), ident, text)).unionByName(paged).unionByName(report_blocks(of("text"), ident, text, title))


def parse_faults(docs: DataFrame, blocks: DataFrame, ident: str) -> DataFrame:
    """(ident, faults): documents whose parsed form is too short or has no section with text; all three of those without."""
    b = blocks.where("type <> 'heading'").groupBy(ident).agg(F.sum(F.length("text")).alias("_chars"), F.sum(F.regexp_count("text", F.lit(r"\S+"))).alias("_words"), F.lit(1).alias("_sections"))
    rules = [("few_chars", F.coalesce("_chars", F.lit(0)) < MIN_CHARS), ("few_words", F.coalesce("_words", F.lit(0)) < MIN_WORDS), ("no_section", F.coalesce("_sections", F.lit(0)) < MIN_SECTIONS)]
    faults = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules]))
    return docs.select(ident).join(b, ident, "left").select(ident, faults.alias("faults")).where(F.size("faults") > 0)


def is_reference(key: Column) -> Column:
    return key.isin(REFERENCE_HEADINGS) | key.rlike("^(?:references|bibliography) ")


def kept_sections(sections: DataFrame, ident: str, key: str, order: str, stop: bool) -> DataFrame:
    """Sections without references and the removed ones; with stop (reports) nothing after the references is kept."""
    x = sections.where(~F.col(key).isin(REPORT_REMOVED if stop else PAPER_REMOVED))
    ref = is_reference(F.col(key))
    if not stop:
        return x.where(~ref)
    first = x.where(ref).groupBy(ident).agg(F.min(order).alias("_stop"))
    return x.join(first, ident, "left").where(F.col("_stop").isNull() | (F.col(order) < F.col("_stop"))).drop("_stop")


def block_stats(blocks: DataFrame, ident: str) -> DataFrame:
    """Blocks by type, signs and words of each document."""
    n = lambda t: F.count_if(F.col("type") == t).alias(f"{t}s")
    kinds = [n(t) for t in ("heading", "paragraph", "list_item", "equation", "figure_caption", "table_caption")]
    return blocks.groupBy(ident).agg(*kinds, F.count_if("in_bibliography").alias("bibliography"), F.sum(F.length("text")).alias("chars"), F.sum(F.regexp_count("text", F.lit(r"\S+"))).alias("words"))


def sectioned(blocks: DataFrame, ident: str) -> DataFrame:
    """Blocks with the number and the key of the section they stand in, and whether it is the list of references: the
    mark of a block is kept by the blocks after it in its section."""
    from pyspark.sql import Window

    w = Window.partitionBy(ident).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    head = F.col("type") == "heading"
    x = blocks.withColumn("section", F.sum(head.cast("int")).over(w)).withColumn("key", F.coalesce(F.last(F.when(head, heading_key(F.col("text"))), True).over(w), F.lit("")))
    within = Window.partitionBy(ident, "section").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return x.withColumn("in_bibliography", F.max("in_bibliography").over(within))
