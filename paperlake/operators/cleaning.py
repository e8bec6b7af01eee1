"""Blocks of parsed documents to clean text: junk and references out, repeats out, rendered as Markdown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.quality import BROKEN_LINE, broken_tokens, single_letter_run
from ..functions.text import caption_text, nfc, paper_normal, report_normal, squeeze, unresidued
from .dedup import without_repeats
from .parsing import kept_sections, sectioned


def is_junk(kind: Column, text: Column) -> Column:
    """Lone numbers, page counts, rules, captions under 20 signs, paragraphs under 8 with fewer than 3 letters."""
    number = text.rlike(r"^\s*(?:\d{1,5}|(?i:page)\s+\d+(?:\s+of\s+\d+)?)\s*$")
    rule = text.rlike(r"^\s*[-_=*•·.]{3,}\s*$")
    caption = kind.isin("figure_caption", "table_caption") & (F.length(text) < 20)
    tiny = (kind == "paragraph") & (F.length(text) < 8) & (F.length(F.regexp_replace(text, r"[^\p{L}]", "")) < 3)
    return number | rule | caption | tiny


def rendered(kind: Column, level: Column, text: Column) -> Column:
    """A block as a Markdown line."""
    mark = F.repeat(F.lit("#"), F.least(F.greatest(level, F.lit(2)), F.lit(6)))
    return (
        F.when(kind == "heading", F.concat(mark, F.lit(" "), text))
        .when(kind == "list_item", F.concat(F.lit("- "), text))
        .when(kind == "figure_caption", F.concat(F.lit("[FIGURE CAPTION] "), text))
        .when(kind == "table_caption", F.concat(F.lit("[TABLE CAPTION] "), text))
        .when(kind == "equation", F.concat(F.lit("[EQUATION] "), text))
        .otherwise(text)
    )


def clean(blocks: DataFrame, ident: str, report: bool) -> DataFrame:
    """blocks -> (ident, clean_content, content_hash, blocks_before, blocks_after, reduction).

    A heading opens a section; references are left out, and in a report what follows them too. Texts are composed (NFC);
    papers lose residues of their pages, reports are punctuated anew."""
    normal = (lambda c: report_normal(c)) if report else (lambda c: unresidued(paper_normal(c)))
    x = sectioned(blocks, ident).withColumn("text", squeeze(normal(F.col("text"))))
    before = blocks.groupBy(ident).agg(F.count("*").alias("blocks_before"), F.sum(F.length("text")).alias("_before"))
    kept = kept_sections(x, ident, "key", "section", report).where(~F.col("in_bibliography") & ~is_junk(F.col("type"), F.col("text")) & (F.length("text") > 1))
    caption = F.col("type").isin("figure_caption", "table_caption")
    kept = kept.withColumn("text", F.when(caption, caption_text(F.col("text"))).otherwise(F.col("text"))).where(~caption | (F.length("text") >= 20))
    kept = without_repeats(kept.withColumn("both", F.concat_ws("\x01", "type", "text")), [ident], ["pos"], "both")
    line = F.struct("pos", rendered(F.col("type"), F.col("level"), F.col("text")).alias("line"))
    out = kept.groupBy(ident).agg(F.array_join(F.transform(F.array_sort(F.collect_list(line)), lambda y: y["line"]), "\n\n").alias("clean_content"), F.count("*").alias("blocks_after"), F.sum(F.length("text")).alias("_after"))
    reduction = F.round((1 - F.col("_after") / F.nullif(F.col("_before"), F.lit(0))) * 100, 2)
    return out.join(before, ident).select(ident, "clean_content", F.sha2("clean_content", 256).alias("content_hash"), "blocks_before", "blocks_after", reduction.alias("reduction"))


def raw_rendered(blocks: DataFrame, heads: DataFrame, ident: str) -> DataFrame:
    """(ident, raw_content): title and abstract as headings, then every block as a Markdown line."""
    line = F.struct("pos", rendered(F.col("type"), F.col("level"), F.col("text")).alias("line"))
    body = blocks.groupBy(ident).agg(F.array_join(F.transform(F.array_sort(F.collect_list(line)), lambda y: y["line"]), "\n\n").alias("_body"))
    some = lambda mark, c: F.when(F.length(c) > 0, F.concat(F.lit(mark), F.col(c)))
    return heads.join(body, ident).select(ident, F.concat_ws("\n\n", some("# ", "title"), some("## ABSTRACT\n\n", "abstract"), "_body").alias("raw_content"))


def garbage(line: Column) -> Column:
    """Lines no text is made of: replacement or NUL signs, runs of single letters, several broken pieces, or long and with
    few letters."""
    t = squeeze(line)
    solid_ = F.length(F.regexp_replace(line, r"\s+", ""))
    letters = F.length(F.regexp_replace(line, r"[^\p{L}]+", ""))
    return line.rlike("[\ufffd\x00]") | (single_letter_run(t) >= 4) | (broken_tokens(t, BROKEN_LINE) >= 4) | (solid_ >= 80) & (letters < 0.30 * solid_)


def corpus_text(df: DataFrame, ident: str, text: str) -> DataFrame:
    """(ident, text, dropped): composed, NUL out, blanks squeezed, garbage lines out, at most one empty line. Null texts
    have no row."""
    x = df.where(F.col(text).isNotNull()).select(ident, F.posexplode(F.split(F.regexp_replace(F.regexp_replace(nfc(F.col(text)), "\x00", ""), "\r\n?", "\n"), "\n")).alias("n", "line"))
    x = x.withColumn("line", F.trim(F.regexp_replace("line", "[ \t\u00a0]+", " "))).withColumn("bad", garbage(F.col("line")))
    kept = F.array_sort(F.collect_list(F.when(~F.col("bad"), F.struct("n", "line"))))
    g = x.groupBy(ident).agg(F.array_join(F.transform(kept, lambda y: y["line"]), "\n").alias("text"), F.count_if("bad").alias("dropped"))
    return g.select(ident, F.regexp_replace(F.regexp_replace("text", "\n{3,}", "\n\n"), r"^\s+|\s+$", "").alias("text"), "dropped")
