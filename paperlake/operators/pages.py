"""Paged text (pages set apart by form feeds) to lines, headings, sections and blocks, in SQL operators.

Lines are rows, classes of lines are columns, and states that run along a document (the section, the paragraph) are
running sums in a window over its lines. Null and empty texts have no lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import clean_line, dehyphenated, squeeze, title_key

#: Headings known by name, of papers and of reports; words that a heading in title case holds, and small words in it.
PAPER_HEADINGS = ["abstract", "introduction", "background", "motivation", "related work", "related works", "literature review", "method", "methods", "methodology", "approach", "proposed approach", "system overview", "architecture", "model", "problem formulation", "problem statement", "experimental setup", "experiment setup", "experiments", "experiment", "evaluation", "results", "results and discussion", "discussion", "limitations", "conclusion", "conclusions", "future work", "summary", "acknowledgment", "acknowledgments", "acknowledgement", "acknowledgements", "references", "bibliography"]
REPORT_HEADINGS = ["abstract", "introduction", "background", "related work", "related works", "motivation", "overview", "system overview", "architecture", "system architecture", "method", "methods", "methodology", "approach", "proposed approach", "algorithm", "algorithms", "implementation", "design", "system design", "problem formulation", "experimental setup", "experiment", "experiments", "evaluation", "analysis", "results", "discussion", "results and discussion", "limitations", "conclusion", "conclusions", "concluding remarks", "summary", "future work", "references", "reference", "bibliography", "acknowledgment", "acknowledgments", "acknowledgement", "acknowledgements", "appendix", "appendices"]
HEADING_TERMS = ["architecture", "approach", "analysis", "background", "conclusion", "conclusions", "design", "discussion", "evaluation", "experiment", "experiments", "implementation", "introduction", "method", "methods", "methodology", "model", "navigation", "overview", "planning", "results", "system", "systems", "testing", "validation", "autonomy", "operations", "simulation", "performance", "algorithm"]
SMALL_WORDS = ["a", "an", "and", "as", "at", "by", "for", "from", "in", "of", "on", "or", "the", "to", "with"]
MATH_SIGNS = "=±∑∫≤≥≈→λμσΔθ"
LONG_PARAGRAPH = 500
BODY = "Document Body"


def page_lines(df: DataFrame, ident: str, text: str) -> DataFrame:
    """(ident, page, n, line): cleaned lines; page and n count from 0."""
    pages = df.where(F.length(text) > 0).select(ident, F.posexplode(F.split(text, "\f")).alias("page", "_p"))
    return pages.select(ident, "page", F.posexplode(F.split("_p", "\r\n|\n|\r")).alias("n", "_l")).select(ident, "page", "n", clean_line(F.col("_l")).alias("line"))


def repeated_lines(lines: DataFrame, ident: str) -> DataFrame:
    """(ident, line): lines of at most 100 signs on three pages or more, and on half of the document's pages."""
    pages = lines.groupBy(ident).agg((F.max("page") + 1).alias("pages"))
    short = lines.where(F.length("line").between(1, 100)).select(ident, "page", "line").distinct()
    seen = short.groupBy(ident, "line").agg(F.count("*").alias("k")).where("k >= 3")
    return seen.join(pages, ident).where("k >= greatest(3, pages div 2)").select(ident, "line")


def words(c: Column) -> Column:
    return F.regexp_count(c, F.lit(r"\S+"))


def _caps(c: Column, least: int, share: float, most: int, count: Column) -> Column:
    letters, upper = F.regexp_count(c, F.lit(r"\p{L}")), F.regexp_count(c, F.lit(r"\p{Lu}"))
    return (letters >= least) & (upper >= share * letters) & (count <= most)


def is_paper_heading(line: Column) -> Column:
    """Short lines that are known by name, numbered and capitalised, roman and capitalised, or in capitals."""
    name = F.regexp_replace(F.lower(F.regexp_replace(line, r"(?i)^\s*(?:\d+(?:\.\d+)*|[ivxlc]+)[\.\s:-]*", "")), r"^\s+|[:.]+$|\s+$", "")
    numbered = line.rlike(r"^\d+(?:\.\d+)*\s*[.\-:]?\s+[A-Z]") | line.rlike(r"^[IVXLC]+\.\s+[A-Z]")
    return (F.length(line) > 0) & (F.length(line) <= 140) & (words(line) <= 18) & (name.isin(PAPER_HEADINGS) | numbered | _caps(line, 4, 1.0, 12, words(line)))


def paper_level(line: Column) -> Column:
    number = F.regexp_extract(line, r"^(\d+(?:\.\d+)*)", 1)
    return F.when(number == "", 1).otherwise(F.least(F.lit(3), F.length(number) - F.length(F.replace(number, F.lit("."), F.lit(""))) + 1))


def is_noise(line: Column) -> Column:
    """Lone page numbers and rules."""
    return line.rlike(r"^\d{1,4}$") | line.rlike(r"(?i)^page\s+\d+\s*(?:of\s+\d+)?$") | line.rlike(r"^[-_=*•·.]{3,}$")


def unnumbered(line: Column) -> Column:
    for mark in (r"^\d+(?:\.\d+)*[\.\)]?\s+", r"^[IVXLC]+\.\s+", r"^[A-Z]\.\s+"):
        line = F.regexp_replace(line, mark, "")
    return F.trim(line)


def is_report_heading(line: Column) -> Column:
    """Known by name, numbered without being a sentence, nearly all in capitals, or in title case with a heading's term."""
    bare = unnumbered(line)
    known = F.regexp_replace(F.lower(bare), r"^[ :.\-]+|[ :.\-]+$", "").isin(REPORT_HEADINGS)
    sentence = (F.length(bare) > 80) & bare.rlike(r"[.?!;]$")
    numbered = F.length(line).between(4, 140) & (line.rlike(r"^\d+(?:\.\d+)*[.)]?\s+.{2,120}$") | line.rlike(r"^[IVXLC]+\.\s+.{2,120}$") | line.rlike(r"^[A-Z]\.\s+.{2,120}$")) & ~sentence & (F.regexp_count(bare, F.lit(r"\p{L}")) >= 2)
    caps = F.length(line).between(3, 120) & ~line.rlike(r"(?i)@|https?://") & ~line.rlike(r"[.;,]$") & _caps(line, 3, 0.9, 14, F.regexp_count(line, F.lit("[A-Za-z]+")))
    w = F.regexp_extract_all(line, F.lit("[A-Za-z][A-Za-z0-9/-]*"), F.lit(0))
    meant = F.filter(w, lambda x: ~F.lower(x).isin(SMALL_WORDS))
    upper = F.size(F.filter(meant, lambda x: x.rlike("^[A-Z]")))
    cased = F.length(line).between(5, 80) & ~line.rlike(r"[.,;:?!]$") & F.size(w).between(2, 8) & (F.size(meant) > 0) & (upper >= 0.8 * F.size(meant)) & F.exists(w, lambda x: F.lower(x).isin(HEADING_TERMS))
    return (F.length(line) > 0) & (known | numbered | caps | cased)


def report_level(line: Column) -> Column:
    number = F.regexp_extract(line, r"^(\d+(?:\.\d+)*)", 1)
    return F.when(number == "", 2).otherwise(F.least(F.lit(6), F.length(number) - F.length(F.replace(number, F.lit("."), F.lit(""))) + 2))


def is_caption(line: Column) -> Column:
    return line.rlike(r"(?i)^(?:fig(?:ure)?\.?|table)\s*[A-Za-z0-9\-]+[\s.:]")


def is_list_item(line: Column) -> Column:
    return line.rlike(r"(?i)^(?:[-•*]|\([a-z0-9]+\))\s+")


def is_equation(line: Column) -> Column:
    """A short line with a sign of mathematics and few long words."""
    return F.length(line).between(3, 250) & (words(line) <= 25) & line.rlike(f"[{MATH_SIGNS}]") & (F.regexp_count(line, F.lit(r"\b[A-Za-z]{4,}\b")) <= 5)


def report_class(line: Column) -> Column:
    """What a line of a report is by itself."""
    return (
        F.when(F.length(line) == 0, "blank")
        .when(is_noise(line), "noise")
        .when(is_report_heading(line), "heading")
        .when(is_caption(line), "figure_caption")
        .when(is_list_item(line), "list_item")
        .when(is_equation(line), "equation")
        .otherwise("text")
    )


def _numbered(lines: DataFrame, ident: str) -> Window:
    return Window.partitionBy(ident).orderBy("page", "n")


def page_sections(df: DataFrame, ident: str, text: str) -> DataFrame:
    """(ident, section, heading, level, pos, type, text): the paragraphs of papers given as pages.

    Running heads, page numbers and arXiv marks go; a paragraph ends at an empty line, a heading, the end of its page,
    or the end of a sentence once it has LONG_PARAGRAPH signs. What stands before the first heading is BODY."""
    lines = page_lines(df, ident, text)
    heads = repeated_lines(lines, ident)
    kept = lines.join(heads, [ident, "line"], "left_anti").where(~F.col("line").rlike(r"(?i)^(?:page\s*)?\d+$") & ~F.col("line").rlike(r"(?i)^arXiv:\S+$"))
    w = _numbered(kept, ident)
    x = kept.withColumn("head", is_paper_heading(F.col("line")))
    before = F.lag("page").over(w)
    x = x.withColumn("stop", F.col("head") | (F.col("line") == "") | F.coalesce(before != F.col("page"), F.lit(False)))
    x = x.withColumns({"section": F.sum(F.col("head").cast("int")).over(w), "part": F.sum(F.col("stop").cast("int")).over(w)})
    title = x.where("head").select(ident, "section", F.col("line").alias("heading"), paper_level(F.col("line")).alias("level"))
    body = x.where("not head and line <> ''").groupBy(ident, "section", "part").agg(F.array_sort(F.collect_list(F.struct("page", "n", "line"))).alias("l"))

    def step(acc, y):
        now = F.when(acc["now"] == "", y["line"]).otherwise(F.concat(acc["now"], F.lit(" "), y["line"]))
        full = y["line"].rlike("[.!?]$") & (F.length(now) >= LONG_PARAGRAPH)
        return F.struct(F.when(full, F.concat(acc["done"], F.array(now))).otherwise(acc["done"]).alias("done"), F.when(full, F.lit("")).otherwise(now).alias("now"))

    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("now"))
    parts = F.aggregate("l", start, step, lambda a: F.filter(F.concat(a["done"], F.array(a["now"])), lambda p: F.length(p) > 0))
    body = body.select(ident, "section", "part", F.posexplode(parts).alias("k", "text")).withColumn("text", squeeze(F.col("text")))
    kind = F.when(F.col("text").rlike(r"(?i)^(?:fig\.?|figure)\s*\d+"), "figure_caption").when(F.col("text").rlike(r"(?i)^table\s*[ivxlc\d]+"), "table_caption").otherwise("paragraph")
    pos = F.row_number().over(Window.partitionBy(ident).orderBy("section", "part", "k")) - 1
    out = body.withColumn("pos", pos).join(title, [ident, "section"], "left")
    return out.select(ident, "section", F.coalesce("heading", F.lit(BODY)).alias("heading"), F.coalesce("level", F.lit(1)).alias("level"), "pos", kind.alias("type"), "text")


def report_blocks(df: DataFrame, ident: str, text: str, title: str) -> DataFrame:
    """(ident, pos, type, level, text, in_bibliography): blocks of technical reports given as lines.

    Noise and the first line that repeats the title go; headings, captions, list items and formulas are blocks of their own;
    lines of text are joined up to the next of these or an empty line, and words broken over lines are put together."""
    lines = page_lines(df, ident, text).where(~is_noise(F.col("line")))
    key = title_key(F.col("line"))
    titles = df.select(ident, title_key(F.col(title)).alias("_title"))
    first = lines.select(ident, "page", "n", key.alias("_key")).join(titles, ident).where("_key = _title and _title <> ''").groupBy(ident).agg(F.min(F.struct("page", "n")).alias("_at"))
    x = lines.join(first, ident, "left").where(F.col("_at").isNull() | ~(F.struct("page", "n") == F.col("_at"))).drop("_at")
    w = _numbered(x, ident)
    x = x.withColumn("kind", report_class(F.col("line")))
    x = x.withColumn("part", F.sum((~((F.col("kind") == "text") & (F.coalesce(F.lag("kind").over(w), F.lit("")) == "text"))).cast("int")).over(w))
    g = x.where("kind <> 'blank'").groupBy(ident, "part", "kind").agg(F.array_sort(F.collect_list(F.struct("page", "n", "line"))).alias("l"))
    t = squeeze(dehyphenated(F.array_join(F.transform("l", lambda y: y["line"]), " ")))
    g = g.select(ident, "part", "kind", F.when(F.col("kind") == "text", t).otherwise(F.element_at("l", 1)["line"]).alias("t")).where(F.length("t") > 0)
    c = F.col("t")
    kind = F.when(F.col("kind") != "text", F.col("kind")).when(is_caption(c), "figure_caption").when(is_list_item(c), "list_item").when(is_equation(c), "equation").otherwise("paragraph")
    g = g.withColumn("type", kind)
    pos = F.row_number().over(Window.partitionBy(ident).orderBy("part")) - 1
    bare = F.when(F.col("type") == "list_item", F.trim(F.regexp_replace(c, r"(?i)^(?:[-•*]|\([a-z0-9]+\))\s+", ""))).otherwise(c)
    return g.select(ident, pos.alias("pos"), "type", F.when(F.col("type") == "heading", report_level(c)).otherwise(0).alias("level"), bare.alias("text"), F.lit(False).alias("in_bibliography"))


def page_text(df: DataFrame, ident: str, text: str) -> DataFrame:
    """(ident, text): pages without running heads and page numbers, put together with an empty line between pages."""
    lines = page_lines(df, ident, text)
    kept = lines.join(repeated_lines(lines, ident), [ident, "line"], "left_anti").where(~is_noise(F.col("line")) | (F.col("line") == ""))
    page = kept.groupBy(ident, "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "line"))), lambda y: y["line"]), "\n").alias("t"))
    page = page.withColumn("t", F.regexp_replace(F.regexp_replace("t", r"(?<=\w)-\s*\n\s*(?=\w)", ""), r"^\s+|\s+$", "")).where(F.length("t") > 0)
    return page.groupBy(ident).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", "t"))), lambda y: y["t"]), "\n\n").alias("text"))
