"""Parsing plans: normalisations, classes of lines, payload checks, and documents of all formats to clean text."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from ..functions import quality as Q
from ..functions import text as N
from ..operators import pages as P
from ..operators.cleaning import clean, corpus_text, raw_rendered
from ..operators.html import html_heads
from ..operators.parsing import block_stats, detected, parse_faults, parsed
from ..operators.tex import plain_tex, sections
from ..sources.tables import documents
from ..work import Work
from .registry import query
from .texts import squeeze_sql

ENDS = r"'^[\s\x{000B}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+|[\s\x{000B}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+$'"


def _sub(x: str, *pairs) -> str:
    for a, b in pairs:
        x = f"regexp_replace({x}, '{a}', {b}, 'g')"
    return x


def _stripped(x: str) -> str:
    return f"regexp_replace({x}, {ENDS}, '', 'g')"


NL = "chr(10)"
PAPER_SQL = _stripped(_sub("nfc_normalize(raw_content)", (r"\x00", "''"), (r"[ \t\x{00A0}\x{2009}\x{202F}]+", "' '")))
_LIG = (("ﬁ", "'fi'"), ("ﬂ", "'fl'"))
_FIRST = ((r"[\x00\x{00AD}\x{FEFF}]", "''"), (r"\r\n?", NL))
REPORT_SQL = _stripped(_sub("nfc_normalize(raw_content)", *_FIRST, *_LIG, (r"[ \t\x{00A0}\x{2009}\x{202F}]+", "' '"), (r"\s+([,.;:!?])", r"'\1'"), (r"\(\s+", "'('"), (r"\s+\)", "')'"), (r"\n{3,}", f"{NL} || {NL}")))
PARSER_SQL = _stripped(_sub("nfc_normalize(raw_content)", *_FIRST, *_LIG, (r"\f", f"{NL} || {NL}"), (r"[\t\x{00A0}]", "' '"), (" {2,}", "' '"), (r"\n{4,}", f"{NL} || {NL} || {NL}")))
PAYLOAD_SQL = _stripped(_sub("raw_content", (r"\x00", "''"), (r"\r\n?", NL), (r"[ \t]+", "' '"), (r"\n{4,}", f"{NL} || {NL} || {NL}")))
CHUNKER_SQL = _stripped(_sub("raw_content", (r"\x00", "''"), (r"\r\n?", NL), (r"[ \t\x{00A0}]+", "' '"), (r"\n{3,}", f"{NL} || {NL}")))


for _name, _sql, _f in (("norm_paper", PAPER_SQL, N.paper_normal), ("norm_report", REPORT_SQL, N.report_normal), ("norm_parser", PARSER_SQL, N.parser_normal), ("norm_payload", PAYLOAD_SQL, N.payload_normal), ("norm_chunker", CHUNKER_SQL, N.chunker_normal)):
    query(f"SELECT id, sha256({_sql}) AS h FROM core_documents WHERE raw_content IS NOT NULL", _name)(lambda spark, sf, f=_f: documents(spark, sf).where("raw_content is not null").select("id", F.sha2(f(F.col("raw_content")), 256).alias("h")))

RESIDUE_SQL = _sub("replace(clean_content, '¶', '')", (r"(?i)\b\d{3,4}-\d{3,4}-\d{3,4}-\d/\d{2}/\$[\d.]+\s*©\s*\d{4}\s*IEEE\b", "' '"), (r"(?i)©\s*\d{4}\s*IEEE\.?", "' '"), (r"(?i)\bProject page\s*:\s*\S+", "' '"), (r"(?i)\bThanks\s*:\s*", "''"), (r"[ \t]+", "' '"))


@query(f"SELECT id, sha256(trim({RESIDUE_SQL.replace('clean_content', 'x')}, ' ')) AS h FROM (SELECT id, clean_content || ' ¶ 978-1-4577-0556-4/12/$26.00 ©2012 IEEE Project page: https://a.example/b Thanks: all' AS x FROM core_documents WHERE clean_content IS NOT NULL)")
def residue_removal(spark, sf):
    """Texts with a tail of residues: the tail goes, the text stays."""
    x = F.concat("clean_content", F.lit(" ¶ 978-1-4577-0556-4/12/$26.00 ©2012 IEEE Project page: https://a.example/b Thanks: all"))
    return documents(spark, sf).where("clean_content is not null").select("id", F.sha2(N.unresidued(x), 256).alias("h"))


QUOTED = "CASE id % 3 WHEN 0 THEN ' “' || title || ' ” ' WHEN 1 THEN '\"' || title || '\"' ELSE title END"


@query(f"SELECT id, CASE WHEN regexp_full_match(t, '(?s)\".*\"|''.*''|“.*”|‘.*’') AND length(t) > 1 THEN trim(substr(t, 2, length(t) - 2), ' ') ELSE t END AS title FROM (SELECT id, trim({QUOTED}, ' ') AS t FROM core_documents WHERE title IS NOT NULL)")
def unquoted_titles(spark, sf):
    return documents(spark, sf).where("title is not null").select("id", N.unquoted(F.expr(QUOTED)).alias("title"))


@query(r"SELECT id, sha256(regexp_replace(raw_content, '([a-z])-\s+([a-z])', '\1\2', 'g')) AS h FROM core_documents WHERE raw_content IS NOT NULL")
def dehyphenated_text(spark, sf):
    return documents(spark, sf).where("raw_content is not null").select("id", F.sha2(N.dehyphenated(F.col("raw_content")), 256).alias("h"))


@query("SELECT id, sha256(left(clean_content, 800)) AS h, CASE WHEN length(clean_content) > 120 THEN left(clean_content, 117) || '...' ELSE clean_content END AS preview FROM core_documents WHERE clean_content IS NOT NULL")
def previews(spark, sf):
    return documents(spark, sf).where("clean_content is not null").select("id", F.sha2(F.left("clean_content", F.lit(800)), 256).alias("h"), N.preview(F.col("clean_content"), 120).alias("preview"))


@query("SELECT id, CASE WHEN n < 1024 THEN printf('%.2f', n) || ' B' WHEN n < 1048576 THEN printf('%.2f', n / 1024) || ' KB' ELSE printf('%.2f', n / 1048576) || ' MB' END AS size FROM (SELECT id, strlen(raw_content)::DOUBLE AS n FROM core_documents WHERE raw_content IS NOT NULL)")
def content_sizes(spark, sf):
    return documents(spark, sf).where("raw_content is not null").select("id", N.readable_bytes(F.octet_length("raw_content")).alias("size"))


LETTERS = "length(regexp_replace({0}, '[^\\p{{L}}]+', '', 'g'))"


@query(f"SELECT id, round(coalesce({LETTERS.format('raw_content')}::DOUBLE / nullif(length(raw_content), 0), 0), 4) AS whole, round(coalesce(length(regexp_replace(lower(raw_content), '[^a-z]+', '', 'g'))::DOUBLE / nullif(length(regexp_replace(raw_content, '\\s+', '', 'g')), 0), 0), 4) AS ascii FROM core_documents WHERE raw_content IS NOT NULL")
def alpha_variants(spark, sf):
    t = F.col("raw_content")
    return documents(spark, sf).where("raw_content is not null").select("id", F.round(Q.whole_alpha_ratio(t), 4).alias("whole"), F.round(Q.ascii_alpha_ratio(t), 4).alias("ascii"))


@query(
    f"""SELECT id, array_to_string(list_filter([CASE WHEN length(t) < 5000 THEN 'too_few_chars' END, CASE WHEN len(regexp_extract_all(t, '\\S+')) < 800 THEN 'too_few_words' END,
    CASE WHEN coalesce({LETTERS.format('t')}::DOUBLE / nullif(length(t), 0), 0) < 0.35 THEN 'low_alpha' END], lambda x: x IS NOT NULL), ',') AS reasons FROM (SELECT id, coalesce(raw_content, '') AS t FROM core_documents)"""
)
def docx_gate(spark, sf):
    return documents(spark, sf).select("id", F.array_join(Q.docx_reasons(F.col("raw_content")), ",").alias("reasons"))


@query(
    f"""SELECT id, coalesce(strlen(raw_content) >= 2000 AND regexp_matches(h, '<html|<!doctype html|<body|<article') AND NOT regexp_matches(h, '{Q.ERROR_PAGE}'), false) AS html,
    coalesce(length(trim(raw_content, ' ')) >= 1500 AND {LETTERS.format('raw_content')}::DOUBLE / nullif(length(raw_content), 0) >= 0.35 AND NOT regexp_matches(h, '<html|<!doctype html|<body') AND NOT regexp_matches(h, '{Q.ERROR_PAGE}'), false) AS text
    FROM (SELECT id, raw_content, lower(left(raw_content, 5000)) AS h FROM core_documents)"""
)
def payload_checks(spark, sf):
    c = F.col("raw_content")
    return documents(spark, sf).select("id", Q.html_payload(c).alias("html"), Q.text_payload(c).alias("text"))


CLEAN_LINE = squeeze_sql(_sub("l", (r"[\x00\x{00AD}\x{FEFF}]", "''"), ("ﬀ", "'ff'"), ("ﬁ", "'fi'"), ("ﬂ", "'fl'"), ("ﬃ", "'ffi'"), ("ﬄ", "'ffl'")))
LINES_SQL = f"""(SELECT id, page, {CLEAN_LINE} AS line FROM (SELECT id, page, unnest(regexp_split_to_array(p, '\\r\\n|\\n|\\r')) AS l FROM
    (SELECT id, unnest(range(0, len(ps))) AS page, unnest(ps) AS p FROM (SELECT id, string_split(raw_content, chr(12)) AS ps FROM core_documents WHERE length(raw_content) > 0))))"""
_IN = lambda xs: "(" + ", ".join(f"'{x}'" for x in xs) + ")"
N_WORDS = "len(regexp_extract_all(line, '\\S+'))"
PAPER_HEAD = f"""(length(line) > 0 AND length(line) <= 140 AND {N_WORDS} <= 18 AND (regexp_replace(lower(regexp_replace(line, '(?i)^\\s*(?:[0-9]+(?:\\.[0-9]+)*|[ivxlc]+)[\\.\\s:-]*', '')), '^\\s+|[:.]+$|\\s+$', '', 'g') IN {_IN(P.PAPER_HEADINGS)}
    OR regexp_matches(line, '^[0-9]+(?:\\.[0-9]+)*\\s*[.\\-:]?\\s+[A-Z]') OR regexp_matches(line, '^[IVXLC]+\\.\\s+[A-Z]')
    OR (len(regexp_extract_all(line, '\\p{{L}}')) >= 4 AND len(regexp_extract_all(line, '\\p{{Lu}}')) >= len(regexp_extract_all(line, '\\p{{L}}')) AND {N_WORDS} <= 12)))"""


@query(f"SELECT id, line, count(*) AS n FROM {LINES_SQL} WHERE {PAPER_HEAD} GROUP BY ALL")
def paper_headings(spark, sf):
    """Lines that look like the headings of a paper."""
    x = P.page_lines(documents(spark, sf).select("id", "raw_content"), "id", "raw_content")
    return x.where(P.is_paper_heading(F.col("line"))).groupBy("id", "line").agg(F.count("*").alias("n"))


BARE = "trim(regexp_replace(regexp_replace(regexp_replace(line, '^[0-9]+(?:\\.[0-9]+)*[\\.\\)]?\\s+', ''), '^[IVXLC]+\\.\\s+', ''), '^[A-Z]\\.\\s+', ''), ' ')"
REPORT_CLASS = f"""CASE WHEN length(line) = 0 THEN 'blank' WHEN regexp_matches(line, '^[0-9]{{1,4}}$') OR regexp_matches(line, '(?i)^page\\s+[0-9]+\\s*(?:of\\s+[0-9]+)?$') OR regexp_matches(line, '^[-_=*•·.]{{3,}}$') THEN 'noise'
    WHEN regexp_replace(lower(bare), '^[ :.\\-]+|[ :.\\-]+$', '', 'g') IN {_IN(P.REPORT_HEADINGS)}
      OR (length(line) BETWEEN 4 AND 140 AND (regexp_matches(line, '^[0-9]+(?:\\.[0-9]+)*[.)]?\\s+.{{2,120}}$') OR regexp_matches(line, '^[IVXLC]+\\.\\s+.{{2,120}}$') OR regexp_matches(line, '^[A-Z]\\.\\s+.{{2,120}}$')) AND NOT (length(bare) > 80 AND regexp_matches(bare, '[.?!;]$')) AND len(regexp_extract_all(bare, '\\p{{L}}')) >= 2)
      OR (length(line) BETWEEN 3 AND 120 AND NOT regexp_matches(line, '(?i)@|https?://') AND NOT regexp_matches(line, '[.;,]$') AND letters >= 3 AND upper >= 0.9 * letters AND len(regexp_extract_all(line, '[A-Za-z]+')) <= 14)
      OR (length(line) BETWEEN 5 AND 80 AND NOT regexp_matches(line, '[.,;:?!]$') AND len(w) BETWEEN 2 AND 8 AND len(meant) > 0 AND len(list_filter(meant, lambda x: regexp_matches(x, '^[A-Z]'))) >= 0.8 * len(meant) AND len(list_filter(w, lambda x: lower(x) IN {_IN(P.HEADING_TERMS)})) > 0) THEN 'heading'
    WHEN regexp_matches(line, '(?i)^(?:fig(?:ure)?\\.?|table)\\s*[A-Za-z0-9\\-]+[\\s.:]') THEN 'figure_caption' WHEN regexp_matches(line, '(?i)^(?:[-•*]|\\([a-z0-9]+\\))\\s+') THEN 'list_item'
    WHEN length(line) BETWEEN 3 AND 250 AND {N_WORDS} <= 25 AND regexp_matches(line, '[{P.MATH_SIGNS}]') AND len(regexp_extract_all(line, '\\b[A-Za-z]{{4,}}\\b')) <= 5 THEN 'equation' ELSE 'text' END"""


@query(
    f"""SELECT id, class, count(*) AS n FROM (SELECT id, {REPORT_CLASS} AS class FROM (SELECT *, list_filter(w, lambda x: NOT lower(x) IN {_IN(P.SMALL_WORDS)}) AS meant FROM
    (SELECT id, line, {BARE} AS bare, len(regexp_extract_all(line, '\\p{{L}}')) AS letters, len(regexp_extract_all(line, '\\p{{Lu}}')) AS upper, regexp_extract_all(line, '[A-Za-z][A-Za-z0-9/-]*') AS w FROM {LINES_SQL}))) GROUP BY ALL"""
)
def report_line_classes(spark, sf):
    """Every line of every text by its class: blank, noise, heading, caption, list item, equation, text."""
    x = P.page_lines(documents(spark, sf).select("id", "raw_content"), "id", "raw_content")
    return x.select("id", P.report_class(F.col("line")).alias("class")).groupBy("id", "class").agg(F.count("*").alias("n"))


@query(f"SELECT id, line FROM (SELECT l.id, line, count(DISTINCT page) AS k, any_value(pages) AS pages FROM {LINES_SQL} l JOIN (SELECT id, len(string_split(raw_content, chr(12))) AS pages FROM core_documents) p USING (id) WHERE length(line) BETWEEN 1 AND 100 GROUP BY ALL) WHERE k >= greatest(3, pages // 2)")
def repeated_page_lines(spark, sf):
    """Running heads: short lines on three pages or more and on half of the pages."""
    return P.repeated_lines(P.page_lines(documents(spark, sf).select("id", "raw_content"), "id", "raw_content"), "id")


@query(
    r"""SELECT coalesce(CASE WHEN length(trim(raw_content, ' ')) IS NULL OR length(trim(raw_content, ' ')) = 0 THEN NULL WHEN regexp_matches(raw_content, '(?i)</(?:p|h[1-6]|li|div|table)>|<(?:p|h[1-6]|html|body)[ >]') THEN 'html'
    WHEN regexp_matches(raw_content, '\\(?:sub)*section\*?[\[{]|\\begin\{|\\documentclass') THEN 'tex' WHEN contains(raw_content, chr(12)) THEN 'pages' ELSE 'text' END, 'none') AS format, count(*) AS n FROM core_documents GROUP BY 1"""
)
def format_counts(spark, sf):
    return documents(spark, sf).groupBy(F.coalesce(detected(F.col("raw_content")), F.lit("none")).alias("format")).agg(F.count("*").alias("n"))


def _blocks(spark, sf):
    """The blocks of all documents, written once: the plans below read them more than once."""
    return Work(spark, "blocks").table(parsed(documents(spark, sf).select("id", "raw_content", "title"), "id", "raw_content", "title"), "blocks")


@query()
def document_blocks(spark, sf):
    """Blocks of each document by type, whatever its format."""
    return block_stats(_blocks(spark, sf), "id")


@query()
def parse_violations(spark, sf):
    return parse_faults(documents(spark, sf).select("id"), _blocks(spark, sf), "id")


@query()
def cleaned_documents(spark, sf):
    """Clean text of every document: its hash, blocks before and after, and what was cut, papers by their rules, reports by theirs."""
    b = _blocks(spark, sf).join(documents(spark, sf).select("id", "source"), "id")
    paper = clean(b.where("not source <=> 'ntrs'").drop("source"), "id", False)
    return paper.unionByName(clean(b.where("source <=> 'ntrs'").drop("source"), "id", True)).drop("clean_content")


@query()
def raw_documents(spark, sf):
    """Parsed documents rendered as Markdown under their stored title and abstract."""
    heads = documents(spark, sf).select("id", "title", "abstract")
    return raw_rendered(_blocks(spark, sf), heads, "id").select("id", F.length("raw_content").alias("chars"), F.sha2("raw_content", 256).alias("h"))


@query()
def html_front(spark, sf):
    """Titles and abstracts told by the HTML sources themselves."""
    d = documents(spark, sf).where(detected(F.col("raw_content")) == "html").select("id", "raw_content")
    return html_heads(d, "id", "raw_content")


@query()
def tex_outlines(spark, sf):
    """Sections of the TeX sources: heading, level, and the length of the text."""
    def run(batches):
        for b in batches:
            rows = [(i, k, h, lv, sum(len(x) for _, x in p)) for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for k, (h, lv, p) in enumerate(sections(t))]
            cols = list(zip(*rows)) if rows else [[]] * 5
            types = (pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["id", "section", "heading", "level", "chars"])

    d = documents(spark, sf).where(detected(F.col("raw_content")) == "tex").select("id", "raw_content")
    return d.mapInArrow(run, "id bigint, section int, heading string, level int, chars bigint")


@query()
def tex_text(spark, sf):
    """Running text of the TeX sources."""
    return documents(spark, sf).where(detected(F.col("raw_content")) == "tex").select("id", F.sha2(plain_tex("raw_content"), 256).alias("h"))


@query()
def paged_sections(spark, sf):
    d = documents(spark, sf).where(F.contains("raw_content", F.lit("\f"))).select("id", "raw_content")
    return P.page_sections(d, "id", "raw_content").select("id", "section", "heading", "level", "pos", "type", F.length("text").alias("chars"))


@query()
def paged_text(spark, sf):
    """Pages put together without running heads and page numbers."""
    d = documents(spark, sf).where(F.contains("raw_content", F.lit("\f"))).select("id", "raw_content")
    return P.page_text(d, "id", "raw_content").select("id", F.sha2("text", 256).alias("h"))


@query()
def corpus_lines(spark, sf):
    """Texts of the corpus without garbage lines, and how many were dropped."""
    return corpus_text(documents(spark, sf).select("id", "raw_content"), "id", "raw_content").select("id", "dropped", F.sha2("text", 256).alias("h"))
