"""Text normalisation as columns: everything stays in the JVM."""

from __future__ import annotations

from unicodedata import combining, is_normalized, normalize

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

WHITE = r"\s\u000b\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPACE = f"[{WHITE}]+"
#: Ligatures and their letters.
LIGATURES = [("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬃ", "ffi"), ("ﬄ", "ffl")]


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(c, rf"^[{WHITE}]+|[{WHITE}]+$", "")


def squeeze(c: Column) -> Column:
    """Every run of white space is one blank, none at the ends."""
    return F.trim(F.regexp_replace(c, SPACE, " "))


def lines_normal(c: Column) -> Column:
    """Line ends LF, no-break and thin spaces blank, no NUL, byte order mark or soft hyphen, ligatures spelled
    out, blanks squeezed, at most one empty line."""
    x = F.regexp_replace(c, "\r\n?", "\n")
    x = F.regexp_replace(x, "[\x00\u00ad\ufeff]", "")
    for a, b in LIGATURES:
        x = F.replace(x, F.lit(a), F.lit(b))
    x = F.regexp_replace(x, "[ \t\u00a0\u2009\u202f]+", " ")
    x = F.regexp_replace(x, "\n{3,}", "\n\n")
    return F.regexp_replace(x, r"^\s+|\s+$", "")


@F.pandas_udf(StringType())
def nfc(c: pd.Series) -> pd.Series:
    """Composed characters (NFC): Spark has no function for it, so texts go through Arrow; most need no change."""
    return c.map(lambda t: t if t is None or t.isascii() or is_normalized("NFC", t) else normalize("NFC", t), na_action="ignore")


@F.pandas_udf(StringType())
def unaccented(c: pd.Series) -> pd.Series:
    """Without accents: decomposed (NFKD), combining marks left out."""
    return c.map(lambda t: t if t is None or t.isascii() else "".join(x for x in normalize("NFKD", t) if not combining(x)), na_action="ignore")


def _ends(c: Column) -> Column:
    return F.regexp_replace(c, rf"^[{WHITE}]+|[{WHITE}]+$", "")


def paper_normal(c: Column) -> Column:
    """Of papers: NFC, no NUL, no-break and thin spaces blank, blanks and tabs squeezed."""
    x = F.regexp_replace(nfc(c), "\x00", "")
    return _ends(F.regexp_replace(x, "[ \t\u00a0\u2009\u202f]+", " "))


def report_normal(c: Column) -> Column:
    """Of reports: as of papers, and line ends LF, no byte order mark or soft hyphen, ligatures spelled out, no blank before
    closing or after opening signs, at most one empty line."""
    x = F.regexp_replace(F.regexp_replace(nfc(c), "[\x00\u00ad\ufeff]", ""), "\r\n?", "\n")
    for a, b in LIGATURES[1:3]:
        x = F.replace(x, F.lit(a), F.lit(b))
    x = F.regexp_replace(x, "[ \t\u00a0\u2009\u202f]+", " ")
    x = F.regexp_replace(F.regexp_replace(F.regexp_replace(x, r"\s+([,.;:!?])", "$1"), r"\(\s+", "("), r"\s+\)", ")")
    return _ends(F.regexp_replace(x, "\n{3,}", "\n\n"))


def parser_normal(c: Column) -> Column:
    """Of report files before they are parsed: form feeds are empty lines, at most two empty lines."""
    x = F.regexp_replace(F.regexp_replace(nfc(c), "[\x00\u00ad\ufeff]", ""), "\r\n?", "\n")
    for a, b in LIGATURES[1:3]:
        x = F.replace(x, F.lit(a), F.lit(b))
    x = F.regexp_replace(F.replace(x, F.lit("\f"), F.lit("\n\n")), "[\t\u00a0]", " ")
    return _ends(F.regexp_replace(F.regexp_replace(x, " {2,}", " "), "\n{4,}", "\n\n\n"))


def payload_normal(c: Column) -> Column:
    """Of downloaded text: no NUL, line ends LF, blanks and tabs squeezed, at most two empty lines."""
    x = F.regexp_replace(F.regexp_replace(c, "\x00", ""), "\r\n?", "\n")
    return _ends(F.regexp_replace(F.regexp_replace(x, "[ \t]+", " "), "\n{4,}", "\n\n\n"))


def chunker_normal(c: Column) -> Column:
    """Before chunking: line ends LF, no NUL, no-break spaces blank, blanks and tabs squeezed, at most one empty line."""
    x = F.regexp_replace(F.regexp_replace(c, "\x00", ""), "\r\n?", "\n")
    return _ends(F.regexp_replace(F.regexp_replace(x, "[ \t\u00a0]+", " "), "\n{3,}", "\n\n"))


def clean_line(c: Column) -> Column:
    """A line of extracted text: ligatures spelled out, no soft hyphen, white space squeezed."""
    x = F.regexp_replace(c, "[\x00\u00ad\ufeff]", "")
    for a, b in LIGATURES:
        x = F.replace(x, F.lit(a), F.lit(b))
    return squeeze(x)


def unresidued(c: Column) -> Column:
    """Without pilcrows, copyright lines, project pages and the word Thanks before a colon."""
    x = F.replace(c, F.lit("¶"), F.lit(""))
    x = F.regexp_replace(x, r"(?i)\b\d{3,4}-\d{3,4}-\d{3,4}-\d/\d{2}/\$[\d.]+\s*©\s*\d{4}\s*IEEE\b", " ")
    x = F.regexp_replace(F.regexp_replace(x, r"(?i)©\s*\d{4}\s*IEEE\.?", " "), r"(?i)\bProject page\s*:\s*\S+", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(x, r"(?i)\bThanks\s*:\s*", ""), "[ \t]+", " "))


def title_key(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " "))


def heading_key(c: Column) -> Column:
    """Lower case, without marks and a leading number, roman number or letter that is set apart."""
    x = F.regexp_replace(F.lower(squeeze(c)), r"^#+\s*", "")
    x = F.regexp_replace(x, r"^(?:\d+(?:\.\d+)*|[ivxl]+|[a-z])[.)]?\s+", "")
    return F.regexp_replace(x, r"^[ .:\-]+|[ .:\-]+$", "")


def base_id(c: Column) -> Column:
    return F.regexp_replace(c, r"v\d+$", "")


def version(c: Column) -> Column:
    """Version number at the end of an id, 0 if there is none."""
    return F.coalesce(F.try_to_number(F.nullif(F.regexp_extract(c, r"v(\d+)$", 1), F.lit("")), F.lit("999999")).cast("int"), F.lit(0))


def unquoted(c: Column) -> Column:
    """Without one layer of paired quotes."""
    x = F.trim(c)
    inner = F.regexp_extract(x, "^(?:\"(.*)\"|'(.*)'|“(.*)”|‘(.*)’)$", 0)
    return F.when(inner != "", F.trim(F.substring(x, F.lit(2), F.length(x) - 2))).otherwise(x)


def caption_text(c: Column) -> Column:
    """Without the label of a figure or table; the label needs a number."""
    return F.regexp_replace(c, r"(?i)^(?:figure|fig\.|table)\s+(?:\d+|[ivxl]+)\s*[.:\-]?\s+", "")


def dehyphenated(c: Column) -> Column:
    return F.regexp_replace(c, r"(?<=[a-z])-\s+(?=[a-z])", "")


def first_date(c: Column) -> Column:
    return F.try_to_date(F.substring(c, 1, 10))


def extension(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.regexp_replace(url, r"[?#].*$", ""), r"\.([A-Za-z0-9]{1,5})$", 1))


def readable_bytes(n: Column) -> Column:
    k = F.when(n < 1024, 0).when(n < 1024**2, 1).when(n < 1024**3, 2).otherwise(3)
    value = n / F.element_at(F.array(F.lit(1.0), F.lit(1024.0), F.lit(1024.0**2), F.lit(1024.0**3)), (k + 1).cast("int"))
    return F.concat(F.format_string("%.2f", value), F.lit(" "), F.element_at(F.array(F.lit("B"), F.lit("KB"), F.lit("MB"), F.lit("GB")), (k + 1).cast("int")))


def preview(c: Column, size: int) -> Column:
    """The beginning of a text, with three dots where it goes on."""
    return F.when(F.length(c) > size, F.concat(F.left(c, F.lit(size - 3)), F.lit("..."))).otherwise(c)


def absolute_url(base: str, path: Column) -> Column:
    """A link on a site: absolute ones stay, the others are put after base; null and empty ones are null."""
    p = F.trim(path)
    return F.when(p.rlike("^https?://"), p).when(F.length(p) > 0, F.concat(F.lit(base.rstrip("/") + "/"), F.ltrim(p, F.lit("/"))))


def vector_literal(v: Column) -> Column:
    """A vector as the text [a,b,...]."""
    return F.concat(F.lit("["), F.array_join(F.transform(v, lambda x: x.cast("string")), ","), F.lit("]"))
