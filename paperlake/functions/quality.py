"""Text quality features and the passage gate, as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import squeeze

#: The gate's thresholds.
MIN_CHARS, MIN_WORDS, ALPHA_LOW, ALPHA_FAIR, WEIRD_HIGH, WEIRD_FAIR, ACCEPT = 160, 30, 0.50, 0.60, 0.12, 0.05, 0.70
DOC_CHARS, DOC_WORDS, DOC_ALPHA, DOC_SECTIONS = 5000, 800, 0.45, 2
#: Fixed value: what is neither space, letter, digit nor one of the usual signs.
USUAL = r"""[^\s\p{L}\p{N}.,;:!?%()\[\]{}+\-/='"’“”–—<>&]"""
PAPER_ALPHA, DOCX_ALPHA, TEXT_CHARS, TEXT_ALPHA = 0.45, 0.35, 1500, 0.35


def solid(c: Column) -> Column:
    return F.length(F.regexp_replace(c, r"\s+", ""))


def word_tokens(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(r"[A-Za-z]+(?:['’\-][A-Za-z]+)*"), 0)


def whole_alpha_ratio(c: Column) -> Column:
    """Letters among all signs, spaces too."""
    return F.coalesce(F.length(F.regexp_replace(c, r"[^\p{L}]+", "")) / F.nullif(F.length(c), F.lit(0)), F.lit(0.0))


def alpha_ratio(c: Column) -> Column:
    """Letters among what isn't space."""
    return F.coalesce(F.length(F.regexp_replace(c, r"[^\p{L}]+", "")) / F.nullif(solid(c), F.lit(0)), F.lit(0.0))


def ascii_alpha_ratio(c: Column) -> Column:
    return F.coalesce(F.length(F.regexp_replace(F.lower(c), "[^a-z]+", "")) / F.nullif(solid(c), F.lit(0)), F.lit(0.0))


def weird_ratio(c: Column) -> Column:
    """Unusual signs among what isn't space; 1 for empty text."""
    return F.coalesce(F.regexp_count(c, F.lit(USUAL)) / F.nullif(solid(c), F.lit(0)), F.lit(1.0))


def pieces(c: Column) -> Column:
    return F.filter(F.split(squeeze(c), " "), lambda x: x != "")


_ONE = "[^A-Za-z ]*[A-Za-z][^A-Za-z ]*"  # a piece with one letter


def single_letter_run(t: Column) -> Column:
    """Longest run of words of one letter in squeezed text."""
    padded = F.concat(F.lit(" "), t)
    runs = F.regexp_extract_all(padded, F.lit(f"(?: {_ONE}(?= |$))+"), F.lit(0))
    return F.coalesce(F.array_max(F.transform(runs, lambda x: F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))))), F.lit(0))


def single_letters(t: Column) -> Column:
    """Words of one letter other than a and i in squeezed text."""
    return F.regexp_count(F.concat(F.lit(" "), t), F.lit(" [^A-Za-z ]*[B-HJ-Zb-hj-z][^A-Za-z ]*(?= |$)"))


def split_words(c: Column) -> Column:
    return F.regexp_count(c, F.lit(r"\b[B-HJ-Z]\s+[a-z]{5,}\b"))


TRIPLE = "|".join(ch * 3 for ch in "abcdefghijklmnopqrstuvwxyz")
_MARKS = r"_\S*[A-Za-z]|[A-Za-z]\S*_|[¢�\x00]"
_RARE = rf"(?i:{TRIPLE})|(?i:[bcdfghjklmnpqrstvwxyz]{{7,}})"
BROKEN = rf"{_MARKS}|[A-Za-z]{{2,}}/[A-Za-z]{{2,}}|{_RARE}"
BROKEN_LINE = rf"{_MARKS}|{_RARE}"  # the corpus filter has no rule on slashes


#: What any broken piece has somewhere: one pass tells most texts from those whose pieces must be looked at.
_SUSPECT = r"[_¢�\x00]|[A-Za-z]{2}/[A-Za-z]{2}|(?i:([a-z])\1\1)|(?i:[bcdfghjklmnpqrstvwxyz]{7})"


def broken_tokens(t: Column, pattern: str = BROKEN) -> Column:
    """Pieces of squeezed text that look misread: counted by one pattern, without splitting."""
    return F.when(t.rlike(_SUSPECT), F.regexp_count(F.concat(F.lit(" "), t), F.lit(rf" (?=\S*(?:{pattern}))\S+"))).otherwise(F.when(t.isNotNull(), 0))


def gated(df: DataFrame, text: str) -> DataFrame:
    """df with accepted, score and reasons: hard rules reject, soft ones lower the score.

    Each step is a projection whose columns are read more than once by the next, so that none is computed twice.
    Null text is like empty text."""
    x = df.withColumn("_t", squeeze(F.coalesce(F.col(text), F.lit(""))))
    t = F.col("_t")
    x = x.withColumns({
        "_n": F.greatest(F.size(F.split(t, " ")), F.lit(1)),
        "_words": F.regexp_count(t, F.lit(r"[A-Za-z]+(?:['’\-][A-Za-z]+)*")),
        "_alpha": alpha_ratio(t), "_weird": weird_ratio(t), "_run": single_letter_run(t), "_single": single_letters(t), "_split": split_words(t), "_broken": broken_tokens(t),
    })
    alpha, weird, single, split, broken = (F.col(c) for c in ("_alpha", "_weird", "_single", "_split", "_broken"))
    share = single / F.col("_n")
    many = (single >= 6) & (share >= 0.05)
    hard = [
        ("too_short_chars", F.length(t) < MIN_CHARS),
        ("too_few_words", F.col("_words") < MIN_WORDS),
        ("low_alpha", alpha < ALPHA_LOW),
        ("letter_run", F.col("_run") >= 3),
        ("single_letters", many),
        ("split_words", split >= 3),
        ("broken_tokens", broken >= 2),
        ("weird_signs", weird > WEIRD_HIGH),
        ("replacement_chars", F.contains(t, F.lit("�"))),
        ("figure_caption", F.lower(F.substring(t, 1, 20)).rlike(r"^(?:\[figure|\[fig\.|figure caption)") & (F.col("_words") < 120)),
    ]
    loss = (
        F.when((alpha >= ALPHA_LOW) & (alpha < ALPHA_FAIR), 0.10).otherwise(0.0)
        + F.when(~many & (single >= 3) & (share >= 0.03), 0.10).otherwise(0.0)
        + F.when(split < 3, split * 0.10).otherwise(0.0)
        + F.when(broken == 1, 0.15).otherwise(0.0)
        + F.when((weird <= WEIRD_HIGH) & (weird > WEIRD_FAIR), 0.10).otherwise(0.0)
    )
    x = x.withColumns({"reasons": F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in hard])), "score": F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.lit(1.0) - loss)), 4)})
    x = x.withColumn("accepted", (F.size("reasons") == 0) & (F.col("score") >= ACCEPT))
    return x.drop("_t", "_n", "_words", "_alpha", "_weird", "_run", "_single", "_split", "_broken")


def document_reasons(text: Column, sections: Column) -> Column:
    t = F.coalesce(text, F.lit(""))
    rules = [
        ("too_few_chars", F.length(t) < DOC_CHARS),
        ("too_few_words", F.size(pieces(t)) < DOC_WORDS),
        ("low_alpha", ascii_alpha_ratio(t) < DOC_ALPHA),
        ("too_few_sections", sections < DOC_SECTIONS),
    ]
    return F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules]))


def docx_reasons(text: Column) -> Column:
    """The gate of text taken from office files."""
    t = F.coalesce(text, F.lit(""))
    rules = [("too_few_chars", F.length(t) < DOC_CHARS), ("too_few_words", F.regexp_count(t, F.lit(r"\S+")) < DOC_WORDS), ("low_alpha", whole_alpha_ratio(t) < DOCX_ALPHA)]
    return F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules]))


def html_payload(c: Column) -> Column:
    """Whether downloaded text is a usable HTML page: long enough, with an HTML marker and no error page at its start."""
    head = F.lower(F.substring(c, 1, 5000))
    return F.coalesce((F.octet_length(c) >= 2000) & head.rlike(r"<html|<!doctype html|<body|<article") & ~head.rlike(ERROR_PAGE), F.lit(False))


def pdf_payload(c: Column) -> Column:
    """Whether downloaded bytes are a usable PDF file."""
    return F.coalesce((F.octet_length(c) >= 10_000) & (F.substring(c, 1, 4).cast("string") == "%PDF"), F.lit(False))


def text_payload(c: Column) -> Column:
    """Whether downloaded text is a usable plain text: long enough, mostly letters, no HTML, no error page."""
    head = F.lower(F.substring(c, 1, 5000))
    return F.coalesce((F.length(F.trim(c)) >= TEXT_CHARS) & (whole_alpha_ratio(c) >= TEXT_ALPHA) & ~head.rlike(r"<html|<!doctype html|<body") & ~head.rlike(ERROR_PAGE), F.lit(False))


#: Fixed value: phrases of pages that stand for a missing document.
ERROR_PAGE = r"404 not found|page not found|403 forbidden|access denied|internal server error|service unavailable"
