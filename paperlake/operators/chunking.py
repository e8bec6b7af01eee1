"""Section-aware chunking: sections by headings, paragraphs, sentences, greedy packing with overlap."""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TARGET, MOST, OVERLAP, LEAST_SECTION = 360, 420, 50, 20
DEFAULT_SECTION = "Document Body"


def hard_split(df: DataFrame, ident: str, text: str, size: int = MOST) -> DataFrame:
    """(ident, part, body): slices of size words, in closed form."""
    w = F.filter(F.split(F.trim(F.regexp_replace(text, r"\s+", " ")), " "), lambda x: x != "")
    x = df.select(ident, w.alias("w")).where(F.size("w") > 0)
    x = x.select(ident, "w", F.explode(F.sequence(F.lit(0), ((F.size("w") - 1) / size).cast("int"))).alias("part"))
    return x.select(ident, "part", F.array_join(F.slice("w", F.col("part") * size + 1, F.lit(size)), " ").alias("body"))


def sections(df: DataFrame, ident: str, text: str) -> DataFrame:
    """(ident, section, heading, body): lines under '#' headings; what comes before the first is DEFAULT_SECTION."""
    x = df.select(ident, F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    head = F.col("line").rlike(r"^\s*#{1,6}\s+\S")
    w = Window.partitionBy(ident).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    x = x.withColumn("section", F.sum(head.cast("int")).over(w))
    title = F.max(F.when(head, F.regexp_extract("line", r"^\s*#{1,6}\s+(.+?)\s*$", 1)))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(~head, F.struct("pos", "line")))), lambda y: y["line"]), "\n")
    g = x.groupBy(ident, "section").agg(title.alias("heading"), F.regexp_replace(body, r"^\s+|\s+$", "").alias("body"))
    g = g.withColumn("heading", F.coalesce("heading", F.lit(DEFAULT_SECTION)))
    kept = g.where((F.length("body") > 0) & ~F.lower("heading").isin("title", "document title"))
    return kept.withColumn("section", (F.row_number().over(Window.partitionBy(ident).orderBy("section")) - 1).cast("int"))  # what is dropped takes no number


def units(body: str) -> list[list[str]]:
    """Pieces of at most MOST words: paragraphs, long ones cut at sentences, long sentences hard."""
    out = []
    for p in re.split(r"\n\s*\n", body):
        words = p.split()
        if len(words) <= MOST:
            if words:
                out.append(words)
            continue
        now: list[str] = []
        for s in re.split(r"(?<=[.!?])\s+(?=[A-Z0-9\[])", " ".join(words)):
            w = s.split()
            if len(now) + len(w) > MOST and now:
                out.append(now)
                now = []
            while len(w) > MOST:
                out.append(w[:MOST])
                w = w[MOST:]
            now = now + w
        if now:
            out.append(now)
    return out


def pack(pieces: list[list[str]]) -> list[list[str]]:
    """Chunks of TARGET to MOST words; each begins with the last words of the one before, OVERLAP at most and no
    more than fit. A last chunk that is only such a beginning is dropped."""
    chunks: list[list[str]] = []
    now: list[str] = []
    carried = 0
    for i, u in enumerate(pieces):
        if len(now) > carried and len(now) + len(u) > MOST:
            chunks.append(now)
            now, carried = [], 0
        if not now and chunks:
            room = min(OVERLAP, MOST - len(u))
            now = chunks[-1][-room:] if room > 0 else []
            carried = len(now)
        elif len(now) + len(u) > MOST:  # only carried words, and they don't fit
            now = now[len(now) + len(u) - MOST :]
            carried = len(now)
        now = now + u
        if len(now) >= TARGET:
            chunks.append(now)
            now, carried = [], 0
    if len(now) > carried:
        chunks.append(now)
    return chunks


CHUNK = "document_id bigint, chunk_index int, section_index int, section_heading string, chunk_text string, retrieval_text string, word_count int, token_estimate int, char_count int, content_hash string"


def chunked(sectioned: DataFrame) -> DataFrame:
    """sectioned (document_id, title, sections array<struct<heading, body>>) -> rows of CHUNK.

    Sections under LEAST_SECTION words give none; chunks equal within a document count once."""

    def run(batches):
        for b in batches:
            rows = []
            for i, title, secs in zip(*(b.column(k).to_pylist() for k in range(3))):
                seen: set[str] = set()
                for k, s in enumerate(secs or []):
                    if len((s["body"] or "").split()) < LEAST_SECTION:
                        continue
                    for words in pack(units(s["body"])):
                        t = " ".join(words)
                        h = hashlib.sha256(t.encode()).hexdigest()
                        if h not in seen:
                            seen.add(h)
                            rows.append((i, len(seen) - 1, k, s["heading"], t, "\n".join(x for x in (title, s["heading"], t) if x), len(words), -(-len(words) * 133 // 100), len(t), h))
            cols = list(zip(*rows)) if rows else [[]] * 10
            types = [pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=[x.split()[0] for x in CHUNK.split(", ")])

    return sectioned.select("document_id", "title", "sections").mapInArrow(run, CHUNK)
