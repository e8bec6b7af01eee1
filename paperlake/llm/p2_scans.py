"""Problem 2: traces of scanning (running heads, page numbers, broken words, misread letters) and their repair.

Words are grouped by a confusable-glyph skeleton over the whole corpus; a rare form whose difference from a
much more frequent form of its skeleton is made of known misreadings, and whose neighbours are seen beside
that form too, is a misreading of it. Running heads are short lines that, with digits masked, repeat in
their record or in the corpus beside page numbers. ``repaired`` puts the lines together again in a window.

Lines are counted from 1, split at line feed. Null, empty and blank texts have no lines with traces. Rows
repeated with the same id count once. Swapped letters (typing slips) are no misreading.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .work import Work

#: What a letter is commonly read as.
MISREAD = [("e", "c"), ("o", "0"), ("a", "@"), ("t", "f"), ("s", "5"), ("n", "ri"), ("i", "l"), ("i", "!"), ("d", "cl"), ("l", "1"), ("u", "ii"), ("c", "("), ("m", "rn"), ("h", "b"), ("g", "9"), ("v", "y"), ("b", "6"), ("w", "vv"), ("fi", "h"), ("li", "h"), ("l", "i"), ("i", "1"), ("o", "c"), ("rn", "m"), ("cl", "d"), ("h", "li")]
_STROKES = {"e": "c", "(": "c", "0": "c", "o": "c", "@": "a", "t": "i", "f": "i", "l": "i", "!": "i", "1": "i", "|": "i", "5": "s", "n": "ri", "d": "ci", "u": "ii", "m": "rri", "h": "ii", "b": "ii", "6": "ii", "9": "g", "y": "v", "w": "vv"}
DASH = "-‐¬\u00ad"
VOCABULARY = 20_000  # frequent forms that are broadcast, so that not every word is a suspect; the others are told by joins
HEADS, CAPITALS = 4, 200  # beginnings of heads seen so often are known; lines in capitals seen so often are section headings
KNOWN_LINES = 200_000  # of either kind that are broadcast, the most frequent: they take at most 20 MB; the rest is told by a join
SUPPORT, RATIO = 12, 15  # a frequent form is seen so often, and so many times as often as the rare one
_EDGE = ".,;:?\"'[]{}<>*_`=~#&\\|“”‘’"
_PAGE = re.compile(r"^[\s\f\ufeff]*(?:(?:p\.|pg\.?|page)\s*\d{1,4}(?:\s*(?:of|/)\s*\d{1,4})?|\(\d{1,4}\)|~\s*\d{1,4}\s*~|[-–—]\s*\d{1,4}\s*[-–—]|\[\d{1,4}\]|\d{1,4})\s*$", re.I)
_CODE = r"[A-Z]{1,4}-\d{4}-\d{3,5}"
_HEAD = re.compile(rf"^[\s\f\ufeff]*(?:{_CODE}(?:\s{{2,}}\S.*|\s+\d{{1,4}})?|\S.*\. \. \.\s+{_CODE}.*|{_CODE}\s+.*\. \. \..*)\s*$")
#: A head with the page number before or after it, set apart by spaces.
_NUMBERED = re.compile(r"^[\s\f\ufeff]*(?:\d{1,4}\s{3,}(?=\S*[^\W\d_]{2})\S+(?: \S+)+|(?=\S*[^\W\d_]{2})\S+(?: \S+)+\s{3,}\d{1,4})\s*$")
_PARTS = re.compile(rf"[{DASH}–—/]")


def skeleton(word: str) -> str:
    return "".join(_STROKES.get(ch, ch) for ch in word)


def explains(true: str, read: str, left: int = 2) -> bool:
    """Whether read is true with one to left letters (or letter pairs) misread."""

    def walk(i, j, used):
        while i < len(true) and j < len(read) and true[i] == read[j]:
            if used < left and any(true.startswith(a, i) and read.startswith(b, j) and walk(i + len(a), j + len(b), used + 1) for a, b in MISREAD):
                return True
            i, j = i + 1, j + 1
        if i == len(true) and j == len(read):
            return used > 0
        return used < left and any(true.startswith(a, i) and read.startswith(b, j) and walk(i + len(a), j + len(b), used + 1) for a, b in MISREAD)

    return walk(0, 0, 0)


def tokens(line: str) -> list[str]:
    """Lower-case words of a line, hyphenated ones in their parts, signs that can be misread letters kept."""
    out = []
    for t in line.lower().split():
        for p in _PARTS.split(t):
            p = p.strip(_EDGE)
            if p.endswith(")"):
                p = p.rstrip(")").rstrip(_EDGE)
            if p.startswith("(") and "(" not in p[1:] and ")" in t:
                p = p[1:]
            out.append(p)
    return out


def _suffix(line: str) -> str | None:
    """The last two words of a short line of three or four capitalised words: a head that begins with a name."""
    w = line.split()
    if 3 <= len(w) <= 5 and len(line) < 70 and not w[0][:1].isdigit() and not line.rstrip().endswith((".", ":", ",")) and all(x[:1].isupper() or x[:1].isdigit() for x in w):
        return "~ " + " ".join(w[-2:])
    return None


def _counts(batches):
    """Partial counts: ('w', word), ('h', hyphenated word), ('b', two words), ('s', suffix of a line beside a page
    number), ('u', upper-case line)."""
    c: Counter = Counter()
    for batch in batches:
        for text in batch.column(0).to_pylist():
            if not text:
                continue
            lines = text.split("\n")
            pages = {i for i, x in enumerate(lines) if _PAGE.match(x) or _HEAD.match(x) or _NUMBERED.match(x)}
            cut = False  # the line before ends inside a word, perhaps
            for i, line in enumerate(lines):
                w = tokens(line)
                ends = line.rstrip()[-1:] in DASH and bool(line.strip())
                if w and i not in pages:
                    w, cut = w[cut : len(w) - ends], ends
                c.update(("w", x) for x in w if x and not x.isdigit())
                c.update(("b", f"{a} {b}") for a, b in zip(w, w[1:]) if a.isalpha() and b.isalpha())
                if "-" in line:
                    c.update(("h", x.strip(_EDGE + "()!").lower()) for x in line.split() if "-" in x.strip(_EDGE + "-()!"))
                s = line.strip()
                if s.isupper() and len(s) < 60:
                    c[("u", re.sub(r"\d", "9", s))] += 1
                if pages and any(k in pages for k in (i - 3, i - 2, i - 1, i + 1, i + 2, i + 3)) and (x := _suffix(s)):
                    c[("s", x)] += 1
        if len(c) > 400_000:
            yield _pack(c)
            c = Counter()
    yield _pack(c)


def _pack(c: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([k[0] for k in c], pa.string()), pa.array([k[1] for k in c], pa.string()), pa.array(list(c.values()), pa.int64())], names=["kind", "form", "n"])


def corpus_counts(texts: DataFrame) -> DataFrame:
    """(kind, form, n) over all texts."""
    return texts.select("text").mapInArrow(_counts, "kind string, form string, n bigint").groupBy("kind", "form").agg(F.sum("n").alias("n"))


def misreadings(words: DataFrame) -> DataFrame:
    """words (form, n) -> (form, meant): rare forms and the frequent form of their skeleton that explains them."""
    def skeletons(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([skeleton(x) for x in b.column(0).to_pylist()], pa.string())], names=["form", "n", "skeleton"])

    kept = words.where((F.length("form") >= 2) & F.col("form").rlike("[a-z]")).select("form", "n").mapInArrow(skeletons, "form string, n bigint, skeleton string")
    often = kept.where(f"n >= {SUPPORT}").where(F.col("form").rlike(r"^[a-z]+$"))
    pairs = kept.join(often.select(F.col("form").alias("meant"), F.col("n").alias("m"), "skeleton"), "skeleton").where(f"m >= {RATIO} * n and form <> meant")

    def check(batches):
        for b in batches:
            ok = [explains(t, f) for f, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            yield b.filter(pa.array(ok, pa.bool_()))

    return pairs.select("form", "meant", "m").mapInArrow(check, "form string, meant string, m bigint")


class Reader:
    """Finds the lines of one text that are heads, page numbers or end in a broken word."""

    def __init__(self, vocabulary: set, suffixes: set, capitals: set):
        self.vocabulary, self.suffixes, self.capitals = vocabulary, suffixes, capitals

    def _sorted(self, lines: list[str]) -> tuple[list[str], list[tuple[int, str | None, str | None, bool]]]:
        """'page', 'header', 'blank' or 'body' of each line by its own form, and of the body lines that can be heads: number,
        mask if in capitals, suffix if beside a page number, and whether it repeats there."""
        out, stripped = [], [x.strip().strip("\ufeff\f") for x in lines]
        masks = Counter(re.sub(r"\d", "9", s) for s in stripped if 3 < len(s) < 70)
        for s in stripped:
            out.append("blank" if not s else "page" if _PAGE.match(s) else "header" if _HEAD.match(s) or _NUMBERED.match(s) else "body")
        marks = [i for i, k in enumerate(out) if k in ("page", "header")]
        near = {i + d for i in marks for d in (-3, -2, -1, 1, 2, 3)} | {i + d for i, x in enumerate(lines) if x.startswith("\f") for d in (0, 1, 2)}
        maybe = []
        for i, s in enumerate(stripped):
            if out[i] != "body" or len(s) >= 70:
                continue
            mask = re.sub(r"\d", "9", s)
            capital = mask if s.isupper() and len(s.split()) >= 3 and (i in near or masks[mask] > 1) else None
            suffix = _suffix(s) if i in near else None
            repeats = i in near and masks[mask] > 2 and not s.endswith((".", ",")) and s[:1].isupper()
            if capital or suffix or repeats:
                maybe.append((i, capital, suffix, repeats))
        return out, maybe

    def kinds(self, lines: list[str], more=()) -> list[str]:
        """'page', 'header', 'blank' or 'body' of each line; more: what is known of this text's lines besides what is broadcast,
        as asked() names it."""
        out, maybe = self._sorted(lines)
        for i, capital, suffix, repeats in maybe:
            if capital and capital not in self.capitals and "u" + capital not in more or suffix in self.suffixes or suffix and "s" + suffix in more or repeats:
                out[i] = "header"
        return out

    def asked(self, lines: list[str]) -> set[str]:
        """Kind and form of the lines that are not among those broadcast and may be known all the same."""
        maybe = self._sorted(lines)[1]
        return {"u" + c for _, c, _, _ in maybe if c and c not in self.capitals} | {"s" + x for _, _, x, _ in maybe if x and x not in self.suffixes}

    def cut(self, lines: list[str], kinds: list[str], i: int) -> tuple[str, str, str, bool] | None:
        """(whole, stem, rest, sure) of body line i if it ends with a word and a hyphen: the last word with its own hyphens, its
        last part, the first word of the next body line if it can go on there, and whether the sign is no true hyphen."""
        m = re.search(rf"([^\W\d_][^\W_]*)([{DASH}])$", lines[i].rstrip().rstrip("\ufeff"))
        if not m:
            return None
        whole = lines[i].rstrip().split()[-1].strip(_EDGE + "()").lower()
        rest = ""
        for j in range(i + 1, len(lines)):
            if kinds[j] == "body":
                w = re.match(r"[\s\ufeff]*([^\W\d_]+)", lines[j])
                rest = w[1] if w else ""
                break
        if rest and rest[0].isupper():
            rest = ""
        return whole, m[1].lower(), rest.lower(), m[2] in "¬\u00ad"


def broken(cuts: DataFrame, words: DataFrame, wrong: DataFrame, hyphenated: DataFrame) -> DataFrame:
    """cuts (whole, stem, rest, sure, ...) -> those that end inside a word that is written without a hyphen, judged by all
    forms of the corpus: frequent words (without misreadings) and hyphenated words. The forms are joined, not broadcast."""
    one = cuts.select("whole", "stem", "rest", "sure").distinct()
    key = lambda kind, c: F.struct(F.lit(kind).alias("kind"), c.alias("form"))
    asked = {
        "hyphen": key("h", F.concat("stem", F.lit("-"), "rest")), "longer": key("h", F.concat("whole", "rest")), "first": key("f", F.col("stem")),
        "joined": key("w", F.concat("stem", "rest")), "left": key("w", F.col("stem")), "right": key("w", F.col("rest")),
    }
    known = words.where(f"n >= {SUPPORT}").select("form").join(wrong.select("form").distinct(), "form", "left_anti").select(F.lit("w").alias("kind"), "form")
    often = hyphenated.where("n >= 5")
    known = known.union(often.select(F.lit("h"), "form")).union(often.select(F.lit("f"), F.substring_index("form", "-", 1)).distinct())
    x = one.select("whole", "stem", "rest", "sure", F.explode(F.array(*[F.struct(F.lit(q).alias("q"), k.alias("k")) for q, k in asked.items()])).alias("a")).select("whole", "stem", "rest", "sure", "a.q", "a.k.*")
    said = x.join(known.withColumn("yes", F.lit(True)), ["kind", "form"], "left").groupBy("whole", "stem", "rest", "sure").agg(*[F.coalesce(F.bool_or(F.when(F.col("q") == q, F.col("yes"))), F.lit(False)).alias(q) for q in asked])
    more = F.length("rest") > 0
    hyphens = F.length("whole") - F.length(F.replace("whole", F.lit("-"), F.lit("")))
    ok = (
        F.when(more & F.col("hyphen"), False).when((hyphens > 1) & F.col("longer"), False).when(F.col("sure"), True).when(more & F.col("joined"), True)
        .when(more, ~(F.col("left") & F.col("right"))).otherwise(~F.col("first") & ~F.col("left"))
    )
    return cuts.join(said.where(ok).select("whole", "stem", "rest", "sure"), ["whole", "stem", "rest", "sure"], "left_semi")


def _scan(reader):
    def run(batches):
        r = reader.value if hasattr(reader, "value") else reader
        r = Reader(*r)
        for batch in batches:
            rows = []
            for tbl, rid, text, more in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if not text or rid is None:
                    continue
                lines = text.split("\n")
                kinds = r.kinds(lines, more or ())
                for i, line in enumerate(lines):
                    if kinds[i] in ("page", "header"):
                        rows.append((tbl, rid, i + 1, kinds[i], None, None, None, None))
                    elif kinds[i] == "body":
                        if line.rstrip()[-1:] in DASH and (c := r.cut(lines, kinds, i)):
                            rows.append((tbl, rid, i + 1, "cut", *c))
                        w = tokens(line)
                        for k, x in enumerate(w):
                            if (len(x) > 2 or len(x) == 2 and not x.isalpha()) and x not in r.vocabulary and not x.isdigit():
                                rows.append((tbl, rid, i + 1, "word", x, w[k - 1] if k else None, w[k + 1] if k + 1 < len(w) else None, None))
            cols = list(zip(*rows)) if rows else [[]] * 8
            types = (pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.string(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["tbl", "rec_id", "line_no", "kind", "form", "before", "after", "sure"])

    return run


def _asked(reader):
    def run(batches):
        r = Reader(*reader.value)
        for batch in batches:
            rows = [(tbl, rid, x) for tbl, rid, text in zip(*(batch.column(k).to_pylist() for k in range(3))) if text and rid is not None for x in r.asked(text.split("\n"))]
            cols = list(zip(*rows)) if rows else [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.string()))], names=["tbl", "rec_id", "known"])

    return run


def tables(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/core_documents.parquet").select(F.lit("core_documents").alias("tbl"), F.col("id").alias("rec_id"), F.col("raw_content").alias("text"))
    chunks = spark.read.parquet(f"{sf}/core_chunks.parquet").select(F.lit("core_chunks").alias("tbl"), F.col("id").alias("rec_id"), F.col("chunk_text").alias("text"))
    return docs.unionByName(chunks)


def marks(texts: DataFrame, work: Work) -> tuple[DataFrame, DataFrame]:
    """(tbl, rec_id, line_no, kind) of all traces, and the misreadings (tbl, rec_id, line_no, form, meant)."""
    spark = texts.sparkSession
    counts = work.table(corpus_counts(texts), "counts")
    words = counts.where("kind = 'w'")
    wrong = work.table(misreadings(words), "wrong")

    def top(forms, most):
        """The most frequent forms: at most `most` of them, the bound of what is broadcast. The others are told by joins."""
        return {r[0] for r in forms.orderBy(F.desc("n"), "form").limit(most).select("form").toLocalIterator()}

    often = words.where(f"n >= {SUPPORT}").join(wrong.select("form").distinct(), "form", "left_anti")
    heads, capitals = counts.where(f"kind = 's' and n >= {HEADS}"), counts.where(f"kind = 'u' and n >= {CAPITALS}")
    reader = spark.sparkContext.broadcast((top(often, VOCABULARY), top(heads, KNOWN_LINES), top(capitals, KNOWN_LINES)))
    texts = texts.select("tbl", "rec_id", "text")
    if max(len(x) for x in reader.value[1:]) < KNOWN_LINES:  # all are broadcast
        told = texts.withColumn("known", F.lit(None).cast("array<string>"))
    else:
        lines = heads.unionByName(capitals).select(F.concat("kind", "form").alias("known"))
        known = texts.mapInArrow(_asked(reader), "tbl string, rec_id bigint, known string").join(lines, "known", "left_semi")
        known = work.table(known.groupBy("tbl", "rec_id").agg(F.collect_set("known").alias("known")), "known")
        told = texts.join(known, ["tbl", "rec_id"], "left").select("tbl", "rec_id", "text", "known")
    seen = work.table(told.mapInArrow(_scan(reader), "tbl string, rec_id bigint, line_no int, kind string, form string, before string, after string, sure boolean"), "seen")
    bigrams = counts.where("kind = 'b'").select(F.col("form").alias("pair"), F.col("n").alias("pn"))
    suspects = seen.where("kind = 'word'").join(wrong, "form")
    beside = suspects.select("form", "meant", F.explode(F.array(F.concat_ws(" ", "before", "meant"), F.concat_ws(" ", "meant", "after"))).alias("pair")).distinct()
    supported = beside.join(bigrams, "pair").groupBy("form", "meant").agg(F.max("pn").alias("pn"))
    best = Window.partitionBy("form").orderBy(F.desc("pn"), "meant")
    chosen = supported.where("pn >= 2").withColumn("r", F.row_number().over(best)).where("r = 1").select("form", "meant")
    misread = seen.where("kind = 'word'").join(chosen, "form").select("tbl", "rec_id", "line_no", "form", "meant").distinct()
    cuts = seen.where("kind = 'cut'").select("tbl", "rec_id", "line_no", F.col("form").alias("whole"), F.col("before").alias("stem"), F.col("after").alias("rest"), "sure")
    cuts = broken(cuts, words, wrong, counts.where("kind = 'h'")).select("tbl", "rec_id", "line_no", F.lit("hyphen").alias("kind"))
    heads = seen.where("kind in ('page', 'header')").select("tbl", "rec_id", "line_no", "kind")
    kinds = heads.unionByName(cuts).unionByName(misread.select("tbl", "rec_id", "line_no", F.lit("misread").alias("kind"))).distinct()
    return kinds, misread


def repaired(texts: DataFrame, work: Work) -> DataFrame:
    """(tbl, rec_id, text): heads and page numbers removed, misread words replaced, broken words joined and the
    lines of a paragraph put together; true hyphens stay. Null texts stay null, blank ones become empty."""
    kinds, misread = marks(texts, work)
    line = Window.partitionBy("tbl", "rec_id").orderBy("line_no")
    lines = texts.dropDuplicates(["tbl", "rec_id"]).select("tbl", "rec_id", F.posexplode_outer(F.split("text", "\n")).alias("p", "line")).withColumn("line_no", F.col("p") + 1)
    flags = kinds.where("kind <> 'misread'").groupBy("tbl", "rec_id", "line_no").agg(F.max(F.col("kind") == "hyphen").alias("broken"), F.max(F.col("kind") != "hyphen").alias("drop"))
    fixes = misread.groupBy("tbl", "rec_id", "line_no").agg(F.sort_array(F.collect_set(F.struct("form", "meant"))).alias("fixes"))
    on = ["tbl", "rec_id", "line_no"]
    x = lines.join(flags, on, "left").join(fixes, on, "left").where(~F.coalesce("drop", F.lit(False)))

    def fix(text, f):
        return F.replace(F.replace(text, f["form"], f["meant"]), F.initcap(f["form"]), F.initcap(f["meant"]))

    x = x.withColumn("line", F.trim(F.regexp_replace(F.col("line"), "[\\s\ufeff\u00a0]+", " ")))
    x = x.withColumn("line", F.when(F.col("fixes").isNull(), F.col("line")).otherwise(F.aggregate("fixes", F.col("line"), fix)))
    text_line = F.length("line") > 0
    x = x.withColumn("last", F.last(F.when(text_line, F.struct("line", "broken", "line_no")), True).over(line.rowsBetween(Window.unboundedPreceding, -1)))
    x = x.withColumn("gap", F.col("line_no") - F.coalesce("last.line_no", F.lit(0)) > 1)
    closed = F.col("last.line").rlike("[.!?:;][\"')\\]]*$") | (F.length("last.line") < 40) & ~F.col("last.line").rlike("[,\u2010-]$") & F.col("line").rlike("^[A-Z0-9]")
    joint = (
        F.when(F.col("last").isNull(), "")
        .when(F.coalesce("last.broken", F.lit(False)) | F.col("last.line").rlike("-$"), "")
        .when(F.col("gap") & closed, "\n\n")
        .otherwise(" ")
    )
    x = x.withColumn("joint", joint)
    x = x.withColumn("line", F.when(F.coalesce("broken", F.lit(False)), F.regexp_replace("line", f"[{DASH}]$", "")).otherwise(F.col("line")))
    kept = x.groupBy("tbl", "rec_id").agg(F.sort_array(F.collect_list(F.when(text_line, F.struct("line_no", "joint", "line")))).alias("l"), F.max(F.col("line").isNotNull()).alias("some"))
    return kept.select("tbl", "rec_id", F.when(F.col("some"), F.array_join(F.transform("l", lambda y: F.concat(y["joint"], y["line"])), "")).alias("text"))


def p2_repaired(spark: SparkSession, sf: str) -> DataFrame:
    """(tbl, rec_id, text) of every raw_content and chunk_text, repaired."""
    return repaired(tables(spark, sf), Work(spark, "p2r"))


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    """(tbl, rec_id, line_no, kind) of lines with a trace of scanning."""
    return marks(tables(spark, sf), Work(spark, "p2"))[0]
