"""Files of the collection stages: JSON documents, paper folders, TeX packages, DOCX files, selections."""

from __future__ import annotations

import gzip
import io
import tarfile
import xml.etree.ElementTree as ET
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def json_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Whole-file JSON with a given schema; damaged files give a row with _corrupt set."""
    return spark.read.schema(f"{schema}, _corrupt string").option("columnNameOfCorruptRecord", "_corrupt").json(path, multiLine=True)


def selection(spark: SparkSession, path: str) -> DataFrame:
    """(topic_axis, ordinal, source_id) of a selection manifest."""
    m = json_documents(spark, path, "selection_version string, source string, selected_documents map<string, array<string>>")
    return m.select(F.explode("selected_documents").alias("topic_axis", "ids")).select("topic_axis", F.posexplode("ids").alias("ordinal", "source_id"))


def selection_faults(sel: DataFrame) -> DataFrame:
    """(fault, source_id): blank ids and ids, without version, in more than one place."""
    base = F.regexp_replace("source_id", r"v\d+$", "")
    blank = sel.where(F.coalesce(F.trim("source_id"), F.lit("")) == "").select(F.lit("blank").alias("fault"), "source_id")
    twice = sel.groupBy(base.alias("source_id")).agg(F.count("*").alias("n")).where("n > 1 and source_id <> ''").select(F.lit("repeated").alias("fault"), "source_id")
    return blank.unionByName(twice)


def manifest_faults(spark: SparkSession, path: str, version: str, source: str, counts: dict[str, int]) -> DataFrame:
    """(fault, found): a manifest whose version, source, declared total or number of ids of an axis isn't as expected."""
    m = json_documents(spark, path, "selection_version string, source string, selected_count int, selected_documents map<string, array<string>>")
    total = F.aggregate(F.map_values("selected_documents"), F.lit(0), lambda s, x: s + F.size(x))
    checks = [("version", F.col("selection_version"), F.lit(version)), ("source", F.col("source"), F.lit(source)), ("total", F.col("selected_count"), total)]
    checks += [(f"count of {a}", F.coalesce(F.size(F.col("selected_documents")[a]), F.lit(-1)), F.lit(n)) for a, n in counts.items()]
    found = F.array(*[F.when(~c.eqNullSafe(want), F.struct(F.lit(n).alias("fault"), c.cast("string").alias("found"))) for n, c, want in checks])
    return m.select(F.explode(F.filter(found, lambda x: x.isNotNull())).alias("f")).select("f.*")


def paper_files(spark: SparkSession, root: str, name: str) -> DataFrame:
    """(topic_axis, source_id, path, content) of root/axis/id/name."""
    f = spark.read.format("binaryFile").option("pathGlobFilter", name).option("recursiveFileLookup", "true").load(root)
    parts = F.split("path", "/")
    return f.select(F.element_at(parts, -3).alias("topic_axis"), F.element_at(parts, -2).alias("source_id"), "path", "content")


def lookup(wanted: DataFrame, files: DataFrame) -> DataFrame:
    """wanted (topic_axis, source_id) with the path of its exact id, else of its base id if only one fits; state is
    'exact', 'base', 'ambiguous' or 'missing'."""
    base = lambda c: F.regexp_replace(c, r"v\d+$", "")
    on = ["topic_axis", "source_id"]
    exact = wanted.join(files.select(*on, "path"), on).withColumn("state", F.lit("exact"))
    rest = wanted.join(exact.select(*on), on, "left_anti").withColumn("base", base("source_id"))
    found = files.groupBy("topic_axis", base("source_id").alias("base")).agg(F.count("*").alias("n"), F.min("path").alias("path"))
    state = F.when(F.col("n").isNull(), "missing").when(F.col("n") > 1, "ambiguous").otherwise("base")
    other = rest.join(found, ["topic_axis", "base"], "left").select(*on, F.when(F.col("n") == 1, F.col("path")).alias("path"), state.alias("state"))
    return exact.select(*on, "path", "state").unionByName(other)


def docx_text(content: bytes | None) -> str | None:
    """Paragraphs of word/document.xml; null for what is no DOCX file."""
    if not content:
        return None
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            root = ET.fromstring(z.read("word/document.xml"))
    except (zipfile.BadZipFile, KeyError, ET.ParseError):
        return None
    out = []
    for p in root.iter():
        if p.tag.endswith("}p"):
            signs = {"}tab": "\t", "}br": "\n"}
            out.append("".join(next((v for k, v in signs.items() if t.tag.endswith(k)), t.text or "" if t.tag.endswith("}t") else "") for t in p.iter()))
    return "\n".join(out)


def tex_main(content: bytes | None) -> str | None:
    """The main file of a TeX package (tar, gzip or plain): the longest, with a bonus for a known name, a document
    class and a document body."""
    if not content:
        return None
    files: list[tuple[str, str]] = []
    try:
        with tarfile.open(fileobj=io.BytesIO(content)) as t:
            for m in t.getmembers():
                if m.isfile() and m.name.lower().endswith(".tex"):
                    files.append((m.name.rsplit("/", 1)[-1].lower(), t.extractfile(m).read().decode("utf-8", "replace")))
    except tarfile.TarError:
        try:
            files.append(("", gzip.decompress(content).decode("utf-8", "replace")))
        except OSError:
            files.append(("", content.decode("utf-8", "replace")))

    def score(f):
        return len(f[1]) + 1_000_000 * (f[0] in ("main.tex", "paper.tex", "article.tex", "ms.tex")) + 500_000 * ("\\documentclass" in f[1]) + 250_000 * ("\\begin{document}" in f[1])

    return max(files, key=score)[1] if files else None


def decoded(files: DataFrame, kind: str) -> DataFrame:
    """files with content -> the same with text; kind 'docx' or 'tex'."""
    read = {"docx": docx_text, "tex": tex_main}[kind]
    keep = [c for c in files.columns if c != "content"]
    fields = ", ".join(f"`{c}` {files.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(keep))), pa.array([read(x) for x in b.column(len(keep)).to_pylist()], pa.string())], names=[*keep, "text"])

    return files.select(*keep, "content").mapInArrow(run, f"{fields}, text string")
