"""Records of search interfaces to flat candidates, in SQL operators: Atom entries (XML) and report records (JSON).

Records are read from saved pages. Damaged records give a row with a null source_id. Missing parts are null or empty."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import absolute_url, base_id, squeeze

REPORT = """id string, title string, abstract string, stiType string, distributionDate string, submittedDate string, created string,
    authorAffiliations array<struct<meta: struct<author: struct<name: string>>>>, sourceIdentifiers array<struct<type: string, number: string, value: string>>,
    publications array<struct<publicationDate: string, doi: string>>, subjectCategories array<string>,
    downloads array<struct<name: string, type: string, mimetype: string, draft: boolean, links: struct<fulltext: string, pdf: string, original: string>>>"""
ENTRY = """id string, title string, summary string, published string, updated string, doi string, author array<struct<name: string>>,
    category array<struct<_term: string>>, link array<struct<_href: string, _type: string, _title: string>>"""


def _first(array: Column, field) -> Column:
    """The first of an array's fields that isn't null or empty."""
    return F.get(F.filter(F.transform(array, field), lambda x: F.length(x) > 0), 0)


def published(r: str = "r") -> Column:
    """The first date there is: of a publication, of distribution, submission, creation; its first ten signs."""
    c = lambda x: F.nullif(F.col(f"{r}.{x}"), F.lit(""))
    return F.substring(F.coalesce(_first(F.col(f"{r}.publications"), lambda p: p["publicationDate"]), c("distributionDate"), c("submittedDate"), c("created")), 1, 10)


def reports(df: DataFrame, json: str, site: str) -> DataFrame:
    """df with a column of JSON records -> its other columns, source_id, title, abstract, authors, doi, published_at,
    categories, document_type, fulltext_url, pdf_url, original_url, has_download."""
    keep = [c for c in df.columns if c != json]
    x = df.select(*keep, F.from_json(json, REPORT).alias("r"))
    names = F.filter(F.transform("r.authorAffiliations", lambda a: squeeze(a["meta"]["author"]["name"])), lambda n: F.length(n) > 0)
    listed = F.filter("r.sourceIdentifiers", lambda i: F.upper(i["type"]) == "DOI")
    doi = F.coalesce(_first(listed, lambda i: F.coalesce(F.nullif(i["number"], F.lit("")), i["value"])), _first(F.col("r.publications"), lambda p: p["doi"]))
    url = lambda k: _first(F.col("r.downloads"), lambda d: absolute_url(site, d["links"][k]))
    out = x.select(
        *keep, F.col("r.id").alias("source_id"), squeeze(F.col("r.title")).alias("title"), squeeze(F.col("r.abstract")).alias("abstract"),
        F.array_distinct(F.coalesce(names, F.array().cast("array<string>"))).alias("authors"), doi.alias("doi"), published().alias("published_at"),
        F.coalesce("r.subjectCategories", F.array().cast("array<string>")).alias("categories"), F.col("r.stiType").alias("document_type"),
        url("fulltext").alias("fulltext_url"), url("pdf").alias("pdf_url"), url("original").alias("original_url"),
    )
    return out.withColumn("has_download", F.coalesce("fulltext_url", "pdf_url", "original_url").isNotNull())


def entries(df: DataFrame, xml: str, site: str) -> DataFrame:
    """df with a column of Atom entries -> its other columns, source_id, source_base_id, title, abstract, authors, categories,
    published_at, doi, url, pdf_url and the addresses of HTML, source and PDF."""
    keep = [c for c in df.columns if c != xml]
    x = df.select(*keep, F.from_xml(F.col(xml), ENTRY, {"attributePrefix": "_", "valueTag": "_value"}).alias("e"))
    sid = F.regexp_extract("e.id", r"([^/]+(?:/\d+)?(?:v\d+)?)$", 1)
    sid = F.when(F.length(sid) > 0, F.regexp_replace(sid, "^abs/", ""))
    pdf = F.get(F.filter("e.link", lambda k: (k["_type"] == "application/pdf") | (k["_title"] == "pdf")), 0)["_href"]
    terms = F.filter(F.transform("e.category", lambda c: c["_term"]), lambda t: t.isNotNull())
    names = F.filter(F.transform("e.author", lambda a: squeeze(a["name"])), lambda n: F.length(n) > 0)
    none = F.array().cast("array<string>")
    x = x.withColumn("source_id", sid)
    base = base_id(F.col("source_id"))
    return x.select(
        *keep, "source_id", base.alias("source_base_id"), squeeze(F.col("e.title")).alias("title"), squeeze(F.col("e.summary")).alias("abstract"), F.coalesce(names, none).alias("authors"),
        F.coalesce(terms, none).alias("categories"), F.substring(F.nullif("e.published", F.lit("")), 1, 10).alias("published_at"), F.col("e.doi").alias("doi"), F.col("e.id").alias("url"), pdf.alias("pdf_url"),
        *[F.concat(F.lit(f"{site}/{kind}/"), c).alias(f"{kind}_url") for kind, c in (("html", base), ("src", base))],
    )
