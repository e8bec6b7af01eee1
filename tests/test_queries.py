"""Core queries against their SQL on the smallest tables, and gates."""

import glob
import os

import duckdb
import pytest

from paperlake import queries as core

SQL = core.oracle_sql()


def norm(v):
    if isinstance(v, float):
        return repr(round(v, 6) + 0.0)
    if isinstance(v, (list, tuple)):
        return str([norm(x) for x in v])
    try:
        return repr(round(float(v), 6) + 0.0) if not isinstance(v, (str, bool)) and v is not None else str(v)
    except TypeError:
        return str(v)


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for p in glob.glob(f"{sf}/*.parquet"):
        c.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, sf, duck, name):
    df = core.queries()[name](spark, sf)
    cols = sorted(df.columns)
    got = sorted(tuple(norm(v) for v in r) for r in df.select(*cols).collect())
    r = duck.execute(SQL[name])
    names = [d[0] for d in r.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert got == sorted(tuple(norm(x[i]) for i in at) for x in r.fetchall())


#: Queries that SQL doesn't express: what makes a row unique, and what holds for every row.
CHECKS = {
    "document_sections": (["id", "section"], "chars > 0 and heading <> ''"),
    "chunk_pack": (["document_id", "chunk_index"], "word_count between 1 and 420 and length(content_hash) = 64"),
    "html_block_stats": (["id", "type"], "n > 0 and chars > 0"),
    "html_cleaned": (["id"], "blocks_after <= blocks_before and length(content_hash) = 64"),
    "document_blocks": (["id"], "headings + paragraphs + list_items + equations + figure_captions + table_captions > 0"),
    "parse_violations": (["id"], "size(faults) between 1 and 3"),
    "cleaned_documents": (["id"], "blocks_after <= blocks_before and reduction <= 100"),
    "raw_documents": (["id"], "chars > 0"),
    "html_front": (["id"], "id is not null"),
    "paged_sections": (["id", "pos"], "chars > 0 and level between 1 and 3"),
    "paged_text": (["id"], "length(h) = 64"),
    "corpus_lines": (["id"], "dropped >= 0"),
    "svd_neighbours": (["query_id"], "overlap between 0 and 1"),
    "model_choice": (["dim"], "ndcg between 0 and 1 and precision between 0 and 1 and mrr between 0 and 1"),
    "svd_report": (["dim"], "explained between 0 and 1 and least <= median and median <= most"),
}


@pytest.mark.parametrize("name", sorted(set(core.queries()) - set(SQL)))
def test_rows_without_sql(spark, sf, name):
    if name in ("tex_outlines", "tex_text"):  # the smallest tables have no TeX source
        assert core.queries()[name](spark, sf).count() == 0
        return
    key, holds = CHECKS[name]
    df = core.queries()[name](spark, sf).cache()
    n = df.count()
    assert n > 0 and df.select(*key).distinct().count() == n and df.where(f"not coalesce({holds}, false)").count() == 0


def test_gates_find_what_is_broken(spark, sf, tmp_path_factory):
    """Each gate that is empty on sound tables returns the broken rows, as its SQL does."""
    from pyspark.sql import functions as F

    root = str(tmp_path_factory.mktemp("broken"))
    d = spark.read.parquet(f"{sf}/core_documents.parquet")
    odd = lambda k: F.col("id") % 5 == k
    d = d.withColumns({
        "char_count": F.when(odd(0), F.col("char_count") + 1).otherwise(F.col("char_count")), "content_hash": F.when(odd(1), F.substring("content_hash", 1, 60)).when(~odd(0), F.lower(F.sha2(F.lit("other"), 256))).otherwise(F.col("content_hash")),
        "topic_axis": F.when(odd(3), "weather").otherwise(F.col("topic_axis")), "language": F.when(odd(4), F.lit(None).cast("string")).otherwise(F.col("language")),
    })
    d.write.parquet(f"{root}/core_documents.parquet")
    c = spark.read.parquet(f"{sf}/core_chunks.parquet")
    c = c.withColumns({"chunk_index": F.when(odd(0), F.col("chunk_index") + 7).otherwise(F.col("chunk_index")), "word_count": F.when(odd(1), 0).otherwise(F.col("word_count")), "document_id": F.when(odd(2), F.col("document_id") + 10_000_000).otherwise(F.col("document_id")), "content_hash": F.when(odd(3), F.upper("content_hash")).otherwise(F.col("content_hash"))})
    c.write.parquet(f"{root}/core_chunks.parquet")
    r = spark.read.parquet(f"{sf}/resolutions.parquet")
    r.withColumn("selected_format", F.when(F.col("source_id").rlike("[02468]$"), "none").otherwise(F.col("selected_format"))).write.parquet(f"{root}/resolutions.parquet")
    spark.read.parquet(f"{sf}/candidates.parquet").write.parquet(f"{root}/candidates.parquet")
    con = duckdb.connect()
    for t in ("core_documents", "core_chunks", "resolutions", "candidates"):
        con.execute(f"create view {t} as select * from '{root}/{t}.parquet/*.parquet'")
    for name in ("char_count_mismatch", "hash_length_bad", "hash_recomputed", "domain_violations", "broken_index_docs", "chunk_violations", "orphan_chunks", "manifest_mismatch", "leakage_check", "fallback_decision"):
        df = core.queries()[name](spark, root)
        cols = sorted(df.columns)
        got = sorted(tuple(norm(v) for v in x) for x in df.select(*cols).collect())
        res = con.execute(SQL[name])
        at = [[d[0] for d in res.description].index(k) for k in cols]
        assert got and got == sorted(tuple(norm(x[i]) for i in at) for x in res.fetchall()), name


def test_registry_without_llm():
    import __spark_entry__ as e

    assert set(core.queries()) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())
