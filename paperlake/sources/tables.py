"""Scans of the stored tables. Filters and column selections of the callers reach the parquet reader."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "core_documents")


def chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Chunks, each id once (the table repeats some rows, equal in all columns)."""
    return table(spark, sf, "core_chunks").dropDuplicates(["id"])


def chunk_columns(spark: SparkSession, sf: str, *cols: str) -> DataFrame:
    """Some columns of the chunks, each id once: what isn't asked for isn't read or shuffled."""
    return table(spark, sf, "core_chunks").select("id", *[c for c in cols if c != "id"]).dropDuplicates(["id"])


def usable(docs: DataFrame) -> DataFrame:
    """Documents that can be chunked: parsed, with text."""
    return docs.where((F.col("parse_status") == "parsed") & (F.length(F.trim("clean_content")) > 0))


def candidates(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "candidates").dropDuplicates(["candidate_id"])
