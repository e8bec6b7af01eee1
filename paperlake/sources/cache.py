"""Pages of queries kept as a partitioned table: one folder a query, one row a page; a page counts only with the same
version, query and size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "version string, query string, start int, size int, body string, key string"


def query_key(q: Column) -> Column:
    return F.substring(F.sha2(q, 256), 1, 12)


def write_pages(pages: DataFrame, path: str) -> None:
    """pages (version, query, start, size, body), appended."""
    pages.withColumn("key", query_key(F.col("query"))).write.mode("append").partitionBy("key").parquet(path)


def read_pages(spark: SparkSession, path: str, version: str, wanted: DataFrame) -> DataFrame:
    """wanted (query, start, size) -> the same with body, null where the page isn't kept as asked. Only the folders of
    the wanted queries are read."""
    w = wanted.withColumn("key", query_key(F.col("query")))
    kept = spark.read.schema(SCHEMA).parquet(path).where(F.col("version") == version).groupBy("key", "query", "start", "size").agg(F.max("body").alias("body"))
    return w.join(kept, ["key", "query", "start", "size"], "left").drop("key")
