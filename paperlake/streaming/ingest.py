"""New documents as a stream of files: cleaned, each hash once within the watermark, appended batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import lines_normal

SCHEMA = "source string, source_id string, title string, text string, received_at timestamp"


def arrivals(spark: SparkSession, path: str, delay: str = "1 day") -> DataFrame:
    """The stream of normalised documents; a hash seen within the delay is dropped, late rows after it are not kept."""
    s = spark.readStream.schema(SCHEMA).parquet(path)
    s = s.withColumn("clean_content", lines_normal(F.col("text"))).withColumn("content_hash", F.sha2("clean_content", 256))
    return s.withWatermark("received_at", delay).dropDuplicatesWithinWatermark(["content_hash"]).drop("text")


def ingest(spark: SparkSession, path: str, target: str, checkpoint: str):
    """Append what has arrived and stop; run again, it takes up where it was."""
    return arrivals(spark, path).writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
