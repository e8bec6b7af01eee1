"""Writing: JSON lines, reports, and a table that is replaced only after its checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_report(df: DataFrame, path: str) -> None:
    """A report is one row or one row per group: one file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def write_texts(df: DataFrame, path: str, text: str = "text") -> None:
    """One text after the other with an empty line between, as files of plain text."""
    df.select(F.concat(F.col(text), F.lit("\n")).alias("value")).write.mode("overwrite").text(path)


def write_parted(df: DataFrame, bad: Column, path: str, quarantine: str) -> dict[str, int]:
    """Rows that fail go to the quarantine, the others to the table; what failed before and passes now leaves no file behind.
    Returns the counts."""
    marked = df.withColumn("_bad", F.coalesce(bad, F.lit(True)))
    marked.where("not _bad").drop("_bad").write.mode("overwrite").parquet(path)
    marked.where("_bad").drop("_bad").write.mode("overwrite").parquet(quarantine)
    spark = df.sparkSession
    return {"kept": spark.read.schema(df.schema).parquet(path).count(), "failed": spark.read.schema(df.schema).parquet(quarantine).count()}


def stage_report(df: DataFrame, keys: list[str], before: str, after: str) -> DataFrame:
    """Documents, those with text after the stage, words before and after, least and most words, and the cut in percent."""
    words = lambda c: F.regexp_count(F.coalesce(F.col(c), F.lit("")), F.lit(r"\S+"))
    x = df.withColumns({"_b": words(before), "_a": words(after)})
    return x.groupBy(*keys).agg(
        F.count("*").alias("documents"), F.count_if(F.length(after) > 0).alias("done"), F.sum("_b").alias("words_before"), F.sum("_a").alias("words_after"), F.min("_a").alias("least"), F.max("_a").alias("most"),
        F.round((1 - F.sum("_a") / F.nullif(F.sum("_b"), F.lit(0))) * 100, 2).alias("reduction"),
    )


def expected_counts(df: DataFrame, want: DataFrame, key: str) -> DataFrame:
    """want (key, expected) -> (key, expected, found, ok) of every key on either side; null is a key too."""
    have = df.groupBy(F.col(key).alias("_k")).agg(F.count("*").alias("found"))
    x = want.join(have, F.col(key).eqNullSafe(F.col("_k")), "full_outer")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return x.select(F.coalesce(key, "_k").alias(key), zero("expected").alias("expected"), zero("found").alias("found"), (zero("expected") == zero("found")).alias("ok"))


def publish(spark: SparkSession, df: DataFrame, path: str, gates: dict) -> dict[str, int]:
    """Write beside the table, count the rows of each gate (a function of the staged table; none expected), and only
    if all are empty put the staged table in the place of the old one. Returns the counts."""
    staged = f"{path}.staged"
    df.write.mode("overwrite").parquet(staged)
    back = spark.read.parquet(staged)
    found = {name: gate(back).count() for name, gate in gates.items()}
    if not any(found.values()):
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        new, old, gone = (jvm.org.apache.hadoop.fs.Path(p) for p in (staged, path, f"{path}.before"))
        fs = new.getFileSystem(conf)
        fs.delete(gone, True)
        if fs.exists(old):
            fs.rename(old, gone)
        fs.rename(new, old)
        fs.delete(gone, True)
    return found
