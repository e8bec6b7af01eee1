"""Merge of new rows into a stored table that has no MERGE: one full outer join on the key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..work import Work


def upsert(stored: DataFrame, new: DataFrame, keys: list[str], ident: str = "id") -> DataFrame:
    """stored and new have the same columns but for ident, which new lacks. Stored rows keep their id, their other
    columns are replaced; new keys get ids after the largest. action is 'kept', 'updated' or 'inserted'.

    Several new rows of one key are an error of the caller. Null keys never match."""
    cols = [c for c in stored.columns if c != ident and c not in keys]
    n = new.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in cols], F.lit(True).alias("_new"))
    both = stored.withColumn("_old", F.lit(True)).join(n, keys, "full_outer")
    action = F.when(F.col("_old").isNull(), "inserted").when(F.col("_new").isNull(), "kept").otherwise("updated")
    merged = both.select(ident, *keys, *[F.when(F.col("_new"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) for c in cols], action.alias("action"))
    fresh = merged.where("action = 'inserted'")
    top = stored.agg(F.coalesce(F.max(ident), F.lit(0)).alias("_top"))
    return merged.where("action <> 'inserted'").unionByName(numbered(fresh.drop(ident), keys, ident).join(F.broadcast(top)).withColumn(ident, F.col(ident) + F.col("_top")).drop("_top"))


def numbered(df: DataFrame, order: list[str], ident: str) -> DataFrame:
    """Rows numbered 1, 2, ... in the order of order without bringing them into one task.

    The range-sorted rows are written once with the place Spark gives each row of a partition; the offsets of the
    partitions come from the same written rows, so they can't belong to another partitioning."""
    work = Work(df.sparkSession, "numbered")
    rows = df.repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order).withColumn("_m", F.monotonically_increasing_id())
    rows = work.table(rows, "rows").withColumn("_p", F.shiftright("_m", 33))
    counts = rows.groupBy("_p").agg(F.count("*").alias("_n"))  # a row for each partition
    before = counts.select("_p", (F.sum("_n").over(Window.partitionBy(F.lit(0)).orderBy("_p")) - F.col("_n")).alias("_before"))
    place = F.col("_m").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("_before") + 1
    return rows.join(F.broadcast(before), "_p").withColumn(ident, place.cast("bigint")).drop("_m", "_p", "_before")


def update_columns(stored: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """stored with the columns of new in the place of its own where the key is in new; new has each key once."""
    cols = [c for c in new.columns if c not in keys]
    n = new.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in cols], F.lit(True).alias("_new"))
    both = stored.join(n, keys, "left")
    return both.select(*[F.when(F.col("_new"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in cols else F.col(c) for c in stored.columns])
