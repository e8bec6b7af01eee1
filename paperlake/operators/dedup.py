"""Exact deduplication: first owner of a hash, repeated neighbours, versions of one id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def duplicate_of(df: DataFrame, key: str, ident: str) -> DataFrame:
    """df with duplicate_of, the least id of the rows with the same key if it is another; null keys own nothing.

    The owners are aggregated before the join, so a hot key costs one row a partition."""
    owner = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(ident).alias("_owner"))
    return df.join(owner, key, "left").withColumn("duplicate_of", F.when(F.col("_owner") != F.col(ident), F.col("_owner"))).drop("_owner")


def first_of(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the order; min_by keeps the hot keys' rows on the map side."""
    cols = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*cols), F.struct(*order)).alias("_r"))
    return best.select(*keys, "_r.*").select(*df.columns)


def without_repeats(df: DataFrame, group: list[str], order: list[str], value: str) -> DataFrame:
    """Rows whose value differs from the row before in their group; nulls are equal to nulls."""
    w = Window.partitionBy(*group).orderBy(*order)
    seen = df.withColumn("_n", F.row_number().over(w)).withColumn("_before", F.lag(value).over(w))
    return seen.where((F.col("_n") == 1) | ~F.col("_before").eqNullSafe(F.col(value))).drop("_n", "_before")
