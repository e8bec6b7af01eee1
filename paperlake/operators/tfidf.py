"""TF-IDF over words (lower case, without accents) and word pairs, in SQL operators: sublinear counts, smooth idf, unit length."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import unaccented

MIN_DF, MAX_DF, MAX_FEATURES = 2, 0.95, 50_000


def words(text: Column) -> Column:
    return F.regexp_extract_all(unaccented(F.lower(text)), F.lit("[a-z0-9]{2,}"), 0)


def grams(text: Column, pairs: bool = True) -> Column:
    w = words(text)
    if not pairs:
        return w
    two = F.zip_with(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.concat(w, two)


def counts(docs: DataFrame, ident: str, text: str, pairs: bool = True) -> DataFrame:
    """(ident, term, tf)."""
    return docs.select(ident, F.explode(grams(F.col(text), pairs)).alias("term")).groupBy(ident, "term").agg(F.count("*").alias("tf"))


def vocabulary(tf: DataFrame, ident: str, docs: int) -> DataFrame:
    """(term, idf) of at most MAX_FEATURES terms, the most frequent in all, ties by term."""
    df = tf.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("total")).where((F.col("df") >= MIN_DF) & (F.col("df") <= F.lit(MAX_DF) * docs))
    top = df.orderBy(F.desc("total"), "term").limit(MAX_FEATURES)
    return top.select("term", (F.log(F.lit(1.0 + docs) / (1.0 + F.col("df"))) + 1.0).alias("idf"))


def weights(docs: DataFrame, ident: str, text: str, pairs: bool = True, vocab: DataFrame | None = None) -> DataFrame:
    """(ident, term, w), each row of unit length, over the vocabulary of docs or a given one. A vocabulary has at most
    MAX_FEATURES rows, so it is broadcast."""
    tf = counts(docs, ident, text, pairs)
    vocab = vocabulary(tf, ident, docs.count()) if vocab is None else vocab
    raw = tf.join(F.broadcast(vocab), "term").select(ident, "term", ((1.0 + F.log("tf")) * F.col("idf")).alias("w"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(ident)))
    return raw.select(ident, "term", (F.col("w") / norm).alias("w"))
