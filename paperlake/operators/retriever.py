"""Retrieval of passages for a title and an idea: fit once, keep the tables, then ask."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.quality import gated
from ..functions.text import unquoted
from . import sparse
from .retrieval import evidence
from .tfidf import counts, vocabulary, weights

CANDIDATES, TOP = 200, 6


class Retriever:
    """Tables under one folder: vocabulary (term, idf), rows (row_id, terms, ws) and chunks (id, document_id, chunk_text)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")

    def fit(self, chunks: DataFrame) -> Retriever:
        """chunks: id, document_id, chunk_text, retrieval_text; each id once."""
        tf = counts(chunks, "id", "retrieval_text")
        vocabulary(tf, "id", chunks.count()).write.mode("overwrite").parquet(f"{self.path}/vocabulary")
        w = weights(chunks, "id", "retrieval_text", vocab=self._read("vocabulary"))
        sparse.term_rows(w, "id").withColumnRenamed("id", "row_id").write.mode("overwrite").parquet(f"{self.path}/rows")
        chunks.select("id", "document_id", "chunk_text").write.mode("overwrite").parquet(f"{self.path}/chunks")
        return self

    def query(self, title: str, idea: str = "") -> DataFrame:
        """(query_id, terms, ws) of a title and an idea, both without the quotes around them. An empty title, and a query
        of unknown words only, are errors."""
        t = self.spark.createDataFrame([(0, title or "", idea or "")], "query_id bigint, t string, i string").select("query_id", unquoted(F.col("t")).alias("t"), unquoted(F.col("i")).alias("i"))
        if not t.first()["t"]:
            raise ValueError("the title must not be empty")
        text = t.select("query_id", F.concat_ws("\n", "t", F.nullif("i", F.lit(""))).alias("x"))
        q = sparse.term_rows(weights(text, "query_id", "x", vocab=self._read("vocabulary")), "query_id")
        if not q.count():
            raise ValueError("no word of the query is known")
        return q

    def retrieve_with_diagnostics(self, title: str, idea: str = "", top_k: int = TOP) -> dict[str, DataFrame]:
        """evidence: the best passage of each of top_k documents among the CANDIDATES nearest that pass the gate; rejected:
        the others with their reasons; summary: how many of each reason."""
        found = sparse.top_k(self.query(title, idea), self._read("rows"), CANDIDATES).where("score > 0")
        near = self._read("chunks").join(F.broadcast(found.select(F.col("row_id").alias("id"), "score")), "id")  # at most CANDIDATES rows
        judged = gated(near.withColumnRenamed("score", "cosine"), "chunk_text")
        rejected = judged.where("not accepted").select("id", "document_id", "cosine", "score", "reasons")
        summary = judged.agg(F.count("*").alias("candidates"), F.count_if("accepted").alias("accepted"), F.count_if(~F.col("accepted")).alias("rejected"), F.round(F.avg("score"), 4).alias("mean_score"))
        return {"evidence": evidence(found, self._read("chunks"), top_k), "rejected": rejected, "summary": summary}

    def retrieve(self, title: str, idea: str = "", top_k: int = TOP) -> DataFrame:
        return self.retrieve_with_diagnostics(title, idea, top_k)["evidence"]
