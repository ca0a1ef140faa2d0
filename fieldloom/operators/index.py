"""A stored vector index: its build, its reading and its search."""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.operators.dedupe import hash_vectors
from fieldloom.operators.retrieval import top_k
from fieldloom.plans.corpus import assert_view, view_text

SETTINGS = {"top_k_default": 10, "normalize_embeddings": True, "similarity": "cosine", "index_type": "exact-blocks"}


def encode(df: DataFrame, key: str, text: str, encoder=None) -> DataFrame:
    """(key, embedding): unit vectors of texts, by token buckets or by an encoder's ``encode(list of texts)`` on Arrow batches.

    The encoder is always the one that was asked for: there is no fallback.
    """
    if encoder is None:
        return hash_vectors(df, key, text)

    def run(batches):
        for batch in batches:
            v = np.asarray(encoder.encode([t.as_py() or "" for t in batch.column(1)]), np.float32).reshape(batch.num_rows, -1)
            v = v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(v), pa.list_(pa.float32()))], names=[key, "embedding"])

    return df.select(key, text).mapInArrow(run, f"`{key}` {dict(df.dtypes)[key]}, embedding array<float>")


def build_index(corpus: DataFrame, path: str, view: str = "sdl", encoder=None, encoder_id: str = "token-buckets-512") -> dict:
    """Write the vectors of a view with their documents as Parquet, and the settings as text; returns the settings.

    Fails where a row's view is blank. Rows get a long ``vec_id`` that the write
    fixes.
    """
    text = corpus.select("doc_id", "coordinate", view_text(view).alias("text"))
    assert_view(text, "text")
    rows = text.withColumn("vec_id", F.monotonically_increasing_id())
    rows.write.mode("overwrite").parquet(f"{path}/documents")
    rows = corpus.sparkSession.read.parquet(f"{path}/documents")
    encode(rows, "vec_id", "text", encoder).join(rows.select("vec_id", "doc_id", "coordinate"), "vec_id").write.mode("overwrite").parquet(f"{path}/vectors")
    settings = {**SETTINGS, "retrieval_view": view, "encoder_id": encoder_id}
    corpus.sparkSession.createDataFrame([(json.dumps(settings, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/settings")
    return settings


def read_index(spark: SparkSession, path: str) -> tuple[DataFrame, dict]:
    return spark.read.parquet(f"{path}/vectors"), json.loads(spark.read.text(f"{path}/settings").first()[0])


def search_index(queries: DataFrame, path: str, k: int | None = None, encoder=None) -> DataFrame:
    """(query_id, rank, coordinate, doc_id, sim) of the k best of each query (query_id long, query)."""
    vectors, settings = read_index(queries.sparkSession, path)
    asked = encode(queries.select((-1 - F.col("query_id")).alias("vec_id"), "query"), "vec_id", "query", encoder)
    found = top_k(asked, vectors.select("vec_id", "embedding"), k or settings["top_k_default"])
    return found.select((-1 - F.col("query_id")).alias("query_id"), "rank", F.col("doc_id").alias("vec_id"), "sim").join(vectors.select("vec_id", "coordinate", "doc_id"), "vec_id").select("query_id", "rank", "coordinate", "doc_id", "sim")
