"""Queries against a corpus in tiles: small tiles and tasks give what all pairs in one matrix give."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldloom.operators import compare, retrieval, tiles


@pytest.fixture
def small(monkeypatch):
    for name, n in (("QUERY_ROWS", 8), ("CORPUS_ROWS", 16), ("TASK_DOCS", 50), ("TASK_QUERIES", 10)):
        monkeypatch.setattr(tiles, name, n)


def vectors(spark, n=150, dims=4, seed=1):
    """Vectors of few values, so that many products are equal and their order goes by id."""
    x = np.random.default_rng(seed).integers(-1, 2, (n, dims)).astype(float)
    return x, spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "vec_id long, embedding array<float>")


def ranking(x, q):
    sims = np.round(x @ x[q], 6)
    return sorted((d for d in range(len(x)) if d != q), key=lambda d: (-sims[d], d)), sims


@pytest.mark.parametrize("k", [1, 7, 60, 400])
def test_top_k_of_ties(spark, small, k):
    x, df = vectors(spark)
    got = retrieval.top_k(df.filter("vec_id % 5 = 0"), df, k).collect()
    for q in range(0, 150, 5):
        order, sims = ranking(x, q)
        assert [(r.doc_id, r.sim) for r in sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])] == [(d, sims[d]) for d in order[:k]]


def test_top_k_hands_on_a_block_not_a_tile(spark, small, monkeypatch):
    """Rows handed on are k a query and task, however many tiles its documents are."""
    monkeypatch.setattr(tiles, "TASK_DOCS", 1000)
    _, df = vectors(spark)
    seen = []
    real = tiles.scan
    monkeypatch.setattr(tiles, "scan", lambda *a: seen.append(real(*a)) or seen[-1])
    retrieval.top_k(df.filter("vec_id % 5 = 0"), df, 3)
    assert seen[0].count() == 30 * 3


def test_rank_delta_in_tiles(spark, small):
    x, df = vectors(spark)
    queries = df.filter("vec_id % 5 = 1").withColumn("target", F.col("embedding")).drop("embedding").join(df.filter("vec_id = 3").select("embedding"), how="cross").select("vec_id", F.col("target").alias("embedding"), F.col("embedding").alias("target"))
    got = {r.query_id: r.asDict() for r in compare.rank_delta(queries, df, {"base": (0, 2), "tuned": (0, 4)}).collect()}
    for q in range(1, 150, 5):
        for name, dims in (("base", 2), ("tuned", 4)):
            s = x[:, :dims] @ x[q, :dims]
            assert got[q][f"{name}_rank"] == 1 + sum(s[d] > s[3] for d in range(150) if d != q)


def test_no_rows(spark):
    _, df = vectors(spark, 5)
    assert retrieval.top_k(df.filter("vec_id < 0"), df, 3).count() == 0 == retrieval.top_k(df, df.filter("vec_id < 0"), 3).count()
