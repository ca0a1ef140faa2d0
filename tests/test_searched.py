"""Tiers and margins of a corpus without its ranking equal those of the whole ranking."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fieldloom.operators import mining, retrieval, tiles
from fieldloom.plans.catalog import QUERIES


@pytest.fixture
def small(monkeypatch):
    for name, n in (("QUERY_ROWS", 8), ("CORPUS_ROWS", 16), ("TASK_DOCS", 50), ("TASK_QUERIES", 10)):
        monkeypatch.setattr(tiles, name, n)


@pytest.fixture(scope="module")
def vectors(spark):
    """Many equal products; owners of 1 to 60 vectors, and vectors without one."""
    x = np.random.default_rng(4).integers(-1, 2, (150, 4)).astype(float)
    owner = [None if i % 13 == 0 else i if i % 11 == 0 else i % 2 for i in range(150)]
    return spark.createDataFrame([(i, row.tolist(), owner[i], i % 4) for i, row in enumerate(x)], "vec_id long, embedding array<float>, owner int, field int")


def test_tiers(spark, small, vectors):
    asked = vectors.filter("vec_id % 5 = 0")
    whole = retrieval.top_k(asked, vectors, 150)
    of = lambda n: vectors.select(F.col("vec_id").alias(n), F.col("owner").alias(f"{n}_o"), F.col("field").alias(f"{n}_f"))
    judged = whole.join(of("query_id"), "query_id").join(of("doc_id"), "doc_id").withColumn("same_owner", F.coalesce(F.expr("query_id_o = doc_id_o"), F.lit(False))).withColumn("same_field", F.expr("query_id_f = doc_id_f"))
    want = sorted(tuple(r) for r in mining.tiered(judged.select("query_id", "doc_id", "rank", "same_owner", "same_field"), 3).collect())
    assert sorted(tuple(r) for r in mining.tiered_search(asked, vectors, 3).collect()) == want
    assert {t for *_, t in want} == set(mining.TIERS)


def test_standings(spark, small, vectors):
    target = F.when(F.col("vec_id") % 15 != 0, F.lit(3))  # others have none
    goals = vectors.select(F.col("vec_id").alias("target"), F.col("embedding").alias("target_embedding"))
    asked = vectors.filter("vec_id % 5 = 0").withColumn("target", target).join(goals, "target", "left")
    scores = retrieval.top_k(asked, vectors, 150).select(F.col("query_id").alias("item"), "doc_id", "sim", ((F.col("doc_id") == 3) & (F.col("query_id") % 15 != 0)).alias("is_target"))
    columns = ["item", "n", "at", "target", "s1", "s2", "first"]
    rows = lambda df: sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda r: r[0])
    assert rows(mining.searched_standings(asked, vectors)) == rows(mining.standings(scores))


@pytest.mark.parametrize("name", ["tiered_negatives", "margin_buckets", "stratified_items", "stratified_worlds"])
def test_no_whole_ranking(spark, monkeypatch, name):
    """None of these asks for as many neighbours as the corpus has."""
    def refuse(*args, **kwargs):
        raise AssertionError("a ranking is made")

    monkeypatch.setattr(retrieval, "top_k", refuse)
    assert QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0
