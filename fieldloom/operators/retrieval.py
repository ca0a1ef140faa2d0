"""Exact top-k by inner product, in blocks, and the metrics of rankings."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldloom.operators import tiles


def top_k(queries: DataFrame, corpus: DataFrame, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", digits: int = 6) -> DataFrame:
    """(query_id, doc_id, sim, rank) of each query's k nearest others; ties by id.

    A task keeps the k best so far of a block of queries while it goes through
    its documents (see tiles), so neither the similarity matrix nor a side is
    held whole.
    """
    side = lambda df: df.select(F.col(id_col).cast("long").alias("i"), F.col(vec_col).alias("v"))

    def begin(q: tiles.Block) -> dict:
        return {"q": q, "best": tiles.Best(len(q["i"]), k, digits)}

    def step(state: dict, docs: tiles.Block) -> None:
        state["best"].add(tiles.products(state["q"], docs), docs["i"])

    def end(state: dict) -> pa.RecordBatch:
        best = state["best"]
        return pa.RecordBatch.from_arrays([pa.array(state["q"]["i"][best.row]), pa.array(best.doc), pa.array(best.sim)], names=["query_id", "doc_id", "sim"])

    found = tiles.scan(side(queries), side(corpus), begin, step, end, "query_id long, doc_id long, sim double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("sim"), "doc_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def recall_at(rank: Column, k: int) -> Column:
    return F.when(rank <= k, 1.0).otherwise(0.0)


def mrr_at(rank: Column, k: int) -> Column:
    return F.when(rank <= k, 1.0 / rank).otherwise(0.0)


def ndcg_at(rank: Column, k: int) -> Column:
    return F.when(rank <= k, 1.0 / F.log2(rank + 1.0)).otherwise(0.0)


def per_query(ranked: DataFrame, truth: DataFrame) -> DataFrame:
    """One row a query of truth (query_id, label, positive, n_relevant) over ranked (query_id, doc_id, rank, relevant)."""
    hits = ranked.join(truth.select("query_id", "positive"), "query_id").groupBy("query_id").agg(
        F.min(F.when(F.col("doc_id") == F.col("positive"), F.col("rank"))).alias("rank"),
        F.max(F.when(F.col("rank") == 1, F.col("relevant").cast("int"))).alias("top1"),
        F.sum(F.when(F.col("rank") <= 5, F.col("relevant").cast("int"))).alias("hits5"),
        F.sum(F.col("relevant").cast("int")).alias("hits10"),
    )
    return truth.join(hits, "query_id", "left").select("query_id", "label", "n_relevant", "rank", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("top1", "hits5", "hits10")))


def summarise(rows: DataFrame) -> DataFrame:
    """Metric means by label, and over all (label null), which is nought for an empty input."""
    r = F.col("rank")
    mean = lambda c, name: F.round(F.coalesce(F.avg(c), F.lit(0.0)), 6).alias(name)
    of = [
        F.count(F.lit(1)).alias("n"), mean(recall_at(r, 1), "recall_at_1"), mean(recall_at(r, 5), "recall_at_5"), mean(recall_at(r, 10), "recall_at_10"), mean(mrr_at(r, 10), "mrr_at_10"), mean(ndcg_at(r, 10), "ndcg_at_10"),
        mean(F.col("top1"), "exact_match_at_1"), mean((F.col("hits5") > 0).cast("int"), "set_recall_any_at_5"), mean(F.when(F.col("n_relevant") > 0, F.col("hits10") / F.col("n_relevant")).otherwise(0.0), "coverage_at_10"),
    ]
    every = rows.agg(*of)
    return rows.groupBy("label").agg(*of).unionByName(every.select(F.lit(None).cast(dict(rows.dtypes)["label"]).alias("label"), *every.columns))
