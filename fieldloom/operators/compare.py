"""Ranks of each query's target under two encoders, and the metrics of both."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.operators import tiles


def rank_delta(queries: DataFrame, corpus: DataFrame, encoders: dict[str, tuple[int, int]], digits: int = 6) -> DataFrame:
    """query_id, a rank for each encoder, and delta (first less last, above 0: it rose).

    queries: vec_id, embedding, target (its vector). An encoder is the slice of
    the vectors that it made. A rank is one more than the number of other
    documents that score above the target; tasks hand on such counts alone, one
    for all the documents they went through (see tiles).
    """
    q = queries.select(F.col("vec_id").cast("long").alias("i"), F.col("embedding").alias("v"), "target")
    c = corpus.select(F.col("vec_id").cast("long").alias("i"), F.col("embedding").alias("v"))

    def begin(q: tiles.Block) -> dict:
        return {"q": q, "goals": [np.round((q["v"][:, a:b] * q["target"][:, a:b].astype(np.float64)).sum(axis=1), digits) for a, b in encoders.values()], "above": [np.zeros(len(q["i"]), np.int64) for _ in encoders]}

    def step(state: dict, docs: tiles.Block) -> None:
        for (a, b), goal, above in zip(encoders.values(), state["goals"], state["above"], strict=True):
            sims = np.round(tiles.products(state["q"], docs, slice(a, b)), digits)
            above += np.count_nonzero(sims > goal[:, None], axis=1)

    def end(state: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (state["q"]["i"], *state["above"])], names=["query_id", *encoders])

    found = tiles.scan(q, c, begin, step, end, "query_id long, " + ", ".join(f"{e} long" for e in encoders))
    ranks = found.groupBy("query_id").agg(*((F.sum(e) + 1).alias(f"{e}_rank") for e in encoders))
    first, *_, last = encoders
    return ranks.withColumn("delta", F.col(f"{first}_rank") - F.col(f"{last}_rank"))


def base_and_tuned(ranks: DataFrame, base: str = "base_rank", tuned: str = "tuned_rank") -> DataFrame:
    """(metric, base, tuned, delta): means over the queries; no queries give zeros."""
    of = {"exact_match_at_1": lambda r: (r <= 1).cast("double"), "recall_at_5": lambda r: (r <= 5).cast("double"), "mrr_at_10": lambda r: F.when(r <= 10, 1.0 / r).otherwise(0.0), "ndcg_at_10": lambda r: F.when(r <= 10, 1.0 / F.log2(r + 1.0)).otherwise(0.0)}
    mean = lambda f, c: F.round(F.coalesce(F.avg(f(F.col(c))), F.lit(0.0)), 6)
    one = ranks.agg(*(mean(f, c).alias(f"{m}|{c}") for m, f in of.items() for c in (base, tuned)))
    rows = F.explode(F.array(*(F.struct(F.lit(m).alias("metric"), F.col(f"`{m}|{base}`").alias("base"), F.col(f"`{m}|{tuned}`").alias("tuned")) for m in of))).alias("r")
    return one.select(rows).select("r.*", F.round(F.col("r.tuned") - F.col("r.base"), 6).alias("delta"))
