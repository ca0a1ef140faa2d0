"""Splits, samples, deduplication by key, counts and digests of tables."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldloom.functions.text import choice_key, normalise


def best_by_text(df: DataFrame, text: str, quality: str, order: str) -> DataFrame:
    """Of rows with one normalised text the one of highest quality, then lowest order."""
    best = df.groupBy(normalise(F.col(text)).alias("norm")).agg(F.min_by(order, F.struct((-F.col(quality)).alias("q"), F.col(order).alias("o"))).alias(order), F.count(F.lit(1)).alias("n_rows"))
    return best


def family_split(df: DataFrame, family: str, seed: str = "11", shares: tuple[float, float] = (0.8, 0.1)) -> DataFrame:
    """(family, split): families in hashed order, cut at the shares, truncated; the rest is test.

    The order goes by the first four digits of the hash: their counts, at most
    65,536 rows, say how many families come before, and each group is ranked on
    its own, so no task gets all families.
    """
    fams = df.select(family).distinct().withColumn("_k", choice_key(seed, F.col(family)))
    fams = fams.withColumn("_head", F.substring("_k", 1, 4))
    heads = fams.groupBy("_head").agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy(F.lit(0)).orderBy("_head").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    heads = heads.select("_head", (F.sum("_n").over(upto) - F.col("_n")).alias("_before"), F.sum("_n").over(Window.partitionBy(F.lit(0))).alias("_all"))
    nth = F.col("_before") + F.row_number().over(Window.partitionBy("_head").orderBy("_k", family))
    df = fams.join(F.broadcast(heads), "_head").withColumn("_nth", nth)  # at most 65,536 rows
    train, val = (F.floor(F.col("_all") * F.lit(x)) for x in shares)
    return df.select(family, F.when(F.col("_nth") <= train, "train").when(F.col("_nth") <= train + val, "val").otherwise("test").alias("split"))


def route_split(world_split, split):
    s = F.lower(F.coalesce(F.nullif(world_split, F.lit("")), F.nullif(split, F.lit("")), F.lit("train")))
    return F.when(s.isin("train", "val", "test"), s).otherwise("train")


def sample(df: DataFrame, key: str, n: int = 20, seed: str = "12") -> DataFrame:
    return df.orderBy(choice_key(seed, F.col(key)), key).limit(n)


def slices(rows: DataFrame, keys: dict[str, str], values: list[str]) -> DataFrame:
    """(slice, n, means): every row counts in one slice for each key, ``name:value``."""
    tags = F.array(*(F.concat(F.lit(f"{name}:"), F.coalesce(F.col(c).cast("string"), F.lit("unknown"))) for name, c in keys.items()))
    return rows.select(F.explode(tags).alias("slice"), *values).groupBy("slice").agg(F.count(F.lit(1)).alias("n"), *(F.round(F.avg(v), 6).alias(f"avg_{v}") for v in values))


def content_hash(df: DataFrame, group: str, key: str, text: str) -> DataFrame:
    """(group, digest): sha256 over each group's texts in key order, a line each.

    A digest needs its texts in order, so a group streams through one task,
    sorted by the exchange and never held.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest, done = None, None, []
        for batch in batches:
            for g, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if digest is None or g != now:
                    if digest is not None:
                        done.append((now, digest.hexdigest()))
                    now, digest = g, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update((t.as_py() or "").encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in done], batch.schema.field(0).type), pa.array([x for _, x in done])], names=[group, "digest"])
                kind, done = batch.schema.field(0).type, []
            kind = batch.schema.field(0).type
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], kind), pa.array([digest.hexdigest()])], names=[group, "digest"])

    rows = df.select(group, F.col(text).cast("string").alias("_text"), F.col(key).alias("_key")).repartition(group).sortWithinPartitions(group, "_key", "_text").select(group, "_text")
    return rows.mapInArrow(run, f"`{group}` {dict(df.dtypes)[group]}, digest string")


def structural_digest(corpus: DataFrame) -> DataFrame:
    """(digest): sha256 over the ids and four views of a corpus in id order, a line each and one at the end."""
    line = F.concat_ws("\n", "doc_id", *(F.coalesce(c, F.lit("")) for c in ("coordinate_text", "field_signature_text", "field_semantic_text", "sdl_snippet_text")), F.lit(""))
    rows = corpus.select(F.lit(0).alias("_all"), "doc_id", line.alias("line"))
    # each line ends in a break, which the join of lines adds to all but the last
    rows = rows.withColumn("line", F.expr("left(line, length(line) - 1)")).unionByName(corpus.sparkSession.range(1).select(F.lit(0).alias("_all"), F.lit("\U0010ffff").alias("doc_id"), F.lit("").alias("line")))
    return content_hash(rows, "_all", "doc_id", "line").select("digest")


def stage_counts(df: DataFrame, group: str, stages: list[tuple[str, object]]) -> DataFrame:
    """Rows of each group that pass the stages up to each, in one pass."""
    passed, out = F.lit(True), []
    for name, ok in stages:
        passed = passed & ok
        out.append(F.sum(passed.cast("long")).alias(name))
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("raw"), *out)


def best_epoch(df: DataFrame, suite: str, epoch: str, score: str) -> DataFrame:
    """Each suite's epoch of the highest score, the earliest of equal ones."""
    return df.groupBy(suite).agg(F.min_by(epoch, F.struct((-F.col(score)).alias("s"), F.col(epoch).alias("e"))).alias("best_epoch"), F.max(score).alias("best_score"))
