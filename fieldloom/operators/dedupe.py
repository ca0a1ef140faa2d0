"""Semantic deduplication: greedy in row order, as the first maximal independent set of the similarity graph."""

from __future__ import annotations

import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldloom.functions.text import bucket, words

BUCKETS, BLOCK = 512, 2048


def kept(df: DataFrame) -> DataFrame:
    """df behind a checkpoint in the session's shared folder; a temporary one only where none is set and the master is local."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="fieldloom-"))
    return df.checkpoint()


def hash_vectors(df: DataFrame, key: str, text: str, size: int = BUCKETS) -> DataFrame:
    """(key, embedding): unit vectors of token counts by bucket; a blank text has zeros."""
    cells = F.transform(words(F.coalesce(text, F.lit(""))), lambda t: bucket(t, size).cast("int"))
    counts = F.aggregate(cells, F.array_repeat(F.lit(0.0), size), lambda v, b: F.concat(F.slice(v, F.lit(1), b), F.array(F.get(v, b) + 1.0), F.slice(v, b + 2, F.lit(size))))
    norm = F.sqrt(F.aggregate("c", F.lit(0.0), lambda s, x: s + x * x)) + 1e-9
    return df.select(key, counts.alias("c")).select(key, F.transform("c", lambda x: (x / norm).cast("float")).alias("embedding"))


def cosine(x: Column, y: Column) -> Column:
    return F.aggregate(F.zip_with(x, y, lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0), lambda s, v: s + v)


def family_pairs(vectors: DataFrame, key: str, least: float, family: str) -> DataFrame:
    """(a, b), a < b by key: pairs of one family of cosine ``least`` or more. A family's blocks meet as matrix products."""
    cuts = vectors.groupBy(family).agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("cuts"))
    rows = vectors.join(cuts, family).groupBy(family, F.pmod(F.xxhash64(key), "cuts").alias("block")).agg(F.collect_list(F.struct(F.col(key).cast("long").alias("i"), F.col("embedding").alias("v"))).alias("rows"))
    side = lambda n: rows.select(family, F.col("rows.i").alias(f"{n}_ids"), F.flatten("rows.v").alias(f"{n}_vecs"))

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                qi, qv, ci, cv = (batch.column(batch.schema.get_field_index(n))[row].values.to_numpy(zero_copy_only=False) for n in ("q_ids", "q_vecs", "c_ids", "c_vecs"))
                i, j = np.nonzero((qi[:, None] < ci[None, :]) & (qv.reshape(len(qi), -1) @ cv.reshape(len(ci), -1).T >= least))
                yield pa.RecordBatch.from_arrays([pa.array(qi[i]), pa.array(ci[j])], names=["a", "b"])

    return side("q").join(side("c"), family).select("q_ids", "q_vecs", "c_ids", "c_vecs").mapInArrow(run, "a long, b long")


def close_pairs(vectors: DataFrame, key: str, least: float) -> DataFrame:
    """(a, b), a < b by key: pairs of cosine ``least`` or more, of unit vectors.

    Cells are put in order of how few vectors fill them. A vector's first cells,
    up to where the rest has a norm under ``least``, are its prefix: two vectors
    that share no cell of their prefixes are further apart than that, so only
    vectors that meet in one are compared.
    """
    cells = vectors.select(key, F.posexplode("embedding").alias("cell", "w")).filter("w <> 0")
    rare = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("often"))  # a row a cell
    listed = cells.join(F.broadcast(rare), "cell").groupBy(key).agg(F.array_sort(F.collect_list(F.struct("often", "cell", "w"))).alias("c"))
    # the squared norm that is left before each cell
    mass = F.aggregate("c", F.array(F.lit(1.0)), lambda s, x: F.concat(s, F.array(F.element_at(s, -1) - x["w"].cast("double") * x["w"].cast("double"))))
    prefix = F.filter(F.arrays_zip("c", F.slice(mass, F.lit(1), F.size("c")).alias("left")), lambda x: x["left"] >= (least - 1e-6) ** 2)
    entry = listed.select(key, F.explode(prefix).alias("p")).select(key, F.col("p.c.cell").alias("cell"))
    pairs = entry.select(F.col(key).alias("a"), "cell").join(entry.select(F.col(key).alias("b"), "cell"), "cell").filter("a < b").select("a", "b").distinct()
    v = vectors.select(F.col(key).alias("k"), "embedding")
    both = pairs.join(v.select(F.col("k").alias("a"), F.col("embedding").alias("x")), "a").join(v.select(F.col("k").alias("b"), F.col("embedding").alias("y")), "b")
    return both.filter(cosine(F.col("x"), F.col("y")) >= least).select("a", "b")


def first_independent_set(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(n): the nodes a greedy walk in their order keeps: those without a kept smaller neighbour.

    In each round every open node without an open smaller neighbour stays, and
    its larger neighbours go.
    """
    open_, edges, out = kept(nodes.select("n")), kept(pairs.select("a", "b")), None
    while True:
        stay = open_.join(edges.select(F.col("b").alias("n")).distinct(), "n", "left_anti")
        gone = edges.join(stay.select(F.col("n").alias("a")), "a", "left_semi").select(F.col("b").alias("n")).distinct()
        stay = kept(stay)
        out = stay if out is None else out.unionByName(stay)
        open_ = kept(open_.join(stay, "n", "left_anti").join(gone, "n", "left_anti"))
        if not open_.limit(1).count():
            return out
        live = open_.select("n")
        edges = kept(edges.join(live.withColumnRenamed("n", "a"), "a", "left_semi").join(live.withColumnRenamed("n", "b"), "b", "left_semi"))


def semantic_dedupe(rows: DataFrame, key: str, text: str, family: str, least: float = 0.9, cap: int = 4) -> DataFrame:
    """The rows kept: families of over ``cap`` rows keep their first diverse ones, then near texts of all survivors go, in key order.

    key is a distinct long that gives the order. A null family is the empty one.
    Of equal vectors the first alone takes part in the second pass, as the
    others go whether it stays or not; blank texts are near nothing.
    """
    of = rows.select(F.col(key).cast("long").alias("n"), F.coalesce(F.col(family).cast("string"), F.lit("")).alias("family"), F.col(text).alias("text"))
    vectors = kept(hash_vectors(of, "n", "text"))
    large = of.join(of.groupBy("family").count().filter(F.col("count") > cap).select("family"), "family", "left_semi")
    diverse = first_independent_set(large, family_pairs(vectors.join(large.select("n", "family"), "n"), "n", least, "family"))
    nth = F.row_number().over(Window.partitionBy("family").orderBy("n"))
    capped = of.select("n", "family").join(diverse, "n", "left_semi").withColumn("nth", nth).filter(F.col("nth") <= cap).select("n")
    survivors = kept(of.select("n").join(large.select("n"), "n", "left_anti").unionByName(capped))
    left = vectors.join(survivors, "n", "left_semi")
    blank = left.filter(cosine(F.col("embedding"), F.col("embedding")) == 0)
    firsts = kept(left.join(blank.select("n"), "n", "left_anti").groupBy("embedding").agg(F.min("n").alias("n")))
    last = first_independent_set(firsts.select("n"), close_pairs(firsts, "n", least)).unionByName(blank.select("n"))
    return rows.join(last.withColumnRenamed("n", key), key, "left_semi")
