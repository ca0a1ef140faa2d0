"""Shared helpers: durable intermediate tables and Arrow row loops."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space as the contracts spell it.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share; a temporary one only where none is set and the master is local (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="fieldloom-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write a Parquet table to the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/fieldloom/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(col: str | Column = "text") -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def per_batch(make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | Iterator[pa.RecordBatch]]]):
    """mapInArrow function from a factory that is called once a task, to load what its batches share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = make()
        for batch in batches:
            got = one(batch)
            if isinstance(got, pa.RecordBatch):
                yield got
            else:
                yield from got

    return run


def width(spark: SparkSession) -> int:
    """Reducers for large exchanges, as the session is set."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


#: A class with more than one part in so many of the rows is joined by broadcast: there are fewer such classes than this.
HOT_SHARE = 1024
#: Values a prefilter may broadcast, whatever the size of the tables.
BUCKETS = 1 << 20


def attach(rows: DataFrame, classes: DataFrame, keys: list[str], size: str = "group_size", n: int | None = None, how: str = "left") -> DataFrame:
    """rows joined with classes (one row a key), left or inner, without a hot key in one task.

    The rows of classes that hold over 1/HOT_SHARE of all rows meet their class
    by broadcast, of under HOT_SHARE rows; the others by a shuffled join, where
    no key has more rows than that share.
    """
    n = rows.count() if n is None else n
    hot = F.broadcast(classes.filter(F.col(size) * HOT_SHARE > n))
    rest = classes.filter(F.col(size) * HOT_SHARE <= n)
    return rows.join(hot, keys).unionByName(rows.join(hot.select(*keys), keys, "left_anti").join(rest, keys, how))


def only(rows: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows whose key is in ids (distinct, one column): a semi-join that shuffles few others.

    First the keys' hashes modulo BUCKETS, at most that many values, are
    broadcast to drop most rows that have no partner; then the semi-join proper.
    With very many ids the first step passes everything and the second is exact.
    """
    slot = lambda c: F.pmod(F.xxhash64(c.cast("long")), F.lit(BUCKETS)).cast("int")
    slots = F.broadcast(ids.select(slot(F.col(key)).alias("_slot")).distinct())
    near = rows.withColumn("_slot", slot(F.col(key))).join(slots, "_slot", "left_semi").drop("_slot")
    return near.join(ids, key, "left_semi")


#: What a null doc_id counts as where ids are ordered: after all others.
LAST_ID = (1 << 63) - 1


def row_key(doc_id: str | Column = "doc_id", text: str | Column = "text") -> list[Column]:
    """(did, h, b): a row by its id and text. Rows that agree on it are copies of one another."""
    text = text_or_empty(text)
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return [F.coalesce(doc_id.cast("long"), F.lit(LAST_ID)).alias("did"), F.xxhash64(text).alias("h"), F.octet_length(text).cast("long").alias("b")]


def keep_one(docs: DataFrame, classes: DataFrame, keys: list[str]) -> DataFrame:
    """docs with one row of each class: of the least id (nulls last), and of its rows the one of least text hash.

    classes: (did, h, b, *keys), a row for each row of docs that has a class.
    Rows are told apart by id and text, not by id alone. Only classes of several
    rows are looked up, and only rows whose text hash can be among them take
    part in that join.
    """
    key = ["did", "h", "b"]
    me = F.struct(*key)
    multi = classes.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min(me).alias("best")).filter("n > 1")
    met = attach(classes, multi, keys, "n", how="inner")
    met = met.groupBy(*key).agg(F.max(me == F.col("best")).alias("wins"), F.count(F.lit(1)).alias("copies"))
    met = materialize(met, "told-rows").select(*(F.col(c).alias(f"_fl_{c}") for c in (*key, "wins", "copies")))
    keys = [f"_fl_{c}" for c in key]
    slot = F.pmod(F.col("_fl_h"), F.lit(BUCKETS)).cast("int")
    slots = F.broadcast(met.select(slot.alias("_fl_slot")).distinct())  # at most BUCKETS rows
    rows = docs.select("*", *(c.alias(f"_fl_{n}") for c, n in zip(row_key(), key, strict=True))).withColumn("_fl_slot", slot)
    apart = rows.join(slots, "_fl_slot", "left_anti").select(*docs.columns)
    told = attach(rows.join(slots, "_fl_slot", "left_semi"), met, keys, "_fl_copies")
    lone = told.filter("_fl_wins is null or (_fl_wins and _fl_copies = 1)").select(*docs.columns)
    first = told.filter("_fl_wins and _fl_copies > 1").dropDuplicates(keys).select(*docs.columns)
    return apart.unionByName(lone).unionByName(first)
