"""Exact duplicates by a tree-merge of sorted digest runs.

Every partition turns its rows into a sorted run of (digest, smallest id, count).
Runs are then exchanged in binomial rounds of recursive halving: in round r a
node keeps the part of its run whose digest has the node's own r-th digit and
sends the other parts to the nodes that differ from it in that digit alone. A
node merges the ``fan_in`` sorted runs it gets and retains the smallest id of
each verified digest. After log(nodes) rounds node i holds range i of the
digest space, merged over all partitions: no root task sees all digests, and a
group of copies shrinks to one row per node at every level.

A digest is verified by the length and an independent 64-bit hash of the same
text, which travel with it: only rows equal in all three are one class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import SPACE, attach, keep_one, materialize, row_key, text_or_empty, width

KEY = ["sha", "n_bytes", "check"]
RUN = "node int, sha binary, n_bytes long, check long, keep_id long, group_size long"


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, sha, n_bytes, check) of each text with white-space runs made one space; null is empty."""
    plain = F.regexp_replace(text_or_empty(text_col), SPACE, " ")
    return docs.select(F.col(id_col).alias("doc_id"), plain.alias("plain")).select("doc_id", F.unhex(F.sha2("plain", 256)).alias("sha"), F.octet_length("plain").cast("long").alias("n_bytes"), F.xxhash64("plain").alias("check"))


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge sorted rows of equal keys: least id, summed counts. The last key waits for the next batch."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        n = batch.num_rows
        new = np.ones(n, bool)
        if n > 1:
            same = np.ones(n - 1, bool)
            for name in KEY:
                c = batch.column(name)
                same &= pa.compute.equal(c.slice(1), c.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            new[1:] = ~same
        at = np.flatnonzero(new)
        ids = batch.column("keep_id").fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)
        least, total = np.minimum.reduceat(ids, at), np.add.reduceat(batch.column("group_size").to_numpy(zero_copy_only=False), at)
        out = batch.take(pa.array(at))
        none = least == np.iinfo(np.int64).max
        out = pa.RecordBatch.from_arrays([*out.columns[:4], pa.array(least, mask=none), pa.array(total)], schema=batch.schema)
        if len(at) > 1:
            yield out.slice(0, len(at) - 1)
        held = out.slice(len(at) - 1)
    if held is not None:
        yield held


def _leaf(nodes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node = TaskContext.get().partitionId() % nodes
        for batch in _merge(batches):
            yield batch.set_column(0, batch.schema.field(0), pa.array(np.full(batch.num_rows, node, np.int32)))

    return run


def merge_runs(runs: DataFrame, fan_in: int = 4) -> DataFrame:
    """Classes (sha, n_bytes, check, keep_id, group_size) of rows (doc_id, sha, n_bytes, check)."""
    rounds = 1
    while fan_in**rounds < width(runs.sparkSession):
        rounds += 1
    nodes = fan_in**rounds
    run = runs.select(F.lit(0).alias("node"), *KEY, F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
    run = run.sortWithinPartitions(*KEY).mapInArrow(_leaf(nodes), RUN)
    # base-fan_in digits of the digest's first four bytes name the node that ends up with it
    home = F.pmod(F.conv(F.hex(F.substring("sha", 1, 4)), 16, 10).cast("long"), F.lit(nodes))
    for r in range(rounds):
        unit = fan_in**r
        digit = lambda x: F.pmod(F.floor(x / unit), F.lit(fan_in))
        run = run.withColumn("node", (F.col("node") + (digit(home) - digit(F.col("node"))) * unit).cast("int"))
        run = run.repartitionById(nodes, "node").sortWithinPartitions(*KEY).mapInArrow(_merge, RUN)
    return run.drop("node")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan_in: int = 4) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Null text counts as empty, and all empty texts are one group. Rows that
    repeat a doc_id with the same text share one verdict and each counts in
    group_size; a null doc_id never stays while its group has another id.
    Other columns are not read.
    """
    own = materialize(digests(docs, id_col, text_col), "digests")
    classes = materialize(merge_runs(own, fan_in).filter("group_size > 1"), "digest-classes")
    joined = attach(own, classes, KEY)
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select("doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"), F.col("doc_id").eqNullSafe(keep).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """docs with one row of each text: that of the least doc_id, whatever its columns; nulls come last.

    Rows go one by one, so a row stays if its text is the first of its kind even
    where another row has its doc_id, and of several equal rows one stays. Null
    and empty texts are one group. An empty table stays empty.
    """
    own = docs.select(F.col("doc_id").alias("_id"), text_or_empty().alias("_text"))
    plain = own.select("_id", "_text", F.regexp_replace("_text", SPACE, " ").alias("plain"))
    rows = materialize(plain.select(*row_key("_id", "_text"), F.unhex(F.sha2("plain", 256)).alias("sha"), F.octet_length("plain").cast("long").alias("n_bytes"), F.xxhash64("plain").alias("check")), "digests")
    several = merge_runs(rows.withColumnRenamed("did", "doc_id")).filter("group_size > 1").select(*KEY, "group_size")
    return keep_one(docs, attach(rows, materialize(several, "digest-classes"), KEY, how="inner"), KEY)
