"""Batch logs as a stream: each (world, batch) is appended once, across restarts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

LOG = "world_id string, batch int, requested int, taken_items int, at timestamp"


def append_batches(spark: SparkSession, folder: str, table: str, checkpoint: str, schema: str = LOG, late: str = "1 day") -> StreamingQuery:
    """Reads new JSON-lines files of a folder and appends their batches to a Parquet table, in one run over what is there.

    Repeats of a batch within ``late`` of each other are dropped by state that
    the watermark bounds; torn lines are skipped.
    """
    rows = spark.readStream.schema(schema).option("mode", "DROPMALFORMED").json(folder).filter("world_id is not null and batch is not null")
    once = rows.withWatermark("at", late).dropDuplicatesWithinWatermark(["world_id", "batch"])
    return once.writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def finish(spark: SparkSession, plan: DataFrame, table: str, keys: tuple[str, ...] = ("world_id", "batch")) -> bool:
    """Delete a log that holds every batch of a plan; whether it did. A log that lacks some stays, for the next run."""
    done = spark.read.parquet(table).select(*keys)
    if plan.select(*keys).join(done, list(keys), "left_anti").limit(1).count():
        return False
    path = spark._jvm.org.apache.hadoop.fs.Path(table)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
