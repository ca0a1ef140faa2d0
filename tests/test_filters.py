from pyspark.sql import functions as F

from fieldloom.operators.filters import leak_flags, world_leakage


def test_world_without_terms_of_its_own(spark):
    """Such a world, the unknown one too, is held against the terms of all; one whose own terms say nothing isn't."""
    queries = spark.createDataFrame([(1, "a", "Where is the Invoice?"), (2, "b", "Where is the Invoice?"), (3, "b", "the invoice again"), (4, None, "an invoice"), (5, "", "nothing"), (6, "c", "an invoice"), (7, "d", "clean")], "id long, world string, query string")
    terms = spark.createDataFrame([("a", "shipment"), ("z", "Invoice"), ("c", "id")], "world string, term string")
    got = {r.id: (r.world, r.leaked) for r in world_leakage(queries, terms, 0.6).collect()}
    assert got == {1: ("a", 0), 4: ("unknown", 1), 5: ("unknown", 0), 6: ("c", 0), 7: ("d", 0)}


def test_texts_stay_where_they_lie(spark):
    """Four partitions of queries give four of flags, where joins of large tables are shuffled: texts aren't brought together."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    queries = spark.range(100).select("id", F.when(F.col("id") % 2 == 0, "w").alias("world"), F.when(F.col("id") % 5 == 0, "some Ledger").otherwise("plain words").alias("query")).repartition(4)
    got = leak_flags(queries, spark.createDataFrame([("w", "ledger"), ("v", "plain")], "world string, term string"))
    try:
        plan = spark._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "simple")
        counts = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan
    assert len(counts) == 4 and max(counts) < 40
    assert {r.id: r.leaked for r in got.collect()} == {i: int(i % 2 == 1 or i % 5 == 0) for i in range(100)}
