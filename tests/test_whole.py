"""Registered queries read whole texts: small tables whose telling words stand late."""

import pytest

from fieldloom.plans.catalog import QUERIES

LONG = " ".join(f"word{i}" for i in range(20))


@pytest.fixture(scope="module")
def late(spark, tmp_path_factory):
    to = str(tmp_path_factory.mktemp("late"))
    rows = [(1, f"{LONG}\n something", "en", "s0"), (2, f"{LONG} one", "en", "s0"), (3, f"{LONG} two", "en", "s0"), (4, f"{LONG}  TWO", "en", "s0"), (5, f"{LONG} schema", "en", "s0"), (6, "too short", "en", "s0")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{to}/documents.parquet")
    spark.createDataFrame([(3, 1), (2, 0)], "doc_id long, quality int").write.parquet(f"{to}/labels.parquet")
    return to


def rows(spark, late, name):
    return QUERIES[name](spark, late).collect()


def test_clear_queries(spark, late):
    assert sorted(r.doc_id for r in rows(spark, late, "clear_queries")) == [3, 4, 5]


def test_best_by_text(spark, late):
    assert sorted((r.doc_id, r.n_rows) for r in rows(spark, late, "best_by_text")) == [(1, 1), (2, 1), (3, 2), (5, 1), (6, 1)]


def test_text_functions(spark, late):
    got = {r.doc_id: r for r in rows(spark, late, "text_functions")}
    assert got[4].norm == f"{LONG} two" and got[4].n_words == 21 and got[1].norm.endswith("word19 something")


def test_bucket_vectors(spark, late):
    got = {r.doc_id: r for r in rows(spark, late, "bucket_vectors")}
    assert got[3].norm2 >= 21 and got[3].checksum == got[4].checksum != got[2].checksum


def test_query_variants(spark, late):
    got = [r for r in rows(spark, late, "query_variants") if r.place == 0]
    assert {r.doc_id: r.variant for r in got}[2] == f"Show the type of {LONG} one number?"


def test_variants_of_equal_rewrites(spark):
    """Of a query that two of the swaps change, three rewrites are left for the noisy forms, and all forms are there."""
    from pyspark.sql import functions as F

    from fieldloom.operators import generation

    df = spark.createDataFrame([("show the type  number?",)], "q string").select(generation.variants(F.col("q"), 99).alias("v"))
    base = ["show the type  number?", "list the type  number?", "show the type  num?"]
    forms = {f.strip() for b in base for f in (b, b.lower(), b.replace("?", ""), b.replace("  ", " "), b.replace("type", "typ"))}
    assert df.first().v == [base[0], *sorted(forms - {base[0]})]
    assert spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple").count("array_distinct") >= 2


def test_valid_items(spark, tmp_path):
    # difficulty, intent and positive of a row follow from its id: these pass all of their checks
    good = [d for d in range(1, 100) if d % 4 != 3 and d % 3 != 2][:3]
    docs = [(good[0], f"{LONG} schema"), (good[1], f"{LONG} zebrafish"), (good[2], f"{LONG} plain"), (50, "zebrafish")]
    spark.createDataFrame([(d, t, "en", "s0") for d, t in docs], "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(d, 1) for d in good], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(0, "a zebrafish")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [r.doc_id for r in QUERIES["valid_items"](spark, str(tmp_path)).collect()] == [good[2]]


def test_world_leakage(spark, tmp_path):
    docs = [(50, "zebrafish", "en", "s0")] + [(i, f"{LONG} {'zebrafish' if i < 3 else 'plain'}", "en", "s0") for i in range(1, 4)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(0, "a zebrafish")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert QUERIES["world_leakage"](spark, str(tmp_path)).count() == 0  # 3 of 4 leak


def test_stage_counts(spark, late):
    (got,) = rows(spark, late, "stage_counts")
    assert (got.raw, got.quality_ok, got.clear, got.deduped) == (6, 5, 3, 2)
