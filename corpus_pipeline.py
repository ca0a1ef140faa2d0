"""The corpus pipeline: toxicity, exact and near duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before
kept; every stage but the last returns the columns of documents, whatever more
there are. Rows are judged one by one, by their own texts: ids may be null or
repeat. No rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fieldloom.llm.common import materialize, table
from fieldloom.llm.exact_dedup import drop_exact_duplicates
from fieldloom.llm.mixing import mix_documents
from fieldloom.llm.near_dedup import drop_near_duplicates
from fieldloom.llm.packing import pack
from fieldloom.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows called toxic go; null and empty texts stay."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for white space the row of the least id stays, nulls last, and one of equal rows; null is empty."""
    return drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of texts at 0.8 or more by five-word shingles one row stays, as above; texts without words stay."""
    return drop_near_duplicates(docs, k=5, share=80)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the rates say that bring the expected tokens of the quality domains to their targets; null and empty texts have no tokens and a rate all the same."""
    return mix_documents(docs, table(spark, sf_dir, "labels"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows with their places in sequences; a null or empty text is its end id."""
    return pack(docs)


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("mixing", mixing), ("packing", packing)]

#: No stage is expressible in SQL (trained models, hashed sketches, best fit): tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
