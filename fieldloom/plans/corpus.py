"""The corpus: one row a field of a type record, with its text views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.functions.text import or_else
from fieldloom.plans import views


def build_corpus(types: DataFrame) -> DataFrame:
    """(doc_id, coordinate, owner_type, field_name, return_type, argument_signature, description, aliases, views, keywords_text) of every field."""
    df = types.select(F.col("type_name").alias("owner_type"), "type_kind", F.col("description").alias("owner_description"), F.explode("fields").alias("f"))
    o, f, r, args = F.col("owner_type"), F.col("f.name"), F.col("f.type_name"), F.col("f.args")
    where = views.coordinate(o, f)
    return df.select(
        where.alias("doc_id"), where.alias("coordinate"), "owner_type", f.alias("field_name"), r.alias("return_type"), views.arguments(args).alias("argument_signature"), F.col("f.description").alias("description"),
        F.array(F.lower(f), F.lower(F.replace(f, F.lit("_"), F.lit(" ")))).alias("aliases"), where.alias("coordinate_text"), views.signature(o, f, r, args).alias("field_signature_text"),
        views.semantic(o, f, r, F.col("f.description"), F.col("owner_description"), args).alias("field_semantic_text"), views.sdl(o, f, r, args).alias("sdl_snippet_text"), views.keywords(where, o, f, r).alias("keywords_text"), "type_kind", "owner_description",
    )


def view_text(view: str) -> Column:
    """The column of a view, with what stands in for it where it is blank."""
    first, other = {"coordinate": ("coordinate_text", "coordinate"), "signature": ("field_signature_text", "coordinate"), "semantic": ("field_semantic_text", "coordinate"), "sdl": ("sdl_snippet_text", "field_semantic_text")}[view]
    return or_else(F.col(first), F.col(other))


def assert_view(corpus: DataFrame, column: str) -> None:
    """Fails, naming up to five rows, where a view is blank."""
    bad = [r[0] for r in corpus.filter(F.trim(F.coalesce(column, F.lit(""))) == "").select("doc_id").limit(10).collect()]
    if bad:
        raise ValueError(f"{column} is blank for {len(bad)} rows or more, as {', '.join(map(str, bad[:5]))}: backfill the corpus")


def backfill(corpus: DataFrame, rebuilt: DataFrame) -> DataFrame:
    """Rows of the corpus with each column of the rebuilt row of that doc_id, where there is one."""
    new = rebuilt.select("doc_id", F.struct("*").alias("_new"))
    own = [c for c in corpus.columns if c != "doc_id"]
    fresh = set(rebuilt.columns)
    return corpus.join(new, "doc_id", "left").select("doc_id", *(F.coalesce(F.col(f"_new.{c}"), F.col(c)).alias(c) if c in fresh else F.col(c) for c in own))
