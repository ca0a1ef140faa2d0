"""Row and group filters of a query table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.functions.text import alnum_tokens, camel_tokens, light_stem, normalise, words

# fixed values: phrases that leave a query unclear
VAGUE = ("something", "anything", "whatever", "some data", "etc")
# fixed values: names that are everyday words, and for leakage also common words of queries
EVERYDAY = (
    "id", "name", "type", "value", "data", "item", "list", "count", "total",
    "date", "time", "user", "post", "order", "cart", "hotel", "flight", "trip",
    "product", "catalog", "unit", "text", "body", "record", "mode", "state",
    "status", "created", "updated", "amount", "price", "active", "label",
    "title", "notes", "start", "email", "phone", "image", "score", "error",
    "token", "slug", "field", "when", "last", "update", "create", "creation", "unique",
    "identifier", "display", "number", "model", "case", "times", "member",
)
TRIVIAL = (
    *EVERYDAY,
    "which", "what", "this", "that", "with", "from", "have", "does", "used",
    "tell", "show", "give", "find", "look", "help", "need", "want", "know",
    "there", "here", "some", "only", "also", "more", "most", "many", "each",
    "been", "info", "read", "like", "make", "take", "come", "work", "year",
)
# fixed values: words of names that say nothing of their own in the strict test
NAMELESS = ("id", "name", "type", "value", "data", "item", "list", "count", "total", "date", "time")
# fixed values: names that every owner has
GENERIC = ("id", "createdat", "updatedat", "deletedat", "publishedat", "version", "type")


def min_quality(df: DataFrame, quality: str = "quality", least: float = 0.25) -> DataFrame:
    return df.filter(F.col(quality) >= least)


def is_clear(query: Column, positive: Column, word_boundary: bool = False) -> Column:
    """Four words or more, none of the vague phrases, and a positive that isn't blank."""
    q = normalise(query)
    vague = F.lit(False)
    for v in VAGUE:
        vague = vague | (q.rlike(rf"\b{v}\b") if word_boundary else q.contains(v))
    return (F.size(words(query)) >= 4) & ~vague & (F.coalesce(F.trim(positive), F.lit("")) != "")


def holds_any(text: Column, terms: Column) -> Column:
    """Whether the text holds one of an array of terms. The text is bound once: in a test of each term it would be made anew for each."""
    return F.get(F.transform(F.array(text), lambda x: F.exists(terms, lambda t: F.contains(x, t))), F.lit(0))


def leak_flags(queries: DataFrame, terms: DataFrame) -> DataFrame:
    """queries with leaked (0 or 1): whether the text holds one of its world's terms, or of all worlds' where the world has none.

    terms: (world, term). A null or empty world is "unknown". The terms are
    broadcast, a row a world and one of all, as they are bounded by the schemas;
    texts are read once, where they lie, and never shuffled or compared with
    each other.
    """
    told = F.lower("term")
    meant = (F.length("term") >= 4) & ~told.isin(*TRIVIAL)
    of = terms.groupBy(F.coalesce("world", F.lit("unknown")).alias("world")).agg(F.collect_set(F.when(meant, told)).alias("_terms"))
    every = terms.agg(F.collect_set(F.when(meant, told)).alias("_every"))
    df = queries.withColumn("world", F.coalesce(F.nullif(F.col("world"), F.lit("")), F.lit("unknown"))).join(F.broadcast(of), "world", "left").crossJoin(F.broadcast(every))
    leaked = F.coalesce(holds_any(F.lower("query"), F.coalesce("_terms", "_every")), F.lit(False)).cast("int")
    return df.withColumn("leaked", leaked).select(*queries.columns, "leaked")


def world_leakage(queries: DataFrame, terms: DataFrame, threshold: float = 0.2) -> DataFrame:
    """Queries of the worlds in which at most ``threshold`` of the queries leak, with their flag (see leak_flags).

    Shares are aggregated by world and joined back, so no world comes whole to a
    task.
    """
    flagged = leak_flags(queries, terms)
    ok = flagged.groupBy("world").agg(F.avg("leaked").alias("_share")).filter(F.col("_share") <= threshold).select("world")
    return flagged.join(ok, "world", "left_semi").select(*queries.columns, "leaked")


def good_synthetic(queries: DataFrame, text: str = "query", quality: str = "quality_score", least: float = 0.55) -> DataFrame:
    """Queries of at least this score and three words."""
    return queries.filter((F.col(quality) >= least) & (F.size(words(F.col(text))) >= 3))


def family_leakage(queries: DataFrame, names: DataFrame, threshold: float = 0.7, family: str = "family_id", text: str = "query") -> DataFrame:
    """Queries of the families in which no more than ``threshold`` of the queries hold a type's name.

    names: (name), the types of the schemas, which are broadcast as one row.
    Null families are one.
    """
    every = names.select(F.lower("name").alias("n")).filter("n <> ''").agg(F.collect_set("n").alias("_names"))
    flagged = queries.select(F.col(family).alias("_f"), F.lower(text).alias("_q")).crossJoin(F.broadcast(every))
    over = flagged.groupBy("_f").agg(F.avg(F.coalesce(holds_any(F.col("_q"), F.col("_names")), F.lit(False)).cast("int")).alias("share")).filter(F.col("share") > threshold)
    return queries.join(over, F.col(family).eqNullSafe(F.col("_f")), "left_anti")


# fixed values: names that no reader takes for a thing
UGLY = r"(?i)Extension\d+|(?i)^[a-z]+Input$|(?-i)Payload$|Connection$|Edge$"


def is_friendly(owner: Column, words_: tuple[str, ...]) -> Column:
    """A word of the owner's name is among those given, and the name isn't an ugly one."""
    parts = F.transform(F.regexp_extract_all(owner, F.lit("[A-Z][a-z]+|[a-z]+"), F.lit(0)), F.lower)
    return F.arrays_overlap(parts, F.array(*map(F.lit, words_))) & ~owner.rlike(UGLY)


def safe_aliases(aliases: Column, owner: Column, field: Column) -> Column:
    """The aliases that neither hold nor are held by the owner's or the field's name."""
    o, f = F.lower(owner), F.lower(field)
    return F.filter(F.coalesce(aliases, F.array().cast("array<string>")), lambda a: (a != "") & ~F.contains(o, F.lower(a)) & ~F.contains(f, F.lower(a)) & ~F.contains(F.lower(a), o) & ~F.contains(F.lower(a), f))


def require_real_rows(rows: DataFrame, source: str = "source", least: float = 0.9, real: tuple[str, ...] = ("openai-world-seed", "mock-seed")) -> DataFrame:
    """(source, n) of the rows; fails where under ``least`` of them come from a real source. No rows pass."""
    counts = rows.groupBy(F.coalesce(source, F.lit("unknown")).alias("source")).agg(F.count(F.lit(1)).alias("n"))
    total, good = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.when(F.col("source").isin(*real), F.col("n"))), F.lit(0))).first()
    if total and good / total < least:
        raise ValueError(f"{good} of {total} rows come from a real source, under {least:.0%}")
    return counts


def stems(tokens: Column) -> Column:
    return F.array_distinct(F.transform(F.filter(tokens, lambda x: (F.length(x) >= 3) & ~x.isin(*NAMELESS)), light_stem))


def query_stems(query: Column) -> Column:
    return F.array_distinct(F.transform(F.filter(alnum_tokens(query), lambda x: F.length(x) >= 3), light_stem))


def leaks_schema(query: Column, owner: Column, field: Column) -> Column:
    """The query shares a stem with the names of its target; names of trivial words alone never leak."""
    return F.arrays_overlap(query_stems(query), stems(F.concat(camel_tokens(owner), camel_tokens(field))))


def ambiguous_names(coords: DataFrame, generic: tuple[str, ...] = GENERIC, least: int = 2) -> DataFrame:
    """(field_name, owners): names that at least so many owners have."""
    return coords.select(F.lower("field_name").alias("field_name"), "owner_type").filter(~F.col("field_name").isin(*generic)).groupBy("field_name").agg(F.count_distinct("owner_type").alias("owners")).filter(F.col("owners") >= least)
