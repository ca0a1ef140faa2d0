"""Query generation and validation: templates, rewrites, intents of a field, checks of generated items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.functions.text import or_else, unwrap_type, words
from fieldloom.operators.filters import EVERYDAY

# fixed values: words that rewrites swap, domains of items, names that tell an intent, words of schema talk
SWAPS = {"show": "list", "find": "locate", "fetch": "retrieve", "explain": "describe", "difference": "compare", "information": "info", "identifier": "id", "number": "num", "query": "qry"}
PHRASES = {"graphql": "gql", "how do i": "how can i"}
DIFFICULTIES = ("easy", "medium", "hard")
INTENTS = ("lookup", "filtering", "authorship", "status", "temporal", "troubleshooting", "comparison", "list_vs_single", "root_vs_nested")
TEMPORAL_SUFFIXES, TEMPORAL_TYPES = ("At", "Date", "Time"), ("DateTime", "Date", "Timestamp", "Time")
NAMES = {
    "authorship": ("author", "authorId", "createdBy", "updatedBy", "owner", "ownerId", "writer", "editor", "assignee", "reporter"),
    "status": ("status", "state", "phase", "stage", "lifecycleStage", "orderStatus", "paymentStatus"),
    "troubleshooting": ("error", "errorMessage", "failureReason", "lastError", "errorCode"),
    "comparison": ("priceCents", "totalCents", "amountCents", "score", "rating", "rank", "count"),
    "filtering": ("tag", "tags", "category", "categoryId", "type", "kind", "priority", "severity"),
    "lookup": ("email", "phone", "name", "title", "description", "slug", "url", "handle", "sku", "barcode", "currency", "locale"),
}
SCALARS = ("String", "Int", "Float", "Boolean", "ID", "DateTime", "Date", "Timestamp", "JSON")
SCHEMA_TALK = ("field", "schema", "coordinate", "graphql", "column", "attribute", "property", "endpoint", "parameter", "which field", "what field", "same as the", "is the same as")


def rewrites(q: Column) -> Column:
    swapped = [F.regexp_replace(q, rf"(?i)\b{a}\b", b) for a, b in SWAPS.items()]
    return F.array(q, *swapped, *(F.replace(q, F.lit(a), F.lit(b)) for a, b in PHRASES.items()))


def noise(q: Column) -> Column:
    return F.array(q, F.lower(q), F.replace(q, F.lit("?"), F.lit("")), F.replace(q, F.lit("  "), F.lit(" ")), F.replace(q, F.lit("type"), F.lit("typ")))


def variants(q: Column, most: int = 6) -> Column:
    """The query itself, then up to ``most`` of its other rewrites and noisy forms, sorted.

    Most swaps find no word of theirs and leave the query as it is, so equal
    rewrites are told apart before each is given its noisy forms, and equal forms
    before they are trimmed.
    """
    q = F.trim(q)
    noisy = F.flatten(F.transform(F.array_distinct(F.transform(rewrites(q), F.trim)), noise))
    made = F.filter(F.transform(F.array_distinct(noisy), F.trim), lambda x: x != "")
    return F.concat(F.array(q), F.slice(F.array_sort(F.array_except(made, F.array(q))), 1, most))


def expand(queries: DataFrame, text: str = "query", most: int = 6) -> DataFrame:
    """A row a variant, with its place, source and score. Blank queries have none."""
    df = queries.filter(F.trim(text) != "").select("*", F.posexplode(variants(F.col(text), most)).alias("place", "variant"))
    return df.withColumn("origin", F.when(F.col("place") == 0, "bootstrap").otherwise("deterministic-augment")).withColumn("quality_score", F.when(F.col("place") == 0, 0.85).otherwise(0.65))


def from_templates(rows: DataFrame, templates: dict[str, list[str]], slots: dict[str, str]) -> DataFrame:
    """Each row under each template (intent -> texts), ``{slot}`` filled from its column."""
    listed = F.array(*(F.struct(F.lit(i).alias("intent"), F.lit(t).alias("t")) for i, ts in templates.items() for t in ts))
    df = rows.select("*", F.explode(listed).alias("_t"))
    text = F.col("_t.t")
    for slot, column in slots.items():
        text = F.replace(text, F.lit("{" + slot + "}"), F.coalesce(F.col(column).cast("string"), F.lit("")))
    return df.select(*rows.columns, F.col("_t.intent").alias("intent"), text.alias("query"))


def intents(name: Column, returns: Column) -> Column:
    """The intents that a field of this name and type can answer; a time answers no other."""
    kind = unwrap_type(returns)
    late = F.lit(False)
    for s in TEMPORAL_SUFFIXES:
        late = late | name.endswith(s)
    by_name = [F.when(name.isin(*own) | (name.endswith("By") if tag == "authorship" else F.lit(False)), F.lit(tag)) for tag, own in NAMES.items()]
    shape = [F.when(F.contains(returns, F.lit("[")), F.lit("list_vs_single")), F.when((kind != "") & ~kind.isin(*SCALARS), F.lit("root_vs_nested"))]
    found = F.array_compact(F.array(*by_name, *shape))
    return F.when(late | kind.isin(*TEMPORAL_TYPES), F.array(F.lit("temporal"))).when(F.size(found) > 0, found).otherwise(F.array(F.lit("lookup")))


def telling_terms(terms: DataFrame) -> DataFrame:
    """(world, terms array): of (world, term), lower-cased, the dotted ones of 5 characters and the others of 4 that aren't everyday words."""
    t = F.lower("term")
    return terms.filter((F.contains(t, F.lit(".")) & (F.length(t) >= 5)) | ((F.length(t) >= 4) & ~t.isin(*EVERYDAY))).groupBy("world").agg(F.collect_set(t).alias("terms"))


def valid_items(items: DataFrame, terms: DataFrame, known: DataFrame) -> DataFrame:
    """The items that pass, their lists cut to known coordinates.

    items: world, query, difficulty, intent, positive, relevant array, negative
    array. known: (world, coordinate). A world's coordinates are gathered as one
    array, which its schema bounds.
    """
    of = known.groupBy("world").agg(F.collect_set("coordinate").alias("_known"))
    df = items.join(telling_terms(terms), "world", "left").join(of, "world", "left")
    q = F.lower("query")
    talk = F.lit(False)
    for w in SCHEMA_TALK:
        talk = talk | F.contains(q, F.lit(w))
    names_it = F.coalesce(F.exists("terms", lambda t: F.contains(q, t)), F.lit(False))
    ok = F.col("difficulty").isin(*DIFFICULTIES) & F.col("intent").isin(*INTENTS) & (F.size(words(F.col("query"))) >= 3) & ~talk & ~names_it & F.array_contains("_known", F.col("positive"))
    inside = lambda c: F.filter(F.coalesce(c, F.array().cast("array<string>")), lambda x: F.array_contains("_known", x))
    relevant = inside(F.col("relevant"))
    out = df.filter(ok).withColumn("relevant", F.slice(F.when(F.size(relevant) > 0, relevant).otherwise(F.array("positive")), 1, 4))
    return out.withColumn("negative", F.slice(F.filter(inside(F.col("negative")), lambda x: x != F.col("positive")), 1, 8)).select(*items.columns)


def clipped(text: Column, most: int = 140) -> Column:
    return F.when(F.length(text) > most, F.concat(F.rtrim(F.left(text, F.lit(most - 1))), F.lit("…"))).otherwise(text)


def competitor_text(coordinate: Column, owner_description: Column, description: Column) -> Column:
    """A line of a prompt: the coordinate and its owner's description, or else its own."""
    return F.concat_ws(": ", coordinate, F.nullif(clipped(or_else(F.trim(owner_description), F.trim(description))), F.lit("")))
