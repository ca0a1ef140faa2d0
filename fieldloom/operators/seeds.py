"""Seed rows: prompts, extraction and replay of answers, local generation, rows with tags of mining, curated rows."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldloom.functions.text import choice_key, field_of, or_else, owner_of, unwrap_type, words
from fieldloom.operators.filters import safe_aliases
from fieldloom.operators.generation import DIFFICULTIES, competitor_text, intents
from fieldloom.operators.mining import confusers
from fieldloom.operators.planning import pick

# fixed values: templates of queries by intent, from types and topics
TYPE_TEMPLATES = {
    "lookup": ["what is {type}", "show me details of {type}", "explain graphql type for {type}"],
    "capability": ["what can i query about {topic}", "which graphql type handles {topic}", "where do i fetch {topic}"],
    "filtering": ["how can i filter {topic}", "which type supports filtering {topic}"],
    "aggregation": ["how do i aggregate {topic}", "which type gives summary for {topic}"],
    "troubleshooting": ["query for {topic} returns null, which type should i use", "i cannot find {topic} in schema, where is it"],
    "comparative": ["difference between {type} and {other}", "when should i use {type} instead of {other}"],
}
# fixed values: templates of queries by intent, from hints
HINT_TEMPLATES = {
    "lookup": ["Where can I read the {hint}?", "Which field tells me the {hint}?"],
    "filtering": ["Which field should I use to filter by {hint}?", "I need a field for narrowing results by {hint}"],
    "authorship": ["Who is responsible for this {owner_label}?", "Who wrote the {owner_label}?"],
    "status": ["What field tells me whether this {owner_label} is active or pending?", "How do I read the current state of a {owner_label}?"],
    "temporal": ["When was this {owner_label} last updated?", "Which field tells me when the {owner_label} was created?"],
    "troubleshooting": ["I need the field that explains why this {owner_label} failed", "What field should I inspect when this {owner_label} looks wrong?"],
    "comparison": ["Which field helps compare one {owner_label} with another?", "What field would I inspect to compare {owner_label} records?"],
    "list_vs_single": ["Which field on the {owner_label} record gives me the specific {hint}?", "I already have the {owner_label}; what field returns the {hint}?"],
    "root_vs_nested": ["I already fetched the {owner_label}; which nested field gives me the {hint}?", "Not the root query, the field on {owner_label} that gives the {hint}"],
}
# fixed values: hints of well-known field names
HINTS = {
    "author": "person who wrote it", "authorId": "writer reference", "createdBy": "person who created it", "updatedBy": "person who last changed it", "owner": "person responsible", "ownerId": "responsible-party reference",
    "createdAt": "creation time", "updatedAt": "last update time", "deletedAt": "deletion time", "publishedAt": "publication time", "status": "current state", "state": "current state", "email": "contact address", "phone": "contact number",
    "name": "human-readable label", "title": "headline text", "description": "long-form text body", "currency": "monetary unit", "priceCents": "price amount", "totalCents": "total amount", "amountCents": "amount value", "id": "unique reference",
}
# fixed values: curated queries by field name: text, intent, slice
CURATED = {
    "author": [("Who wrote the record?", "authorship", "obvious"), ("I already have the object; which nested field tells me who owns it?", "root_vs_nested", "adversarial")],
    "status": [("Which field tells me the current state?", "status", "obvious"), ("Not the history, the field with the current status", "status", "sibling-field")],
    "createdAt": [("When was this record created?", "temporal", "obvious")],
    "updatedAt": [("When was this record last changed?", "temporal", "obvious")],
    "email": [("What field stores the email address?", "lookup", "obvious")],
}
# fixed values: source of a batch -> source of its rows, and their score
SOURCES = {"openai": ("openai-world-seed", 0.92), "mock": ("mock-seed", 0.6)}
OTHER_SOURCE = ("local-fallback", 0.3)
STYLES = {"plain": "a direct question about the data", "ellipsis": "a few words, as in a message", "multi_clause": "some context, then the question", "sibling_confuser": "a question that plain keyword search would answer with a near sibling of the target"}


def _strings(c: str | Column) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.array().cast("array<string>"))


def topic_of(name: Column, fields: Column) -> Column:
    """A type as a topic: its name in small letters, without ``Type`` where it has no fields."""
    return F.lower(F.when(fields > 0, name).otherwise(F.replace(name, F.lit("Type"), F.lit(""))))


def bootstrap(types: DataFrame, seed: str = "7") -> DataFrame:
    """(type_id, family_id, intent, query, source, quality_score): every type under each of the 14 templates.

    types: type_id, type_name, field_count. ``{other}`` is another type's name, drawn by
    hash from the ring of types; a type alone is its own.
    """
    from fieldloom.operators.mining import ring

    numbered = ring(types.withColumn("_all", F.lit(0)), ["_all"], "type_id", seed).select("type_id", "place", "n")
    step = 1 + F.pmod(F.conv(F.substring(choice_key(seed + "d", F.col("type_id")), 1, 8), 16, 10).cast("long"), F.greatest(F.col("n") - 1, F.lit(1)))
    asked = numbered.select("type_id", F.pmod(F.col("place") + step, F.col("n")).alias("place"))
    others = asked.join(numbered.select("place", F.col("type_id").alias("other_id")), "place").join(types.select(F.col("type_id").alias("other_id"), F.col("type_name").alias("other")), "other_id").select("type_id", "other")
    listed = F.array(*(F.struct(F.lit(i).alias("intent"), F.lit(t).alias("t")) for i, ts in TYPE_TEMPLATES.items() for t in ts))
    df = types.join(others, "type_id").select("type_id", "type_name", topic_of(F.col("type_name"), F.coalesce("field_count", F.lit(0))).alias("topic"), "other", F.posexplode(listed).alias("i", "x"))
    text = F.col("x.t")
    for slot, c in (("type", "type_name"), ("topic", "topic"), ("other", "other")):
        text = F.replace(text, F.lit("{" + slot + "}"), F.col(c))
    return df.select("type_id", F.concat_ws("-", "type_id", "x.intent", F.col("i").cast("string")).alias("family_id"), F.col("x.intent").alias("intent"), text.alias("query"), F.lit("bootstrap").alias("source"), F.lit(0.8).alias("quality_score"))


def realism_seed(queries: DataFrame, most: int = 50, order: str = "query_id") -> DataFrame:
    """The first val rows, re-sourced, of a score of 0.9 at least."""
    first = queries.filter("split = 'val'").orderBy(order).limit(most)
    return first.withColumn("source", F.lit("manual-realism-seed")).withColumn("quality_score", F.greatest("quality_score", F.lit(0.9)))


def adversarial_ambiguity(queries: DataFrame, types: DataFrame, order: str = "query_id") -> DataFrame:
    """(query_id, query, type_id, split, source, family_id, quality_score) of test rows: their type is meant, and not the next one round the list.

    The i-th row in order is set against the (i + 1)-th type by id, round-robin.
    """
    n = max(1, types.count())
    ranked = types.select("type_id", "type_name", (F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("type_id")) - 1).alias("place"))
    rows = queries.filter("split = 'test'").withColumn("_i", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(order)) - 1)
    rows = rows.withColumn("place", F.pmod(F.col("_i") + 1, F.lit(n))).join(ranked.select("place", F.col("type_name").alias("other")), "place", "left").join(types.select("type_id", F.col("type_name").alias("own")), "type_id", "left")
    text = F.concat(F.lit("i need "), F.lower(F.coalesce("own", "type_id")), F.lit(" info, not "), F.lower(F.coalesce("other", "type_id")), F.lit(", which graphql type is correct"))
    return rows.select(F.concat(F.lit("adv-"), "query_id").alias("query_id"), text.alias("query"), "type_id", F.lit("test").alias("split"), F.lit("adversarial-ambiguity").alias("source"), F.concat(F.lit("adv-"), "family_id").alias("family_id"), F.lit(0.8).alias("quality_score"))


def document_competitor(coordinate: Column, returns: Column, owner_description: Column, description: Column) -> Column:
    """A competitor as a document: what is blank is left out."""
    said = lambda label, c: F.concat(F.lit(label), F.nullif(F.trim(F.coalesce(c, F.lit(""))), F.lit("")))
    return F.concat_ws(". ", F.concat(F.lit("Field "), coordinate), F.concat(F.lit("Returns: "), F.coalesce(returns, F.lit(""))), said("Owner: ", owner_description), said("Description: ", description))


def competition_prompts(sets: DataFrame, fields: DataFrame, phrasings: int = 4) -> DataFrame:
    """(world_id, coordinate, system, prompt): one request a target, with its rivals and the styles asked for.

    sets: (world_id, coordinate, place, rival); fields: world_id, coordinate,
    return_type, description, owner_description.
    """
    line = F.concat(F.lit("- "), competitor_text(F.col("coordinate"), F.col("owner_description"), F.col("description")))
    lines = fields.select("world_id", F.col("coordinate").alias("rival"), line.alias("line"))
    listed = sets.filter("place > 0").join(lines, ["world_id", "rival"]).groupBy("world_id", "coordinate").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "line"))), lambda x: x["line"]), "\n").alias("rivals"))
    df = sets.filter("place = 0").select("world_id", "coordinate").join(fields, ["world_id", "coordinate"]).join(listed, ["world_id", "coordinate"], "left")
    asked = "\n".join(f"- {k}: {v}" for k, v in list(STYLES.items())[: max(1, min(phrasings, len(STYLES)))])
    about = lambda label, c: F.coalesce(F.concat(F.lit(f"{label}: "), F.nullif(F.trim(c), F.lit("")), F.lit("\n")), F.lit(""))
    prompt = F.concat(
        F.lit("Target: "), "coordinate", F.lit("\n"), about("Returns", "return_type"), about("Owner", "owner_description"), about("Field", "description"),
        F.lit("Other owners of a field of this name:\n"), F.coalesce("rivals", F.lit("(none)")), F.lit(f"\n\nWrite {phrasings} questions that only the target answers, one of each style:\n{asked}\n"),
        F.lit("Don't name the field, its owner or any schema word. Answer with JSON: {\"items\": [{\"query\", \"positive_coordinate\", \"relevant_coordinates\", \"negative_coordinates\", \"difficulty\", \"intent\"}]}"),
    )
    return df.select("world_id", "coordinate", F.lit("You write search questions for retrieval training. Answer with JSON alone.").alias("system"), prompt.alias("prompt"))


def generic_prompts(fields: DataFrame, items: int = 10) -> DataFrame:
    """(world_id, system, prompt): a request for a world without rivals, over all of its fields."""
    of = fields.groupBy("world_id").agg(F.array_join(F.array_sort(F.collect_list(F.concat(F.lit("- "), competitor_text(F.col("coordinate"), F.col("owner_description"), F.col("description"))))), "\n").alias("f"))
    return of.select("world_id", F.lit("You write search questions for retrieval training. Answer with JSON alone.").alias("system"), F.concat(F.lit(f"Write {items} questions, each answered by one of these fields, as JSON {{\"items\": [...]}}:\n"), "f").alias("prompt"))


def first_object(text: str | None) -> str | None:
    """The first JSON object in a text, as JSON; null without one. It may stand alone, in a fence, or among words."""
    text = (text or "").strip()
    scan = json.JSONDecoder()
    at = text.find("{")
    while at >= 0:
        try:
            return json.dumps(scan.raw_decode(text, at)[0])
        except ValueError:
            at = text.find("{", at + 1)
    return None


def extract_objects(df: DataFrame, text: str, out: str = "object") -> DataFrame:
    """df with the first JSON object of a text column, in Arrow batches: a scan for it has no built-in form."""
    place, names = df.columns.index(text), [*df.columns, out]

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([first_object(v.as_py()) for v in batch.column(place)], pa.string())], names=names)

    from pyspark.sql.types import StringType, StructField, StructType

    return df.mapInArrow(run, StructType([*df.schema.fields, StructField(out, StringType())]))


ITEM = "query string, positive_coordinate string, relevant_coordinates array<string>, negative_coordinates array<string>, difficulty string, intent string, confuser_tags array<string>, adversarial_tags array<string>, noise_tags array<string>, rationale_tags array<string>"


def items_of(answers: DataFrame, text: str = "content") -> DataFrame:
    """A row an item of each answer's JSON object, with the answer's other columns; answers without one have none."""
    df = extract_objects(answers, text, "_object").withColumn("_items", F.from_json("_object", "struct<items:array<struct<" + ",".join(":".join(c.split(" ", 1)) for c in ITEM.split(", ")) + ">>>"))
    return df.select(*answers.columns, F.posexplode("_items.items").alias("item_no", "i")).select(*answers.columns, "item_no", "i.*")


def read_checkpoint(spark, path: str, schema: str = "_world_id string, batch int, requested int, source string, taken_items array<string>") -> DataFrame:
    """Batches of a log that hold a world and a number; torn and blank lines are skipped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path).filter("_world_id is not null and batch is not null")


def replay(log: DataFrame, worlds: DataFrame | None = None) -> DataFrame:
    """(world_id, split, domain, batch, source, competition_set, item_no, item...) of a log of raw answers.

    log: world_id, split, batches array<struct<batch, source, competition_set,
    raw struct<parsed string, content string>>>. What was parsed counts, else the object
    found in the answer; each row keeps its batch's source. worlds: world_id,
    split, domain, which hold over the log's; unknown worlds keep the log's split.
    """
    df = log.select("world_id", "split", F.explode("batches").alias("b")).select("world_id", "split", "b.batch", "b.source", "b.competition_set", F.coalesce(F.nullif("b.raw.parsed", F.lit("")), "b.raw.content").alias("content"))
    df = items_of(df).drop("content")
    if worlds is None:
        return df.withColumn("domain", F.lit("unknown"))
    of = worlds.select("world_id", F.col("split").alias("_split"), "domain")
    return df.join(of, "world_id", "left").withColumn("split", F.coalesce("_split", "split", F.lit("train"))).withColumn("domain", F.coalesce("domain", F.lit("unknown"))).drop("_split")


def hint(name: Column, returns: Column) -> Column:
    """What a field is about, without its name: by its name, else by its ending and type."""
    kind = F.lower(unwrap_type(F.coalesce(returns, F.lit(""))))
    known = F.coalesce(*(F.when(name == n, F.lit(h)) for n, h in HINTS.items()))
    guess = F.when(name.endswith("At") | kind.isin("datetime", "date", "timestamp", "time"), "moment in time").when(name.endswith("Id") | (kind == "id"), "unique reference").when(name.endswith("Cents") | kind.isin("float", "int"), "numeric measurement").when(kind == "boolean", "yes/no flag").when(kind == "string", "short text value").otherwise("related value")
    return F.coalesce(known, guess)


def generate_locally(fields: DataFrame, per_world: int, seed: str = "42", least_words: int = 4) -> DataFrame:
    """Items of each world from (field, intent) pairs in hashed order, gone round until ``per_world`` are drawn.

    fields: world_id, domain, coordinate, owner_type, field_name, return_type, aliases. Items
    that name the owner or the field, or are under ``least_words`` words, are left
    out, so fewer may come. Worlds of ids alone use those.
    """
    other = fields.groupBy("world_id").agg(F.max((F.col("field_name") != "id").cast("int")).alias("_other"))
    usable = fields.join(other, "world_id").filter("field_name <> 'id' or _other = 0")
    pairs = usable.withColumn("intent", F.explode(intents(F.col("field_name"), F.col("return_type"))))
    order = Window.partitionBy("world_id").orderBy(choice_key(seed, F.col("coordinate"), F.col("intent")), "coordinate", "intent")
    pairs = pairs.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= per_world)
    sizes = pairs.groupBy("world_id").agg(F.count(F.lit(1)).alias("m"))
    drawn = pairs.join(sizes, "world_id").withColumn("i", F.explode(F.sequence(F.lit(0), F.floor((F.lit(per_world) - F.col("place")) / F.col("m")).cast("int")))).withColumn("no", F.col("place") - 1 + F.col("i") * F.col("m"))
    key = [F.col("world_id"), F.col("no")]
    label = F.coalesce(F.get(safe_aliases(F.col("aliases"), F.col("owner_type"), F.col("field_name")), F.lit(0)), F.lit("record"))
    text = F.coalesce(*(F.when(F.col("intent") == i, pick(F.array(*map(F.lit, ts)), seed + "t", *key)) for i, ts in HINT_TEMPLATES.items()))
    text = F.replace(F.replace(text, F.lit("{owner_label}"), label), F.lit("{hint}"), hint(F.col("field_name"), F.col("return_type")))
    df = drawn.withColumn("query", text)
    low = F.lower("query")
    df = df.filter(~F.contains(low, F.lower("owner_type")) & ~F.contains(low, F.lower("field_name")) & (F.size(words(F.col("query"))) >= least_words))
    told = confusers(fields, seed).groupBy("world_id", "coordinate").agg(F.array_sort(F.collect_list(F.struct("tag", "negative"))).alias("c"))
    df = df.join(told, ["world_id", "coordinate"], "left")
    tags = F.array_distinct(_strings("c.tag"))
    adversarial = F.array_compact(F.array(F.when(F.array_contains(tags, "same_owner"), "owner_vs_field"), F.when(F.array_contains(tags, "same_field_name"), "alias_collision"), F.when(F.col("intent") == "root_vs_nested", "root_vs_nested")))
    return df.select("world_id", "no", "query", F.col("coordinate").alias("positive_coordinate"), F.array("coordinate").alias("relevant_coordinates"), F.slice(F.array_distinct(_strings("c.negative")), 1, 6).alias("negative_coordinates"), pick(F.array(*map(F.lit, DIFFICULTIES)), seed + "y", *key).alias("difficulty"), "intent", tags.alias("confuser_tags"), adversarial.alias("adversarial_tags"), F.array(F.coalesce("domain", F.lit("unknown")), F.lit("field-centric"), F.lit("local-fallback")).alias("rationale_tags"))


def seed_rows(items: DataFrame) -> DataFrame:
    """Rows of a dataset from validated items with the verdict of mining.

    items: world_id, domain, split, batch_source, no, query, positive_coordinate,
    relevant_coordinates, negative_coordinates, difficulty, intent, tags, and of
    mining bucket, margin, base_wrong (what the base model put first, where it
    was wrong and is a coordinate of the world). That comes first among the
    negatives, of which 8 stay and 5 are confusers.
    """
    of = lambda i: F.coalesce(*(F.when(F.col("batch_source") == s, F.lit(x[i])) for s, x in SOURCES.items()), F.lit(OTHER_SOURCE[i]))
    pos, wrong = F.col("positive_coordinate"), F.col("base_wrong")
    first = wrong.isNotNull() & (wrong != pos)
    own = _strings("negative_coordinates")
    negatives = F.when(first, F.concat(F.array(wrong), F.filter(own, lambda x: x != wrong))).otherwise(own)
    relevant = F.when(F.size(_strings("relevant_coordinates")) > 0, F.col("relevant_coordinates")).otherwise(F.array(pos))
    return items.select(
        F.concat_ws("-", of(0), "world_id", F.col("no").cast("string")).alias("query_id"), "query", "positive_coordinate", "split", of(0).alias("source"), F.concat_ws(":", "world_id", pos).alias("family_id"), of(1).alias("quality_score"),
        F.slice(negatives, 1, 8).alias("negative_coordinates"), relevant.alias("relevant_coordinates"), owner_of(pos).alias("owner_type"), field_of(pos).alias("field_name"), "world_id", "domain", F.col("split").alias("world_split"), "difficulty", "intent", "confuser_tags",
        F.concat(_strings("adversarial_tags"), F.when(wrong.isNotNull(), F.array(F.concat(F.lit("base_model_confuses_with:"), wrong))).otherwise(F.array().cast("array<string>"))).alias("adversarial_tags"),
        F.concat(_strings("rationale_tags"), F.array(F.concat(F.lit("base_"), F.coalesce("bucket", F.lit("unmined"))), F.concat(F.lit("margin="), F.coalesce(F.bround("margin", 4), F.lit(0.0)).cast("string")))).alias("rationale_tags"), F.slice(negatives, 1, 5).alias("confuser_coordinates"),
    )


def curated_queries(corpus: DataFrame, order: str = "doc_id", first: int = 100, most: int = 200) -> DataFrame:
    """(coordinate, query, intent, slice, difficulty, place): queries of the first rows' fields by name, once each.

    The cuts are the suite's: its ``first`` rows in order and ``most`` queries.
    """
    plain = F.lower(F.replace(F.replace("field_name", F.lit("Id"), F.lit(" identifier")), F.lit("Cents"), F.lit(" amount")))
    of = lambda q, i, s: F.struct(q.alias("query"), F.lit(i).alias("intent"), F.lit(s).alias("slice"))
    default = F.array(of(F.concat(F.lit("Which field gives me the "), plain, F.lit("?")), "lookup", "obvious"))
    told = F.coalesce(*(F.when(F.col("field_name") == n, F.array(*(of(F.lit(q), i, s) for q, i, s in own))) for n, own in CURATED.items()), default)
    rows = corpus.orderBy(order).limit(first).select(F.col(order).alias("_o"), "coordinate", F.posexplode(told).alias("k", "t"))
    one = rows.groupBy("coordinate", "t.query").agg(F.min(F.struct("_o", "k", "t")).alias("x"))
    kept = one.orderBy("x._o", "x.k").limit(most)
    return kept.select("coordinate", "query", "x.t.intent", "x.t.slice", F.when(F.col("x.t.slice").isin("adversarial", "sibling-field"), "hard").otherwise("medium").alias("difficulty"))


def merge_curated(rows: DataFrame, corpus: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected): curated rows whose positive is in the corpus, and the others with the reason.

    rows: line (of the file), query, positive_coordinate, relevant_coordinates,
    negative_coordinates and other fields of a query, null where the file has
    none. Relevant ones are cut to the corpus (the positive, if none is left),
    negatives to those of the corpus that aren't relevant; owner and field are
    the corpus's.
    """
    of = corpus.groupBy("coordinate").agg(F.first("owner_type").alias("_owner"), F.first("field_name").alias("_field"))
    df = rows.join(of, rows["positive_coordinate"] == of["coordinate"], "left").drop("coordinate")
    good = df.filter("_owner is not null")
    bad = df.filter("_owner is null").select("line", F.concat(F.lit("positive_coordinate not in corpus: "), F.coalesce("positive_coordinate", F.lit("None"))).alias("reason"))
    known = corpus.select("coordinate").distinct()

    def there(name: str) -> DataFrame:
        return good.select("line", F.posexplode(_strings(name)).alias("i", "coordinate")).join(known, "coordinate").groupBy("line").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "coordinate"))), lambda x: x["coordinate"]).alias(f"_{name}"))

    good = good.join(there("relevant_coordinates"), "line", "left").join(there("negative_coordinates"), "line", "left")
    relevant = F.when(F.size(_strings("_relevant_coordinates")) > 0, F.col("_relevant_coordinates")).otherwise(F.array("positive_coordinate"))
    good = good.withColumn("relevant_coordinates", relevant)
    good = good.withColumn("negative_coordinates", F.filter(_strings("_negative_coordinates"), lambda x: ~F.array_contains("relevant_coordinates", x)))
    return good.withColumn("owner_type", F.col("_owner")).withColumn("field_name", F.col("_field")).withColumn("confuser_coordinates", F.slice("negative_coordinates", 1, 5)).drop("_owner", "_field", "_relevant_coordinates", "_negative_coordinates"), bad
