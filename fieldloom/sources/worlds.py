"""Worlds: generated schemas of a domain, with their catalog, corpus rows and schema text."""

from __future__ import annotations

import random
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.functions.text import lower_first, path_to_root
from fieldloom.plans import views

#: Domain -> types; a parameter of the generator.
DOMAINS = {
    "travel": ("Hotel", "Room", "Booking", "Guest", "Payment", "Review", "Airport", "Passenger", "Itinerary", "Ticket", "Refund", "Loyalty"),
    "commerce": ("Order", "Customer", "Invoice", "Shipment", "Warehouse", "Coupon", "Refund", "Review", "Payment", "Supplier", "Basket", "Return"),
    "health": ("Patient", "Provider", "Facility", "Claim", "Prescription", "Visit", "Report", "Referral", "Invoice", "Vaccine", "Ward", "Device"),
    "support": ("Ticket", "Agent", "Customer", "Article", "Queue", "Message", "Survey", "Escalation", "Report", "Shift", "Macro", "Channel"),
}
ALIASES = {"Guest": ("visitor", "traveller"), "Booking": ("reservation", "stay"), "Order": ("purchase", "sale"), "Patient": ("case", "person in care"), "Ticket": ("request", "issue"), "Invoice": ("bill", "statement"), "Payment": ("charge", "settlement"), "Agent": ("operator", "representative")}
TYPE_DESCRIPTIONS = {"Hotel": "A place that lets rooms by the night.", "Order": "What a customer has asked to buy.", "Patient": "Someone in the care of a provider.", "Ticket": "A request that waits for an answer."}
# fixed values: fields of types whose name holds one of the words
ROLES = (
    (("hotel", "property", "facility"), (("displayName", "String!"), ("city", "String"), ("rating", "Float"))),
    (("room", "seat", "ticket"), (("label", "String!"), ("status", "String"), ("priceCents", "Int"))),
    (("order", "reservation", "booking", "invoice", "claim"), (("status", "String!"), ("totalCents", "Int"), ("currency", "String"))),
    (("customer", "guest", "patient", "owner", "agent", "provider", "passenger"), (("displayName", "String"), ("email", "String"), ("phone", "String"))),
    (("payment", "transaction", "transfer", "payout", "refund"), (("amountCents", "Int!"), ("currency", "String!"), ("state", "String"))),
)
OTHER_ROLE = (("displayName", "String"), ("status", "String"), ("description", "String"))
EVERY = (("id", "ID!"), ("createdAt", "String"), ("updatedAt", "String"))
WRITTEN = ("post", "article", "ticket", "booking", "order", "claim", "report", "review")
BY_LINE = (("author", "User"), ("authorId", "ID"))
MOST_FIELDS = 10
# fixed values: descriptions of well-known fields
FIELD_DESCRIPTIONS = {
    "author": "Author or owner responsible for this record.", "status": "Current lifecycle state.", "createdAt": "Timestamp when the record was created.", "updatedAt": "Timestamp when the record last changed.", "email": "Email address used for communication or lookup.",
    "phone": "Phone number used for communication.", "displayName": "Human-readable name shown in UI.", "name": "Human-readable canonical name.", "currency": "ISO currency code.",
}
#: Names that any type may have, so that worlds hold rival owners of one name.
SHARED = (("actor", "User"), ("owner", "User"), ("status", "String"), ("notes", "String"), ("tags", "[String!]"), ("priority", "Int"), ("source", "String"), ("category", "String"), ("reviewedAt", "String"), ("version", "Int"))
CATALOG = "world_index int, world_id string, domain string, type_no int, type_name string, aliases array<string>, neighbors array<string>, description string, fields array<struct<name:string,type:string>>"


def field_description(owner: Column, field: Column, returns: Column) -> Column:
    known = F.coalesce(*(F.when(field == n, F.lit(d)) for n, d in FIELD_DESCRIPTIONS.items()))
    return F.coalesce(known, F.concat(field, F.lit(" on "), owner, F.lit(" returning "), returns, F.lit(".")))


def type_description(name: str, domain: str) -> str:
    return TYPE_DESCRIPTIONS.get(name, f"{name}: an entity in the {domain} domain (auto-described).")


def type_fields(name: str, rnd: random.Random) -> list[tuple[str, str]]:
    """Fields of a type: those of every type, those of its role, a by-line where it is written, and two or three shared names."""
    low = name.lower()
    own = list(EVERY) + list(next((f for held, f in ROLES if any(w in low for w in held)), OTHER_ROLE))
    if any(w in low for w in WRITTEN):
        own += BY_LINE
    names = {n for n, _ in own}
    spare = [x for x in SHARED if x[0] not in names]
    return (own + rnd.sample(spare, rnd.randint(2, 3)))[:MOST_FIELDS]


def type_names(types: tuple[str, ...], count: int, rnd: random.Random) -> list[str]:
    """``count`` names: the first ten, then others of the domain, then numbered extensions."""
    first, rest = list(types[:10][:count]), list(types[10:])
    if count <= len(types):
        return first + rnd.sample(rest, min(count - len(first), len(rest)))
    return first + rest + [f"{types[i % len(types)]}Extension{i + 1}" for i in range(count - len(types))]


def generate_worlds(spark: SparkSession, count: int, types: tuple[int, int] = (20, 36), relations: tuple[int, int] = (2, 4), seed: int = 42, domains: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """Type catalog rows (CATALOG) of ``count`` worlds; each world is drawn from its own seed, so it doesn't depend on the others."""
    domains = domains or DOMAINS
    names = list(domains)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for w in part["id"]:
                rnd, domain = random.Random(f"{seed}:{w}"), names[int(w) % len(names)]
                own = type_names(domains[domain], rnd.randint(*types), rnd)
                for no, t in enumerate(own):
                    others = [x for x in own if x != t]
                    near = rnd.sample(others, min(rnd.randint(*relations), len(others)))
                    aliases = list(ALIASES.get(t, (t.lower(), f"{t.lower()} record")))[:3]
                    rows.append((int(w), f"world_{int(w):04d}", domain, no, t, aliases, near, type_description(t, domain), [{"name": n, "type": k} for n, k in type_fields(t, rnd)]))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in CATALOG.split(", ")])

    return spark.range(count).mapInPandas(run, CATALOG)


def world_splits(worlds: DataFrame, index: str = "world_index", shares: tuple[float, float] = (0.8, 0.1)) -> DataFrame:
    """(index, split): worlds by their index, the first shares (truncated) train and val, the rest test."""
    one = worlds.select(index).distinct()
    n = one.count()
    train, val = int(n * shares[0]), int(n * shares[1])
    places = one.withColumn("_p", F.col(index))
    return places.select(index, F.when(F.col("_p") < train, "train").when(F.col("_p") < train + val, "val").otherwise("test").alias("split"))


def field_catalog(worlds: DataFrame) -> DataFrame:
    """(world_id, domain, doc_id, coordinate, owner_type, field_name, return_type, description, owner_description, aliases, path_to_root, neighbors)."""
    df = worlds.select("world_id", "domain", F.col("type_name").alias("owner_type"), "aliases", "neighbors", F.col("description").alias("owner_description"), F.explode("fields").alias("f"))
    o, f, r = F.col("owner_type"), F.col("f.name"), F.col("f.type")
    where = F.concat(o, F.lit("."), f)
    more = F.array_sort(F.array_distinct(F.concat("aliases", F.array(F.replace(f, F.lit("_"), F.lit(" ")), F.lower(f)))))
    return df.select("world_id", "domain", F.concat("world_id", F.lit(":"), where).alias("doc_id"), where.alias("coordinate"), "owner_type", f.alias("field_name"), r.alias("return_type"), field_description(o, f, r).alias("description"), "owner_description", more.alias("aliases"), path_to_root(o, f).alias("path_to_root"), "neighbors", F.col("aliases").alias("owner_aliases"))


def catalog_of(corpus: DataFrame) -> DataFrame:
    """The field catalog of corpus rows, blank where they have no owner's description."""
    there = {c: F.col(c) for c in corpus.columns}
    blank = lambda c: F.coalesce(there[c], F.lit("")) if c in there else F.lit("")
    return corpus.select(*(c for c in ("world_id", "doc_id", "coordinate", "owner_type", "field_name", "return_type", "description", "aliases", "path_to_root") if c in there), blank("owner_description").alias("owner_description"))


def world_corpus(catalog: DataFrame) -> DataFrame:
    """Corpus rows of a field catalog with their text views."""
    o, f, r, d = F.col("owner_type"), F.col("field_name"), F.col("return_type"), F.col("description")
    list_of = lambda c: F.coalesce(F.nullif(F.array_join(c, ", "), F.lit("")), F.lit("none"))
    semantic = F.concat(F.lit("GraphQL field "), F.col("coordinate"), F.lit(". Owner type: "), o, F.lit(". Returns: "), r, F.lit(". Description: "), d, F.lit(". Domain: "), "domain", F.lit(". Related types: "), list_of("neighbors"), F.lit("."))
    full = F.concat(F.lit("GraphQL field "), F.col("coordinate"), F.lit(" in domain "), "domain", F.lit(". Owner aliases: "), list_of("owner_aliases"), F.lit(". Related types: "), list_of("neighbors"), F.lit(". Field description: "), d)
    keywords = F.array_join(F.array_sort(F.array_distinct(F.concat(F.array(F.lower("coordinate"), F.lower(o), F.lower(f), F.col("domain")), F.transform("owner_aliases", F.lower)))), " | ")
    return catalog.select("doc_id", "coordinate", "owner_type", "field_name", "return_type", F.concat(F.lit("Field "), "coordinate", F.lit(" in "), "domain").alias("short_text"), full.alias("full_text"), keywords.alias("keywords_text"), "description", "owner_description", "aliases", "path_to_root", F.col("coordinate").alias("coordinate_text"), F.concat("coordinate", F.lit(": "), r).alias("field_signature_text"), semantic.alias("field_semantic_text"), views.sdl(o, f, r).alias("sdl_snippet_text"), semantic.alias("retrieval_text"), "world_id", "domain", F.transform("neighbors", lambda n: F.concat("world_id", F.lit(":"), n)).alias("neighbors"), "owner_aliases", F.lit("synthetic").alias("source"))


def rekey(corpus: DataFrame, world_id: Column, domain: Column, source: str = "real-schema") -> DataFrame:
    """Corpus rows of one schema as rows of a world: ids carry the world's, and the row its domain and source."""
    return corpus.withColumn("world_id", world_id).withColumn("domain", domain).withColumn("source", F.lit(source)).withColumn("doc_id", F.concat("world_id", F.lit(":"), "coordinate"))


def type_lookup(worlds: DataFrame) -> DataFrame:
    """(key, world_id, type_name, fields, description) by ``world:type``; from the catalog, not from schema text read again."""
    return worlds.select(F.concat_ws(":", "world_id", "type_name").alias("key"), "world_id", "type_name", "fields", "description")


def schema_texts(worlds: DataFrame) -> DataFrame:
    """(world_id, sdl): a valid schema of each world: ids once, users declared, a query root with one and many of each type."""
    name = F.col("type_name")
    low = lower_first(name)
    line = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))
    root = F.concat(line("  ", low, "(id: ID!): ", name), F.lit("\n"), line("  ", low, "s(limit: Int, offset: Int): [", name, "!]!"))
    fields = F.transform(F.filter("fields", lambda f: f["name"] != "id"), lambda f: F.concat(F.lit("  "), f["name"], F.lit(": "), f["type"]))
    taken = F.transform("fields", lambda f: f["name"])
    near = F.flatten(F.transform("neighbors", lambda n: F.filter(F.array(F.struct(lower_first(n).alias("k"), F.concat(F.lit("  "), lower_first(n), F.lit(": "), n).alias("v")), F.struct(F.concat(lower_first(n), F.lit("s")).alias("k"), F.concat(F.lit("  "), lower_first(n), F.lit("s(limit: Int): ["), n, F.lit("!]!")).alias("v"))), lambda x: ~F.array_contains(taken, x["k"]))))
    body = F.array_join(F.concat(F.array(F.concat(F.lit("type "), name, F.lit(" implements Node {")), F.lit("  id: ID!")), fields, F.transform(near, lambda x: x["v"]), F.array(F.lit("}"))), "\n")
    of = worlds.groupBy("world_id").agg(F.array_sort(F.collect_list(F.struct("type_no", root.alias("root"), body.alias("body"), (name == "User").alias("is_user")))).alias("t"))
    text = lambda k, by: F.array_join(F.transform("t", lambda x: x[k]), by)
    user = F.when(F.exists("t", lambda x: x["is_user"]), F.lit("")).otherwise(F.lit("type User implements Node {\n  id: ID!\n}\n\n"))
    return of.select("world_id", F.concat(F.lit("type Query {\n"), text("root", "\n"), F.lit("\n}\n\n"), text("body", "\n\n"), F.lit("\n\n"), user, F.lit("interface Node {\n  id: ID!\n}")).alias("sdl"))
