"""Competition sets, batch plans under a budget, and training pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldloom.functions.text import choice_key
from fieldloom.operators.filters import ambiguous_names
from fieldloom.operators.mining import before, ring


def competition_sets(coords: DataFrame, cap: int = 6, seed: str = "3") -> DataFrame:
    """(world_id, coordinate, place, rival): each target first, then up to ``cap - 1`` others of its name in the world.

    Only names that two owners or more have in any world. Others whose owner is
    described come first; within both kinds the ring of hashed order gives each
    target the ones after it, so every target has its fill and no name is paired
    all with all. coords may have owner_description.
    """
    name = F.lower("field_name")
    described = (F.trim(F.coalesce("owner_description", F.lit(""))) != "") if "owner_description" in coords.columns else F.lit(False)
    df = coords.select("world_id", name.alias("name"), "coordinate", described.alias("told")).groupBy("world_id", "name", "coordinate").agg(F.max("told").alias("told"))
    df = df.join(ambiguous_names(coords).select(F.col("field_name").alias("name")), "name", "left_semi")
    numbered = ring(df, ["world_id", "name", "told"], "coordinate", seed)
    told, plain = (numbered.filter(F.col("told") == x).drop("told") for x in (True, False))
    start = choice_key(seed, F.col("coordinate"))
    draw = F.conv(F.substring(start, 1, 8), 16, 10).cast("long")

    def after(side: DataFrame, kind: int) -> DataFrame:
        """Up to ``cap`` members of a side from a target's own place, or from a drawn one where it isn't of that side."""
        sizes = side.select("world_id", "name", F.col("n").alias("m")).distinct()
        at = df.select("world_id", "name", "coordinate").join(sizes, ["world_id", "name"]).join(side.select("world_id", "name", "coordinate", "place"), ["world_id", "name", "coordinate"], "left")
        at = at.withColumn("from", F.coalesce("place", F.pmod(draw, F.col("m"))))
        steps = at.select("world_id", "name", "coordinate", "from", "m", F.explode(F.sequence(F.lit(0), F.lit(cap - 1))).alias("step")).filter("step < m")
        steps = steps.select("world_id", "name", "coordinate", "step", F.pmod(F.col("from") + F.col("step"), F.col("m")).alias("place"))
        return steps.join(side.select("world_id", "name", F.col("coordinate").alias("rival"), "place"), ["world_id", "name", "place"]).filter("coordinate <> rival").select("world_id", "coordinate", F.struct(F.lit(kind).alias("kind"), "step", "rival").alias("r"))

    rivals = after(told, 0).unionByName(after(plain, 1)).groupBy("world_id", "coordinate").agg(F.array_sort(F.collect_list("r")).alias("r"))
    chosen = df.select("world_id", "coordinate").join(rivals, ["world_id", "coordinate"], "left")
    listed = F.concat(F.array("coordinate"), F.coalesce(F.slice("r.rival", 1, cap - 1), F.array().cast("array<string>")))
    return chosen.select("world_id", "coordinate", F.posexplode(listed).alias("place", "rival"))


def batch_plan(targets: DataFrame, budget: int, world: str = "world_id", key: str = "doc_id", want: str = "requested", seed: str = "5", boost: dict[str, int] | None = None) -> DataFrame:
    """(world, batch_no, key, requested): targets in hashed order until the world's budget is used up; the last gets what is left.

    boost: a source's factor on the budget (column ``source``), as for real
    worlds. Null worlds are one world. A world's running sum is taken in parts;
    the targets left, each of which asks for one item or more, are at most its
    budget.
    """
    drawn = choice_key(seed, F.col(key))
    times = F.coalesce(*(F.when(F.col("source") == s, F.lit(n)) for s, n in boost.items()), F.lit(1)) if boost else F.lit(1)
    # a struct is not null where its field is, and equal to its like
    df = before(targets.withColumn("_budget", F.lit(budget) * times).withColumn("_world", F.struct(world)), ["_world"], drawn, key, {"_before": F.col(want)})
    df = df.filter(F.col("_before") < F.col("_budget")).withColumn("batch_no", F.row_number().over(Window.partitionBy(world).orderBy(drawn, key)) - 1)
    return df.select(world, "batch_no", key, F.least(F.col(want), F.col("_budget") - F.col("_before")).alias("requested"))


def back_fill(plan: DataFrame, budget: int, batch: int, world: str = "world_id", worlds: DataFrame | None = None) -> DataFrame:
    """plan with generic batches (null key) of ``batch`` items after it, until each world's budget is used up."""
    used = plan.groupBy(world).agg(F.sum("requested").alias("used"), F.count(F.lit(1)).alias("n"))
    if worlds is not None:
        used = worlds.select(world).distinct().join(used, world, "left").select(world, F.coalesce("used", F.lit(0)).alias("used"), F.coalesce("n", F.lit(0)).alias("n"))
    left = used.filter(F.col("used") < budget).withColumn("left", F.lit(budget) - F.col("used"))
    more = left.select(world, "n", "left", F.explode(F.sequence(F.lit(0), F.ceil(F.col("left") / batch).cast("int") - 1)).alias("i"))
    key = [c for c in plan.columns if c not in (world, "batch_no", "requested")]
    more = more.select(world, (F.col("n") + F.col("i")).alias("batch_no"), *(F.lit(None).cast(dict(plan.dtypes)[c]).alias(c) for c in key), F.least(F.lit(batch), F.col("left") - F.col("i") * batch).alias("requested"))
    return plan.unionByName(more)


def mock_responses(plan: DataFrame, responses: DataFrame, world: str = "world_index") -> DataFrame:
    """plan with the response of each batch, taken in turn: that at (world index + batch number) modulo their number.

    responses: (place, response), numbered from 0.
    """
    n = max(1, responses.count())
    return plan.withColumn("place", F.pmod(F.col(world) + F.col("batch_no"), F.lit(n))).join(responses.select("place", "response"), "place", "left").drop("place")


def training_pairs(coords: DataFrame, ranked: DataFrame, n: int = 3, seed: str = "9") -> DataFrame:
    """(doc_id, negative_1..n): ranked (doc_id, place, negative) first, then others of the world in its ring; rows short of n are left out.

    Negatives are distinct. The ring gives as many as can be missing, so only
    worlds of n rows or fewer leave a row short.
    """
    numbered = ring(coords.select("world_id", "doc_id"), ["world_id"], "doc_id", seed)
    own = ranked.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "negative"))), lambda x: x["negative"]).alias("own"))
    df = numbered.join(own, "doc_id", "left").withColumn("own", F.array_distinct(F.filter(F.coalesce("own", F.array().cast("array<bigint>")), lambda x: x != F.col("doc_id"))))
    steps = df.filter(F.size("own") < n).select("world_id", "doc_id", F.explode(F.sequence(F.lit(1), F.lit(2 * n))).alias("step"), "place", "n").filter("step < n")
    fill = steps.select("world_id", "doc_id", "step", F.pmod(F.col("place") + F.col("step"), F.col("n")).alias("place")).join(numbered.select("world_id", "place", F.col("doc_id").alias("negative")), ["world_id", "place"]).groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("step", "negative"))), lambda x: x["negative"]).alias("fill"))
    df = df.join(fill, "doc_id", "left")
    every = F.array_distinct(F.concat("own", F.coalesce("fill", F.array().cast("array<bigint>"))))
    return df.select("doc_id", every.alias("every")).filter(F.size("every") >= n).select("doc_id", *(F.get("every", F.lit(i)).alias(f"negative_{i + 1}") for i in range(n)))


def pick(items: Column, seed: str, *keys: Column) -> Column:
    """One element of an array, drawn by a row's hash; null of an empty one."""
    at = F.pmod(F.conv(F.substring(choice_key(seed, *keys), 1, 8), 16, 10).cast("long"), F.greatest(F.size(items), F.lit(1))).cast("int")
    return F.get(items, at)


def pair_texts(queries: DataFrame, docs: DataFrame, loss: str = "triplet", n: int = 4, seed: str = "42") -> DataFrame:
    """(query_id, anchor, positive, negative...): texts of each query's pair.

    docs: coordinate, views (array of the positive texts), text (the primary
    view), one row a coordinate. The positive is the first relevant coordinate
    (or the target) that has views, by a view drawn by hash. ``triplet`` has one
    negative, drawn from the query's known ones, else the first other
    coordinate; ``mnrl`` has negative_1..n, the ranked ones and then others drawn
    from the ring of coordinates. Queries without a positive, or short of
    negatives, have no pair. Texts are looked up by joins, not by a map of all.
    """
    if loss not in ("triplet", "mnrl", "cached_mnrl"):
        raise ValueError(f"unknown loss {loss!r}; one of cached_mnrl, mnrl, triplet")
    empty = F.array().cast("array<string>")
    relevant = F.when(F.size(F.coalesce("relevant_coordinates", empty)) > 0, F.col("relevant_coordinates")).otherwise(F.array("positive_coordinate"))
    lists = queries.select("query_id", "query", relevant.alias("rel"), F.coalesce("negative_coordinates", empty).alias("neg"))
    known = docs.select("coordinate").distinct()
    rel = lists.select("query_id", F.posexplode("rel").alias("i", "coordinate")).join(known, "coordinate").groupBy("query_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "coordinate"))), lambda x: x["coordinate"]).alias("pos"))
    neg = lists.select("query_id", F.posexplode("neg").alias("i", "coordinate")).join(known, "coordinate").groupBy("query_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "coordinate"))), lambda x: x["coordinate"]).alias("neg"))
    df = lists.select("query_id", F.col("query").alias("anchor")).join(rel, "query_id").join(neg, "query_id", "left").withColumn("neg", F.array_distinct(F.array_except(F.coalesce("neg", empty), "pos")))
    want = 1 if loss == "triplet" else n
    numbered = ring(docs.withColumn("_all", F.lit(0)).select("_all", "coordinate"), ["_all"], "coordinate", seed)
    total = known.count()
    spare = want + 8
    start = F.pmod(F.conv(F.substring(choice_key(seed, F.col("query_id")), 1, 8), 16, 10).cast("long"), F.lit(max(total, 1)))
    short = df.filter(F.size("neg") < want).select("query_id", start.alias("from"), (F.size("pos") + F.size("neg")).alias("taken"))
    steps = short.select("query_id", "from", F.explode(F.sequence(F.lit(0), F.col("taken") + spare)).alias("step")).filter(F.col("step") < total)
    fill = steps.select("query_id", "step", F.pmod(F.col("from") + F.col("step"), F.lit(max(total, 1))).alias("place")).join(numbered.select("place", "coordinate"), "place").groupBy("query_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("step", "coordinate"))), lambda x: x["coordinate"]).alias("fill"))
    df = df.join(fill, "query_id", "left")
    more = F.array_except(F.array_except(F.coalesce("fill", empty), "pos"), "neg")
    if loss == "triplet":
        drawn = F.array(F.coalesce(pick(F.col("neg"), seed, F.col("query_id")), F.get(more, F.lit(0))))
        df = df.withColumn("neg", F.filter(drawn, lambda x: x.isNotNull()))
    else:
        df = df.withColumn("neg", F.slice(F.concat("neg", more), 1, n))
    df = df.filter(F.size("neg") == want)
    views, text = docs.select("coordinate", "views"), docs.select("coordinate", "text")
    positive = df.select("query_id", "anchor", F.get("pos", F.lit(0)).alias("coordinate")).join(views, "coordinate").select("query_id", "anchor", pick(F.col("views"), seed + "v", F.col("query_id")).alias("positive"))
    told = df.select("query_id", F.posexplode("neg").alias("i", "coordinate")).join(text, "coordinate")
    names = ["negative"] if loss == "triplet" else [f"negative_{i + 1}" for i in range(n)]
    wide = told.groupBy("query_id").agg(*(F.max(F.when(F.col("i") == i, F.col("text"))).alias(c) for i, c in enumerate(names)))
    return positive.join(wide, "query_id").select("query_id", "anchor", "positive", *names)
