"""Retrieval metrics: a row a query, their means, slices, suites, epochs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.functions.text import owner_of

#: Metric -> how it is named in a summary; the means that every summary has.
MEANS = ("exact_match_at_1", "recall_at_1", "recall_at_3", "recall_at_5", "recall_at_10", "set_recall_at_5", "set_recall_at_10", "coverage_at_5", "coverage_at_10", "mrr_at_10", "ndcg_at_10", "same_owner_wrong_field_at_1", "ambiguity_rate")
SLICED = ("exact_match_at_1", "recall_at_5", "mrr_at_10", "ndcg_at_10", "set_recall_at_5", "coverage_at_5")
EPOCH = ("recall_at_1", "recall_at_5", "recall_at_10", "mrr_at_10", "ndcg_at_10", "exact_match_at_1", "recall_at_3", "same_owner_wrong_field_at_1")
EMPTY = "array<string>"


def relevant_of(positive: Column, relevant: Column) -> Column:
    """The positive and the other relevant coordinates, distinct, without blanks."""
    return F.filter(F.array_distinct(F.concat(F.array(positive), F.coalesce(relevant, F.array().cast(EMPTY)))), lambda x: x.isNotNull() & (x != ""))


def place_of(ranked: Column, item: Column) -> Column:
    """The first place, from 1, of an item in a ranked list; null where it isn't there."""
    return F.nullif(F.coalesce(F.array_position(ranked, item), F.lit(0)), F.lit(0))


def recall(ranked: Column, item: Column, k: int) -> Column:
    return F.when(place_of(ranked, item) <= k, 1.0).otherwise(0.0)


def set_recall(ranked: Column, relevant: Column, k: int, mode: str = "any") -> Column:
    """Whether any, or all, of the relevant that aren't blank are among the first k; 0 without any."""
    rel = F.filter(relevant, lambda x: x != "")
    top = F.slice(ranked, 1, k)
    hit = F.arrays_overlap(rel, top) if mode == "any" else F.forall(rel, lambda x: F.array_contains(top, x))
    return F.when((F.size(rel) > 0) & hit, 1.0).otherwise(0.0)


def coverage(ranked: Column, relevant: Column, k: int) -> Column:
    """The share of the relevant that aren't blank, repeats and all, among the first k; 0 without any."""
    rel = F.filter(relevant, lambda x: x != "")
    top = F.slice(ranked, 1, k)
    return F.when(F.size(rel) > 0, F.size(F.filter(rel, lambda x: F.array_contains(top, x))) / F.size(rel)).otherwise(0.0)


def pair_recall(ranked: Column, primary: Column, bridge: Column, k: int) -> Column:
    """Whether both are among the first k; 0 where one is blank."""
    top = F.slice(ranked, 1, k)
    both = F.array_contains(top, primary) & F.array_contains(top, bridge) & (primary != "") & (bridge != "")
    return F.when(F.coalesce(both, F.lit(False)), 1.0).otherwise(0.0)


def same_owner_wrong_field(top: Column, right: Column, owner: Column) -> Column:
    """The first of a ranking is wrong (not in ``right``) though its owner is the query's."""
    wrong = (top != "") & ~F.array_contains(right, top) & (owner != "") & (owner_of(top) == owner)
    return F.when(F.coalesce(wrong, F.lit(False)), 1.0).otherwise(0.0)


def judge(rows: DataFrame, wrong_versus: str = "relevant") -> DataFrame:
    """rows with MEANS' columns, relevant and is_ambiguous.

    rows: positive_coordinate, relevant_coordinates, owner_type, ranked (array of
    coordinates, best first). ``wrong_versus`` says what the first must miss to be
    a wrong field: all the relevant, or the positive alone.
    """
    df = rows.withColumn("ranked", F.coalesce("ranked", F.array().cast(EMPTY))).withColumn("relevant", relevant_of(F.col("positive_coordinate"), F.col("relevant_coordinates")))
    ranked, rel, pos = F.col("ranked"), F.col("relevant"), F.col("positive_coordinate")
    top, at = F.get(ranked, F.lit(0)), place_of(ranked, pos)
    right = rel if wrong_versus == "relevant" else F.array(pos)
    return df.select(
        *df.columns,
        F.when(F.coalesce(F.array_contains(rel, top), F.lit(False)), 1.0).otherwise(0.0).alias("exact_match_at_1"),
        *(recall(ranked, pos, k).alias(f"recall_at_{k}") for k in (1, 3, 5, 10)),
        *(set_recall(ranked, rel, k).alias(f"set_recall_at_{k}") for k in (5, 10)),
        *(set_recall(ranked, rel, k, "all").alias(f"set_recall_all_at_{k}") for k in (5, 10)),
        *(coverage(ranked, rel, k).alias(f"coverage_at_{k}") for k in (5, 10)),
        F.when(at <= 10, 1.0 / at).otherwise(0.0).alias("mrr_at_10"),
        F.when(at <= 10, 1.0 / F.log2(at + 1.0)).otherwise(0.0).alias("ndcg_at_10"),
        same_owner_wrong_field(top, right, F.col("owner_type")).alias("same_owner_wrong_field_at_1"),
        (F.size(rel) > 1).cast("double").alias("ambiguity_rate"),
        (F.size(rel) > 1).alias("is_ambiguous"),
    )


def _means(names: tuple[str, ...], digits: int) -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), *(F.round(F.coalesce(F.avg(m), F.lit(0.0)), digits).alias(m) for m in names)]


def summarise(judged: DataFrame, digits: int = 6) -> DataFrame:
    """One row: n and the 13 means; all nought for no rows."""
    return judged.agg(*_means(MEANS, digits))


def slices(judged: DataFrame, digits: int = 6) -> DataFrame:
    """(slice, n, SLICED): each row counts in its intent, difficulty and source, in each of its confuser tags, and by whether it has several relevant."""
    one = lambda name: F.array(F.concat(F.lit(f"{name}:"), F.coalesce(F.nullif(F.col(name), F.lit("")), F.lit("unknown"))))
    tags = F.transform(F.coalesce("confuser_tags", F.array().cast(EMPTY)), lambda t: F.concat(F.lit("confuser:"), t))
    several = F.array(F.when(F.col("is_ambiguous"), "ambiguity:multi_relevant").otherwise("ambiguity:single_relevant"))
    keys = F.concat(one("intent"), one("difficulty"), one("source"), tags, several)
    return judged.select(F.explode(keys).alias("slice"), *SLICED).groupBy("slice").agg(*_means(SLICED, digits))


def run_suites(judged: DataFrame, suite: str = "benchmark", names: tuple[str, ...] = ()) -> DataFrame:
    """(benchmark, n, 13 means) of each suite in one pass; suites named that have no rows are nought."""
    got = judged.groupBy(suite).agg(*_means(MEANS, 6))
    if names:
        zero = judged.sparkSession.createDataFrame([(x,) for x in names], f"{suite} string")
        got = zero.join(got, suite, "outer").na.fill(0)
    return got


def run_epochs(judged: DataFrame, suite: str = "benchmark", epoch: str = "epoch") -> DataFrame:
    """(epoch, benchmark, 8 means) of every epoch's suites."""
    return judged.groupBy(epoch, suite).agg(*_means(EPOCH, 6)).drop("n")


def ranked_lists(ranking: DataFrame, k: int = 10, query: str = "query_id", item: str = "coordinate") -> DataFrame:
    """(query_id, ranked): each query's first k items of (query_id, item, rank)."""
    rows = ranking.filter(F.col("rank") <= k).groupBy(query).agg(F.array_sort(F.collect_list(F.struct("rank", item))).alias("r"))
    return rows.select(query, F.transform("r", lambda x: x[item]).alias("ranked"))


def close_rivals(scored: DataFrame, k: int = 6, query: str = "query_id") -> DataFrame:
    """scored (query_id, coordinate, sim, is_target) cut to each query's k best and its target, with the place."""
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy(query).orderBy(F.desc("sim"), "coordinate"))
    return scored.withColumn("place", place).filter((F.col("place") <= k) | F.col("is_target"))


def ranked_examples(deltas: DataFrame, friendly: Column | None = None) -> DataFrame:
    """rank deltas as examples, wins and losses alike: friendly owners first, then those with most siblings, then the largest change."""
    flag = friendly if friendly is not None else F.lit(True)
    return deltas.withColumn("friendly", flag).orderBy(F.desc("friendly"), F.desc("siblings"), F.desc(F.abs("delta")), "query_id")


def background(coords: DataFrame, target: str, n: int = 200, seed: str = "0") -> DataFrame:
    """n coordinates, in hashed order, that don't have the target's field name."""
    from fieldloom.functions.text import choice_key, field_of

    name = target.partition(".")[2].lower()
    return coords.filter(F.lower(field_of(F.col("coordinate"))) != name).orderBy(choice_key(seed, F.col("coordinate")), "coordinate").limit(n)


def plane(points: DataFrame, vector: str = "embedding") -> DataFrame:
    """points with x and y: their vectors on the two principal axes, each axis signed so that its largest weight is positive.

    The covariance is summed in the cluster; only it comes to the driver.
    """
    import numpy as np

    sums = points.select(F.posexplode(vector).alias("i", "x")).groupBy("i").agg(F.avg("x").alias("m"))
    mean = np.array([r["m"] for r in sums.orderBy("i").collect()])  # a row a dimension
    if not len(mean):
        return points.select("*", F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    dims = len(mean)

    def gram(batches):
        import pyarrow as pa

        total = np.zeros((dims, dims))
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims) - mean
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()])], names=["g"])

    parts = points.select(vector).mapInArrow(gram, "g array<double>").select(F.posexplode("g").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v")).orderBy("i").collect()  # dims * dims rows
    _, axes = np.linalg.eigh(np.array([r["v"] for r in parts]).reshape(dims, dims))
    axes = axes[:, ::-1][:, :2]
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), range(axes.shape[1])])
    on = lambda j: F.aggregate(F.zip_with(F.col(vector), F.array(*(F.struct(F.lit(float(m)).alias("m"), F.lit(float(w)).alias("w")) for m, w in zip(mean, axes[:, j], strict=True))), lambda v, a: (v.cast("double") - a["m"]) * a["w"]), F.lit(0.0), lambda s, v: s + v)
    return points.select("*", on(0).alias("x"), on(1).alias("y"))
