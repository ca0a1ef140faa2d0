"""The dataset build as one plan: splits, filters with counts of every stage, dedupe, mining, suites and the manifest."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.operators import filters
from fieldloom.operators.dedupe import kept, semantic_dedupe
from fieldloom.operators.mining import mine_negatives
from fieldloom.operators.seeds import curated_queries
from fieldloom.operators.tables import route_split

SPLITS = ("train", "val", "test")


@dataclass(frozen=True)
class Settings:
    version: int = 1
    seed: int = 42
    semantic_dedupe_threshold: float = 0.97
    leakage_threshold: float = 0.2
    min_quality_score: float = 0.25
    target_train_max: int | None = None


def world_terms(corpus: DataFrame) -> DataFrame:
    """(world, term): each world's coordinates, owners and field names in small letters, once each."""
    return corpus.select(F.coalesce("world_id", F.lit("unknown")).alias("world"), F.explode(F.array("coordinate", "owner_type", "field_name")).alias("term")).select("world", F.lower("term").alias("term")).distinct()


def union_corpora(*corpora: DataFrame) -> DataFrame:
    """Rows of all corpora by column name; columns that one lacks are null there."""
    out = corpora[0]
    for more in corpora[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    return out


def counts_by(rows: DataFrame, columns: tuple[str, ...] = ("split", "source", "intent", "world_split", "domain")) -> DataFrame:
    """(column, value, n) of each column in one pass; null and empty are unknown."""
    pairs = F.array(*(F.struct(F.lit(c).alias("column"), F.coalesce(F.nullif(F.col(c).cast("string"), F.lit("")), F.lit("unknown")).alias("value")) for c in columns))
    return rows.select(F.explode(pairs).alias("p")).groupBy("p.column", "p.value").agg(F.count(F.lit(1)).alias("n"))


def ratios(rows: DataFrame) -> DataFrame:
    """One row: mean size of the relevant sets, shares of rows with adversarial and confuser tags and of fallback sources; nought for no rows."""
    some = lambda c: (F.size(F.coalesce(c, F.array().cast("array<string>"))) > 0).cast("double")
    mean = lambda c: F.coalesce(F.avg(c), F.lit(0.0))
    return rows.agg(mean(F.size(F.coalesce("relevant_coordinates", F.array().cast("array<string>")))).alias("avg_relevant_coordinates"), mean(some("adversarial_tags")).alias("adversarial_ratio"), mean(some("confuser_tags")).alias("confuser_ratio"), F.bround(mean(F.contains(F.coalesce("source", F.lit("unknown")), F.lit("fallback")).cast("double")), 4).alias("fallback_share"))


def warnings(stages: DataFrame, fallback_share: float) -> DataFrame:
    """(warning): splits of which under a fifth is left, and a share of half or more of fallback rows."""
    few = stages.filter("pre_filter > 0 and final / pre_filter < 0.2").select(F.concat(F.lit("Aggressive filtering on split '"), "split", F.lit("': "), F.col("final").cast("string"), F.lit("/"), F.col("pre_filter").cast("string"), F.lit(" rows survived (<20%)")).alias("warning"))
    if fallback_share >= 0.5:
        few = few.unionByName(stages.limit(1).select(F.lit(f"{fallback_share:.0%} of the rows are from the local fallback").alias("warning")))
    return few


def _require(rows: DataFrame, splits: tuple[str, ...], message: str) -> None:
    there = {r["split"] for r in rows.select("split").distinct().collect()}  # three values
    if missing := [s for s in splits if s not in there]:
        raise ValueError(f"{message}: {', '.join(missing)}")


def build(queries: DataFrame, corpus: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, DataFrame]:
    """(rows, stages): the rows of the dataset, and for each split the rows left after every stage.

    queries are rows of seeds (see seeds.seed_rows); corpus has world_id, coordinate, owner_type,
    field_name, return_type, aliases. Rows of at least the least score take their world's
    split. Filters are flags on one table that is written once: unclear queries,
    worlds that leak too much in their split, and, for val and test, queries that share a
    stem with their target. Near texts of a split go; a held-out split that would
    be left empty keeps what it had. Negatives are mined for the rest. Fails
    without val or test rows before, or train rows after.
    """
    split = route_split(F.col("world_split"), F.col("split"))
    rows = queries.filter(F.col("quality_score") >= settings.min_quality_score).withColumn("split", split)
    rows = kept(rows.withColumn("row_no", F.monotonically_increasing_id()))
    _require(rows, ("val", "test"), "no rows of the held-out splits")
    clear = rows.filter(filters.is_clear(F.col("query"), F.col("positive_coordinate")))
    # a world's share of leaks is taken within each split
    asked = clear.select("row_no", "query", F.coalesce(F.nullif("world_id", F.lit("")), F.lit("unknown")).alias("world"), "split")
    flagged = filters.leak_flags(asked, world_terms(corpus))
    ok = flagged.groupBy("world", "split").agg(F.avg("leaked").alias("share")).filter(F.col("share") <= settings.leakage_threshold).select("world", "split")
    sound = kept(clear.join(flagged.join(ok, ["world", "split"], "left_semi").select("row_no"), "row_no", "left_semi"))
    strict = sound.filter((F.col("split") == "train") | ~F.coalesce(filters.leaks_schema(F.col("query"), F.col("owner_type"), F.col("field_name")), F.lit(False)))
    strict = kept(strict)
    family = F.concat_ws("|", F.coalesce("world_id", F.lit("unknown")), "positive_coordinate")
    out = None
    for s in SPLITS:
        part = strict.filter(F.col("split") == s).withColumn("_family", family)
        left = semantic_dedupe(part, "row_no", "query", "_family", settings.semantic_dedupe_threshold).drop("_family")
        out = left if out is None else out.unionByName(left)
    out = kept(out)
    empty = strict.filter("split <> 'train'").join(out.select("split").distinct(), "split", "left_anti")
    out = out.unionByName(empty)
    final = mine_negatives(out, corpus, str(settings.seed)).withColumn("relevant_coordinates", F.when(F.size(F.coalesce("relevant_coordinates", F.array().cast("array<string>"))) > 0, F.col("relevant_coordinates")).otherwise(F.array("positive_coordinate")))
    if settings.target_train_max is not None:
        train = final.filter("split = 'train'").orderBy("row_no").limit(settings.target_train_max)
        final = train.unionByName(final.filter("split <> 'train'"))
    final = kept(final)
    _require(final, ("train",), "no rows are left after the filters")
    steps = {"pre_filter": rows, "after_ambiguity": clear, "after_world_leakage": sound, "after_strict_leakage": strict, "after_semantic_dedupe": out, "final": final}
    stages = queries.sparkSession.createDataFrame([(s,) for s in SPLITS], "split string")
    for name, df in steps.items():
        stages = stages.join(df.groupBy("split").agg(F.count(F.lit(1)).alias(name)), "split", "left")
    return final.drop("row_no"), stages.na.fill(0)


def suites(rows: DataFrame, corpus: DataFrame) -> DataFrame:
    """rows of each suite with its name as ``benchmark``: a test row is in every suite that it fits.

    realism has no adversarial tags and adversarial some; ambiguity several
    relevant; real_schema the worlds of ingested schemas; holdout all. The
    curated challenge is rendered from the corpus of the test worlds, or all of
    it where none is named.
    """
    test = rows.filter("split = 'test'")
    some = lambda c, n: F.size(F.coalesce(c, F.array().cast("array<string>"))) > n
    real = corpus.filter("source = 'real-schema'").select(F.col("world_id")).distinct().withColumn("_real", F.lit(True)) if "source" in corpus.columns else None
    test = test.join(real, "world_id", "left") if real is not None else test.withColumn("_real", F.lit(None).cast("boolean"))
    names = F.array_compact(F.array(F.when(some("adversarial_tags", 0), "adversarial_eval").otherwise("realism_eval"), F.lit("synthetic_holdout"), F.when(some("relevant_coordinates", 1), "ambiguity_eval"), F.when(F.col("_real"), "real_schema_eval")))
    out = test.withColumn("benchmark", F.explode(names)).drop("_real")
    worlds = test.select("world_id").distinct()
    own = corpus.join(worlds, "world_id", "left_semi")
    own = own if own.limit(1).count() else corpus
    curated = curated_queries(own).join(own.groupBy("coordinate").agg(*(F.first(c).alias(c) for c in ("doc_id", "owner_type", "field_name", "world_id") if c in own.columns)), "coordinate")
    curated = curated.select(F.concat_ws("-", F.lit("curated"), "doc_id", F.substring(F.sha2("query", 256), 1, 8)).alias("query_id"), "query", F.col("coordinate").alias("positive_coordinate"), F.lit("test").alias("split"), F.lit("curated-challenge").alias("source"), F.concat(F.lit("curated:"), "coordinate").alias("family_id"), F.lit(1.0).alias("quality_score"), F.array("coordinate").alias("relevant_coordinates"), "owner_type", "field_name", "world_id", F.lit("test").alias("world_split"), "difficulty", "intent", F.array("slice").alias("confuser_tags"), F.array(F.lit("curated"), F.lit("release-gate")).alias("rationale_tags"), F.lit("curated_challenge_eval").alias("benchmark"))
    return out.unionByName(curated, allowMissingColumns=True).select(*out.columns)


def manifest(rows: DataFrame, stages: DataFrame, corpus_digest: str, settings: Settings = Settings(), schema_hash: str = "") -> str:
    """The manifest as JSON with sorted keys: settings, digests, counts of stages and columns, ratios, warnings."""
    counts: dict[str, dict[str, int]] = {}
    for r in counts_by(rows).collect():  # a row a value of five small columns
        counts.setdefault(r["column"], {})[r["value"]] = r["n"]
    told = ratios(rows).first().asDict()
    per_stage = {r["split"]: {k: v for k, v in r.asDict().items() if k != "split"} for r in stages.collect()}  # three rows
    said = sorted(r["warning"] for r in warnings(stages, told["fallback_share"]).collect())  # at most four
    return json.dumps({"settings": asdict(settings), "schema_hash": schema_hash, "corpus_digest": corpus_digest, "corpus_view_version": 2, "counts": counts, "per_stage_counts": per_stage, "ratios": told, "warnings": said, "release_gate_benchmark": "curated_challenge_eval"}, indent=2, sort_keys=True)
