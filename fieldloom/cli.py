"""Command line: ``python -m fieldloom.cli <command>``. Tables go in and out as folders of JSON lines, or Parquet where a path ends so."""

from __future__ import annotations

import argparse
import importlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.operators import compare, evaluation, filters, generation, index, mining, planning, retrieval, seeds, tables
from fieldloom.plans import corpus as corpora
from fieldloom.plans import dataset, views
from fieldloom.sources import schemas, worlds
from fieldloom.sources import tables as io

CORPUS = "doc_id string, coordinate string, owner_type string, field_name string, return_type string, argument_signature string, description string, owner_description string, aliases array<string>, path_to_root array<string>, short_text string, full_text string, retrieval_text string, coordinate_text string, field_signature_text string, field_semantic_text string, sdl_snippet_text string, keywords_text string, world_id string, domain string, source string"
QUERIES = "query_id string, query string, positive_coordinate string, split string, source string, family_id string, quality_score double, negative_coordinates array<string>, relevant_coordinates array<string>, owner_type string, field_name string, world_id string, domain string, world_split string, difficulty string, intent string, confuser_tags array<string>, adversarial_tags array<string>, noise_tags array<string>, rationale_tags array<string>, confuser_coordinates array<string>"
VIEWS = ("coordinate", "signature", "semantic", "sdl")


def read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.parquet(path) if path.endswith(".parquet") else io.read_jsonl(spark, path, schema)


def write(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path) if path.endswith(".parquet") else io.write_jsonl(df, path)


def encoder_of(ref: str):
    """None for the token buckets, else the object that ``module:name`` names; there is no fallback."""
    if ref == "token-buckets-512":
        return None
    module, _, name = ref.partition(":")
    if not name:
        raise SystemExit(f"model {ref!r}: name an encoder as module:object, or token-buckets-512")
    return getattr(importlib.import_module(module), name)


def ranking(queries: DataFrame, corpus: DataFrame, view: str, model: str, k: int = 10) -> DataFrame:
    """(query_id, coordinate, rank, sim) of each query's k best rows of the corpus."""
    text = corpus.select("doc_id", "coordinate", corpora.view_text(view).alias("text"))
    corpora.assert_view(text, "text")
    from fieldloom.operators.dedupe import kept

    docs = kept(text.withColumn("vec_id", F.monotonically_increasing_id()))
    asked = kept(queries.select("query_id", "query").withColumn("vec_id", -1 - F.monotonically_increasing_id()))
    encoder = encoder_of(model)
    found = retrieval.top_k(kept(index.encode(asked, "vec_id", "query", encoder)), kept(index.encode(docs, "vec_id", "text", encoder)), k)
    return found.join(asked.select(F.col("vec_id").alias("q"), F.col("query_id").alias("asked")), F.col("query_id") == F.col("q")).join(docs.select("vec_id", "coordinate"), F.col("doc_id") == F.col("vec_id")).select(F.col("asked").alias("query_id"), "coordinate", "rank", "sim")


def judged(queries: DataFrame, corpus: DataFrame, view: str, model: str, versus: str = "relevant") -> DataFrame:
    lists = evaluation.ranked_lists(ranking(queries, corpus, view, model))
    return evaluation.judge(queries.join(lists, "query_id", "left"), versus)


def ingest_schema(spark, a):
    write(schemas.read_schemas(spark, a.input), f"{a.out_dir}/types")


def build_corpus(spark, a):
    write(corpora.build_corpus(read(spark, a.normalized, schemas.TYPE_SCHEMA)), f"{a.out_dir}/corpus_v{a.version}")


def backfill(spark, a):
    rows = read(spark, a.corpus, CORPUS)
    if a.worlds_dir:
        rows = corpora.backfill(rows, worlds.world_corpus(worlds.field_catalog(read(spark, f"{a.worlds_dir}/types.parquet", worlds.CATALOG))))
    write(rows.withColumn("retrieval_text", corpora.view_text(a.primary_retrieval_view)), a.out)


def generate_seed(spark, a):
    own = io.read_settings(a.config)
    made = worlds.generate_worlds(spark, a.world_count or own.get("world_count", 10), (a.min_types or 20, a.max_types or 36), seed=a.seed)
    folder = f"{a.out_dir}/worlds/v{a.version}"
    made.write.mode("overwrite").parquet(f"{folder}/types.parquet")
    made = spark.read.parquet(f"{folder}/types.parquet")
    fields = worlds.field_catalog(made)
    rows = made.select("world_id", "world_index", "domain").distinct().join(worlds.world_splits(made), "world_index")
    write(rows, f"{folder}/manifest")
    write(worlds.schema_texts(made), f"{folder}/schemas")
    write(worlds.world_corpus(fields), f"{a.out_dir}/corpus/types_worlds_v{a.version}")
    if a.mock_responses_path:
        sets = planning.competition_sets(fields, a.competition_set_cap or 6)
        write(seeds.competition_prompts(sets, fields, a.phrasings_per_target or 4), f"{a.out_dir}/prompts_v{a.version}")
        targets = fields.join(sets.filter("place = 0").select("world_id", "coordinate"), ["world_id", "coordinate"], "left_semi").withColumn("requested", F.lit(a.phrasings_per_target or 4))
        plan = planning.back_fill(planning.batch_plan(targets, a.items_per_world, key="coordinate"), a.items_per_world, a.request_batch_size, worlds=rows)
        numbered = spark.read.text(a.mock_responses_path, wholetext=True).select(F.posexplode(F.from_json("value", "array<string>")).alias("place", "response"))
        told = planning.mock_responses(plan.join(rows.select("world_id", "world_index"), "world_id"), numbered)
        items, batch = seeds.items_of(told.select("world_id", F.col("batch_no").alias("batch"), F.col("response").alias("content")), "content").drop("content"), "mock"
        terms = dataset.world_terms(fields)
        known = fields.select(F.col("world_id").alias("world"), "coordinate")
        items = generation.valid_items(items.select("*", F.col("world_id").alias("world"), F.col("positive_coordinate").alias("positive"), F.col("relevant_coordinates").alias("relevant"), F.col("negative_coordinates").alias("negative")), terms, known)
        items = items.withColumn("relevant_coordinates", F.col("relevant")).withColumn("negative_coordinates", F.col("negative")).withColumn("no", F.col("batch") * 1000 + F.col("item_no"))
    elif a.allow_local_fallback:
        items, batch = seeds.generate_locally(fields, a.items_per_world, str(a.seed)), "local"
    else:
        raise SystemExit("no source of answers: give --mock-responses-path or --allow-local-fallback; hosted models aren't called")
    blank = [F.lit(None).cast(t).alias(c) for c, t in (("bucket", "string"), ("margin", "double"), ("base_wrong", "string"))]
    out = seeds.seed_rows(items.join(rows.select("world_id", "split", "domain"), "world_id").select("*", F.lit(batch).alias("batch_source"), *blank))
    if a.min_real_row_fraction is not None:
        filters.require_real_rows(out, least=a.min_real_row_fraction)
    write(out, f"{a.out_dir}/seed_pairs_v{a.version}")


def build_dataset(spark, a):
    own = {**io.read_settings(a.config), **{k: v for k, v in vars(a).items() if v is not None}}
    s = dataset.Settings(**{k: own[k] for k in dataset.Settings.__dataclass_fields__ if k in own})
    corpus = read(spark, a.corpus, CORPUS)
    final, stages = dataset.build(read(spark, a.openai_seed, QUERIES), corpus, s)
    folder = f"{a.out_dir}/datasets/v{s.version}"
    io.write_dataset(final, f"{folder}/rows")
    io.write_dataset(dataset.suites(final, corpus), f"{folder}/benchmarks", "benchmark")
    write(tables.sample(final, "query_id", 20, str(s.seed + 1)), f"{folder}/sanity_sample")
    digest = tables.structural_digest(corpus).first()["digest"]
    io.write_json(json.loads(dataset.manifest(final, stages, digest, s, a.schema_hash or "")), f"{folder}/manifest.json")


def generate_synthetic(spark, a):
    corpus = read(spark, a.corpus, CORPUS)
    types = corpus.groupBy(F.col("owner_type").alias("type_id")).agg(F.count(F.lit(1)).alias("field_count")).withColumn("type_name", F.col("type_id"))
    start = read(spark, a.openai_seed, QUERIES).select(F.col("owner_type").alias("type_id"), "family_id", "intent", "query", "source", "quality_score") if a.seed_source == "openai" else seeds.bootstrap(types, str(a.seed))
    rows = generation.expand(start, "query", a.max_expansions).select("type_id", "family_id", "intent", F.col("variant").alias("query"), F.col("origin").alias("source"), "quality_score")
    rows = filters.good_synthetic(rows).withColumn("query_id", F.concat_ws("-", "family_id", F.substring(F.sha2("query", 256), 1, 8)))
    best = tables.best_by_text(rows, "query", "quality_score", "query_id").select("query_id")
    rows = filters.family_leakage(rows.join(best, "query_id", "left_semi"), types.select(F.col("type_name").alias("name")))
    split = tables.family_split(rows, "family_id", str(a.seed), (a.train_ratio, a.val_ratio))
    rows = rows.join(split, "family_id")
    io.write_dataset(rows, f"{a.out_dir}/rows")
    write(seeds.realism_seed(rows), f"{a.out_dir}/realism_seed")
    write(seeds.adversarial_ambiguity(rows, types), f"{a.out_dir}/adversarial_ambiguity")


def mine_hard_negatives(spark, a):
    corpus, queries = read(spark, a.corpus, CORPUS), read(spark, a.queries, QUERIES)
    n = max(1, corpus.count())
    ranked = ranking(queries, corpus, "semantic", "token-buckets-512", n)
    told = ranked.join(queries.select("query_id", "positive_coordinate"), "query_id").filter("coordinate <> positive_coordinate")
    same = lambda part: part(F.col("coordinate")) == part(F.col("positive_coordinate"))
    from fieldloom.functions.text import field_of, owner_of

    got = mining.tiered(told.select("query_id", F.col("coordinate").alias("doc_id"), "rank", same(owner_of).alias("same_owner"), same(field_of).alias("same_field")), {"hard": a.hard_k, "medium": a.medium_k, "easy": a.easy_k})
    write(got, f"{a.out_dir}/hard_negatives")


def train_embedder(spark, a):
    corpus, rows = read(spark, a.corpus, CORPUS), read(spark, a.train, QUERIES)
    cols = {v: corpora.view_text(v) for v in VIEWS}
    docs = corpus.select("coordinate", views.positive_texts(cols, views.parse_views(a.positive_views)).alias("views"), corpora.view_text(a.primary_retrieval_view).alias("text"))
    write(planning.pair_texts(rows, io.first_of(docs, ["coordinate"], "text"), a.loss, a.num_hard_negatives, str(a.seed)), f"{a.out_dir}/pairs")
    print("pairs are written; the training of models is out of scope")


def eval_retrieval(spark, a):
    rows, corpus = io.read_split(spark, a.eval_set, QUERIES, a.split), read(spark, a.corpus, CORPUS)
    got = {}
    for side, model in (("base", a.base_model), ("tuned", a.tuned_model)):
        got[side] = evaluation.summarise(judged(rows, corpus, a.retrieval_view, model, "positive")).first().asDict() | {"encoder_id": model}
        io.write_json(got[side], f"{a.out_dir}/metrics_{side}.json")
    delta = {m: got["tuned"][m] - got["base"][m] for m in ("exact_match_at_1", "recall_at_5", "mrr_at_10", "ndcg_at_10")}
    io.write_json(delta, f"{a.out_dir}/metrics_delta.json")
    print(io.as_markdown([{"metric": m, "base": got["base"][m], "tuned": got["tuned"][m], "delta": d} for m, d in delta.items()], ["metric", "base", "tuned", "delta"]))


def run_benchmark(spark, a):
    rows = io.read_suites(spark, a.benchmark_dir, QUERIES).withColumnRenamed("suite", "benchmark")
    rows = rows.withColumn("_id", F.col("query_id")).withColumn("query_id", F.concat_ws("/", "benchmark", "query_id"))
    got = judged(rows, read(spark, a.corpus, CORPUS), a.retrieval_view, a.model).withColumn("encoder_id", F.lit(a.model))
    got.write.mode("overwrite").parquet(f"{a.out_dir}/per_query.parquet")
    got = spark.read.parquet(f"{a.out_dir}/per_query.parquet")
    io.write_csv(evaluation.run_suites(got), f"{a.out_dir}/benchmarks_summary")
    io.write_csv(evaluation.slices(got), f"{a.out_dir}/slices")


def plot_metrics(spark, a):
    if a.epoch_metrics:
        rows = spark.read.json(a.epoch_metrics)
        io.write_csv(rows, f"{a.out_dir}/epochs")
        io.write_csv(tables.best_epoch(rows, "benchmark", "epoch", "recall_at_5"), f"{a.out_dir}/best_epochs")
    if a.benchmark_summary:
        io.write_csv(spark.read.option("header", True).option("inferSchema", True).csv(a.benchmark_summary), f"{a.out_dir}/benchmarks")


def build_ann_index(spark, a):
    print(json.dumps(index.build_index(read(spark, a.corpus, CORPUS), a.out_dir, a.retrieval_view, encoder_of(a.model), a.model)))


def export_model(spark, a):
    raise SystemExit("the export of models is out of scope")


def merge_curated(spark, a):
    fields = QUERIES.replace("split string, source string, ", "")
    rows, torn = io.read_tolerant(spark, a.curated, fields)
    kept, rejected = seeds.merge_curated(rows, read(spark, a.corpus, CORPUS))
    text = lambda c, d: F.coalesce(c, F.lit(d)).alias(c)
    out = kept.withColumn("split", F.lit("test")).withColumn("world_split", F.lit("test")).withColumn("source", F.lit("curated-realism")).withColumn("quality_score", F.lit(1.0)).withColumn("query_id", F.coalesce("query_id", F.concat(F.lit("curated-realism-"), F.col("line") - 1))).withColumn("family_id", F.coalesce("family_id", F.concat(F.lit("curated:"), "positive_coordinate")))
    out = out.withColumn("difficulty", text("difficulty", "medium")).withColumn("intent", text("intent", "lookup")).drop("line")
    write(out, f"{a.out_dir}/benchmarks/{a.name}")
    reasons = rejected.unionByName(torn.select("line", F.lit("invalid json").alias("reason")))
    write(reasons, f"{a.out_dir}/rejected")
    print(json.dumps({"rows_kept": out.count(), "rows_rejected": reasons.count()}))


def ingest_real(spark, a):
    own = io.read_settings(a.config)
    types, rows = schemas.ingest_schemas(spark, f"{a.schemas_dir}/*.{{graphql,json}}", own.get("real_split_overrides"))
    write(rows, f"{a.out_dir}/real_worlds")
    for r in rows.select("world_id", "domain").collect():  # a row a schema file
        one = corpora.build_corpus(types.filter(F.col("world_id") == r["world_id"]))
        one = worlds.rekey(one, F.lit(r["world_id"]), F.lit(r["domain"]))
        write(one, f"{a.out_dir}/corpus/{r['world_id']}")
        write(worlds.catalog_of(one), f"{a.out_dir}/catalog/{r['world_id']}")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="fieldloom")
    sub = p.add_subparsers(dest="command", required=True)

    def add(name, run, /, *needed, **options):
        own = sub.add_parser(name)
        own.set_defaults(run=run)
        for n in needed:
            own.add_argument(f"--{n}", required=True)
        for n, default in options.items():
            n = n.replace("_", "-")
            if isinstance(default, bool):
                own.add_argument(f"--{n}", action="store_true")
            elif isinstance(default, tuple):
                own.add_argument(f"--{n}", choices=default[1:], default=default[0])
            elif isinstance(default, type):
                own.add_argument(f"--{n}", type=default)
            else:
                own.add_argument(f"--{n}", type=type(default), default=default)

    view, buckets = ("semantic", *VIEWS), "token-buckets-512"
    add("ingest-schema", ingest_schema, "input", "out-dir")
    add("build-corpus", build_corpus, "normalized", "out-dir", version=1)
    add("backfill-structural-corpus", backfill, "corpus", "out", worlds_dir=str, primary_retrieval_view=view)
    add("generate-openai-seed", generate_seed, "out-dir", config=str, version=1, world_count=int, min_types=int, max_types=int, items_per_world=40, request_batch_size=10, seed=42, mock_responses_path=str, allow_local_fallback=False, min_real_row_fraction=float, phrasings_per_target=int, competition_set_cap=int)
    add("build-dataset", build_dataset, "corpus", "openai-seed", "out-dir", config=str, version=int, seed=int, target_train_max=int, semantic_dedupe_threshold=float, leakage_threshold=float, min_quality_score=float, schema_hash=str)
    add("generate-synthetic", generate_synthetic, "corpus", "out-dir", seed_source=("local", "local", "openai"), openai_seed=str, seed=42, max_expansions=6, train_ratio=0.8, val_ratio=0.1)
    add("mine-hard-negatives", mine_hard_negatives, "corpus", "queries", "out-dir", hard_k=5, medium_k=5, easy_k=5)
    add("train-embedder", train_embedder, "train", "corpus", "out-dir", positive_views="coordinate,signature,semantic,sdl", primary_retrieval_view=view, loss=("cached_mnrl", "cached_mnrl", "mnrl", "triplet"), num_hard_negatives=4, seed=42)
    add("eval-retrieval", eval_retrieval, "eval-set", "corpus", "tuned-model", "out-dir", split=str, base_model=buckets, retrieval_view=view)
    add("run-benchmark", run_benchmark, "benchmark-dir", "corpus", "out-dir", model=buckets, retrieval_view=view)
    add("plot-metrics", plot_metrics, "out-dir", epoch_metrics=str, benchmark_summary=str)
    add("build-ann-index", build_ann_index, "corpus", "out-dir", model=buckets, retrieval_view=view)
    add("export-ollama", export_model)
    add("merge-curated-benchmark", merge_curated, "curated", "corpus", "out-dir", name="curated_realism_eval")
    add("ingest-real-schemas", ingest_real, "schemas-dir", "out-dir", config=str)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(argv)
    a.run(spark or SparkSession.builder.appName("fieldloom").getOrCreate(), a)


if __name__ == "__main__":
    main()
