import json

import pytest
from pyspark.sql import functions as F

from fieldloom import cli
from fieldloom.sources import tables as io


def run(spark, *argv):
    cli.main([str(a) for a in argv], spark)


@pytest.fixture(scope="module")
def home(spark, tmp_path_factory):
    """Worlds, seeds and a dataset made by the commands."""
    to = tmp_path_factory.mktemp("cli")
    run(spark, "generate-openai-seed", "--out-dir", to, "--world-count", 12, "--min-types", 8, "--max-types", 12, "--items-per-world", 25, "--allow-local-fallback")
    run(spark, "build-dataset", "--corpus", to / "corpus" / "types_worlds_v1", "--openai-seed", to / "seed_pairs_v1", "--out-dir", to, "--leakage-threshold", 1.0, "--version", 2)
    return to


def test_dataset(spark, home):
    told = json.loads((home / "datasets" / "v2" / "manifest.json").read_text())
    rows = spark.read.parquet(str(home / "datasets" / "v2" / "rows"))
    assert told["counts"]["split"] == {r.split: r["count"] for r in rows.groupBy("split").count().collect()} and told["settings"]["leakage_threshold"] == 1.0
    assert told["ratios"]["fallback_share"] == 1.0 and any("fallback" in w for w in told["warnings"])
    assert spark.read.parquet(str(home / "datasets" / "v2" / "benchmarks")).filter("benchmark = 'synthetic_holdout'").count() == told["counts"]["split"]["test"]


def test_evaluation_commands(spark, home):
    corpus = home / "corpus" / "types_worlds_v1"
    rows = spark.read.parquet(str(home / "datasets" / "v2" / "rows")).filter("split = 'test'").limit(8)
    io.write_jsonl(rows, str(home / "eval"))
    run(spark, "eval-retrieval", "--eval-set", home / "eval", "--corpus", corpus, "--tuned-model", "token-buckets-512", "--out-dir", home / "out", "--split", "test")
    base, tuned, delta = (json.loads((home / "out" / f"metrics_{s}.json").read_text()) for s in ("base", "tuned", "delta"))
    assert base == tuned and base["n"] == 8 and set(delta.values()) == {0.0} and base["encoder_id"] == "token-buckets-512"
    (home / "suites").mkdir()
    lines = [r.value for r in spark.read.text(str(home / "eval")).collect()]
    (home / "suites" / "one.jsonl").write_text("\n".join(lines[:5]) + "\n")
    (home / "suites" / "two.jsonl").write_text("\n".join(lines[5:]) + "\n")
    run(spark, "run-benchmark", "--benchmark-dir", home / "suites", "--corpus", corpus, "--out-dir", home / "bench")
    got = {r.benchmark: int(r.n) for r in spark.read.option("header", True).csv(str(home / "bench" / "benchmarks_summary")).collect()}
    assert got == {"one": 5, "two": 3}
    run(spark, "mine-hard-negatives", "--corpus", corpus, "--queries", home / "eval", "--out-dir", home / "neg", "--hard-k", 2, "--medium-k", 1, "--easy-k", 3)
    neg = spark.read.json(str(home / "neg" / "hard_negatives")).groupBy("query_id", "tier").count().collect()
    assert {r.tier for r in neg} == {"hard", "medium", "easy"} and all(r["count"] <= {"hard": 2, "medium": 1, "easy": 3}[r.tier] for r in neg)
    run(spark, "train-embedder", "--train", home / "eval", "--corpus", corpus, "--out-dir", home / "pairs", "--loss", "triplet")
    assert spark.read.json(str(home / "pairs" / "pairs")).count() == 8
    run(spark, "build-ann-index", "--corpus", corpus, "--out-dir", home / "index", "--retrieval-view", "sdl")
    assert spark.read.parquet(str(home / "index" / "vectors")).count() == spark.read.json(str(corpus)).count()
    with pytest.raises(SystemExit):
        run(spark, "eval-retrieval", "--eval-set", home / "eval", "--corpus", corpus, "--tuned-model", "org/model", "--out-dir", home / "no")


def test_schema_commands(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "shop.graphql").write_text('"A thing" type Thing { id: ID! label(short: Boolean): String } type Query { thing: Thing }')
    run(spark, "ingest-schema", "--input", tmp_path / "in" / "shop.graphql", "--out-dir", tmp_path / "o")
    run(spark, "build-corpus", "--normalized", tmp_path / "o" / "types", "--out-dir", tmp_path / "o")
    rows = {r.coordinate: r for r in spark.read.json(str(tmp_path / "o" / "corpus_v1")).collect()}
    assert set(rows) == {"Thing.id", "Thing.label", "Query.thing"} and rows["Thing.label"].field_signature_text == "Thing.label(short: Boolean): String"
    run(spark, "backfill-structural-corpus", "--corpus", tmp_path / "o" / "corpus_v1", "--out", tmp_path / "o" / "filled", "--primary-retrieval-view", "sdl")
    assert spark.read.json(str(tmp_path / "o" / "filled")).filter("retrieval_text = sdl_snippet_text").count() == 3
    run(spark, "ingest-real-schemas", "--schemas-dir", tmp_path / "in", "--out-dir", tmp_path / "real")
    (w,) = spark.read.json(str(tmp_path / "real" / "real_worlds")).collect()
    assert w.domain == "shop" and w.split == "test" and w.type_count == 2
    assert spark.read.json(str(tmp_path / "real" / "corpus" / w.world_id)).filter(F.col("doc_id").startswith(w.world_id)).count() == 3
    (tmp_path / "cur.jsonl").write_text('{"query": "which label", "positive_coordinate": "Thing.label"}\n{"query": "x", "positive_coordinate": "No.x"}\n')
    run(spark, "merge-curated-benchmark", "--curated", tmp_path / "cur.jsonl", "--corpus", tmp_path / "o" / "corpus_v1", "--out-dir", tmp_path / "m")
    assert [r.query_id for r in spark.read.json(str(tmp_path / "m" / "benchmarks" / "curated_realism_eval")).collect()] == ["curated-realism-0"]
    run(spark, "generate-synthetic", "--corpus", tmp_path / "o" / "corpus_v1", "--out-dir", tmp_path / "syn")
    assert {r.split for r in spark.read.parquet(str(tmp_path / "syn" / "rows")).collect()} <= {"train", "val", "test"}
    (tmp_path / "ep.jsonl").write_text('{"benchmark": "a", "epoch": 1, "recall_at_5": 0.5}\n{"benchmark": "a", "epoch": 2, "recall_at_5": 0.5}\n')
    run(spark, "plot-metrics", "--epoch-metrics", tmp_path / "ep.jsonl", "--out-dir", tmp_path / "plots")
    assert spark.read.option("header", True).csv(str(tmp_path / "plots" / "best_epochs")).first().best_epoch == "1"


def test_mock_answers(spark, tmp_path):
    items = [{"query": "who is in charge of this thing", "positive_coordinate": "No.where", "difficulty": "hard", "intent": "lookup"}]
    (tmp_path / "mock.json").write_text(json.dumps([{"items": items}, {"items": []}]))
    run(spark, "generate-openai-seed", "--out-dir", tmp_path, "--world-count", 3, "--min-types", 5, "--max-types", 6, "--items-per-world", 12, "--mock-responses-path", tmp_path / "mock.json")
    assert spark.read.text(str(tmp_path / "seed_pairs_v1")).count() == 0  # no known coordinate
    assert spark.read.json(str(tmp_path / "prompts_v1")).count() > 0
    with pytest.raises(SystemExit):
        run(spark, "generate-openai-seed", "--out-dir", tmp_path)
