import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldloom.functions import text as T
from fieldloom.operators import evaluation, filters, index, seeds, tables
from fieldloom.plans import dataset, views
from fieldloom.sources import schemas, worlds
from fieldloom.sources import tables as scans


def one(spark, *cols):
    return tuple(spark.range(1).select(*cols).first())


def test_scalars(spark):
    lit = F.lit
    assert one(spark, T.camel_tokens(lit("HTTPServerId_v2.fooBar"))) == (["http", "server", "id", "v2", "foo", "bar"],)
    assert one(spark, T.owner_of(lit("A.b.c")), T.field_of(lit("A.b.c")), T.field_of(lit("x"))) == ("A", "b.c", "x")
    assert one(spark, T.path_to_root(lit("OrderLine"), lit("id"))) == (["OrderLine.id", "Query.orderLine"],)
    assert one(spark, T.half_even(lit(2.5)), T.half_even(lit(0.00005), 4)) == (2.0, 0.0)
    assert one(spark, T.wrap(lit("aa bb  cccccc d"), 5)) == ("aa bb\ncccccc\nd",)
    assert one(spark, T.domain_of(lit("My-Shopify-api"), schemas.KNOWN_DOMAINS), T.domain_of(lit("x"), schemas.KNOWN_DOMAINS)) == ("shop", "real")
    assert [T.warm_up_steps(*x) for x in ((100, 16, 3), (1, 16, 1), (1000, 10, 2))] == [1, 1, 10]
    assert T.is_local_model("./m") and T.is_local_model("a/b/c") and not T.is_local_model("org/model")
    assert one(spark, T.name_stem(lit("currentStatus")), T.unwrap_type(lit("[X!]!"))) == ("current", "X")


def test_views_and_aliases(spark):
    cols = {"coordinate": F.lit("A.b"), "signature": F.lit(" "), "semantic": F.lit("s"), "sdl": F.lit(None).cast("string")}
    assert one(spark, views.positive_texts(cols, ["sdl", "semantic", "signature", "typename"])) == (["s", "A.b"],)
    assert one(spark, filters.safe_aliases(F.array(*map(F.lit, ("Order", "der", "purchase", "statusCode", ""))), F.lit("Order"), F.lit("status"))) == (["purchase"],)
    assert one(spark, *(filters.is_friendly(F.lit(x), ("order", "user")) for x in ("OrderLine", "OrderPayload", "OrderExtension3", "Thing"))) == (True, False, False, False)


def test_strict_leakage_word_list(spark):
    leaks = lambda q, o, f: filters.leaks_schema(F.lit(q), F.lit(o), F.lit(f))
    assert one(spark, leaks("what email does the person use", "User", "email"), leaks("current order status please", "Order", "status"), leaks("give me the name and type", "Name", "type"), leaks("nothing alike", "User", "email")) == (True, True, False, False)
    assert one(spark, filters.is_clear(F.lit("one two three four"), F.lit(" ")), filters.is_clear(F.lit("one two three four"), F.lit("x"))) == (False, True)


def test_family_leakage(spark):
    rows = [("f", "show order", 0.9), ("f", "other text", 0.9), ("g", "an order here", 0.9), ("g", "orders", 0.9), (None, "plain", 0.9)]
    q = spark.createDataFrame(rows, "family_id string, query string, quality_score double")
    names = spark.createDataFrame([("Order",), ("Nope",)], "name string")
    assert sorted(r.query for r in filters.family_leakage(q, names).collect()) == ["other text", "plain", "show order"]
    assert filters.good_synthetic(q).count() == 1
    with pytest.raises(ValueError, match="real source"):
        filters.require_real_rows(spark.createDataFrame([("openai-world-seed",), ("local-fallback",)], "source string"))
    assert filters.require_real_rows(spark.createDataFrame([], "source string")).count() == 0


JUDGED = "query_id string, positive_coordinate string, relevant_coordinates array<string>, owner_type string, ranked array<string>, intent string, difficulty string, source string, confuser_tags array<string>, benchmark string, epoch int"


def test_metrics(spark):
    rows = [
        ("1", "A.x", ["A.y", "A.x", ""], "A", ["A.z", "A.y", "A.x"], "i", "easy", "s", ["t", "u"], "one", 1),
        ("2", "B.x", None, "B", ["B.x"], None, None, None, None, "two", 1),
        ("3", "C.x", [], "C", [], "i", "easy", "s", [], "one", 2),
    ]
    judged = evaluation.judge(spark.createDataFrame(rows, JUDGED))
    a, b, c = judged.orderBy("query_id").collect()
    assert (a.exact_match_at_1, a.recall_at_1, a.recall_at_3, a.set_recall_at_5, a.set_recall_all_at_5, a.coverage_at_5, a.same_owner_wrong_field_at_1, a.ambiguity_rate) == (0, 0, 1, 1, 1, 1, 1, 1)
    assert abs(a.mrr_at_10 - 1 / 3) < 1e-12 and abs(a.ndcg_at_10 - 0.5) < 1e-12
    assert (b.exact_match_at_1, b.recall_at_1, b.mrr_at_10, b.same_owner_wrong_field_at_1, b.is_ambiguous) == (1, 1, 1, 0, False)
    assert (c.exact_match_at_1, c.coverage_at_10, c.same_owner_wrong_field_at_1) == (0, 0, 0)
    alone = evaluation.judge(spark.createDataFrame([("1", "A.x", ["A.z"], "A", ["A.z"], None, None, None, None, "one", 1)], JUDGED), "positive").first()
    assert alone.same_owner_wrong_field_at_1 == 1 and alone.exact_match_at_1 == 1
    zero = evaluation.summarise(judged.limit(0)).first().asDict()
    assert set(zero.values()) == {0} and len(zero) == 14
    got = {r["slice"]: r.n for r in evaluation.slices(judged).collect()}
    assert got == {"intent:i": 2, "intent:unknown": 1, "difficulty:easy": 2, "difficulty:unknown": 1, "source:s": 2, "source:unknown": 1, "confuser:t": 1, "confuser:u": 1, "ambiguity:multi_relevant": 1, "ambiguity:single_relevant": 2}
    suites = {r.benchmark: r.n for r in evaluation.run_suites(judged, names=("one", "none")).collect()}
    assert suites == {"one": 2, "two": 1, "none": 0}
    assert evaluation.run_epochs(judged).count() == 3
    r = F.array(F.lit("a"), F.lit("b"))
    assert one(spark, *(evaluation.pair_recall(r, F.lit(x), F.lit(y), k) for x, y, k in (("a", "b", 2), ("a", "b", 1), ("a", "", 2)))) == (1, 0, 0)


def test_plane(spark):
    rnd = np.random.default_rng(2)
    x = rnd.normal(size=(50, 5)) * [5, 3, 1, 0.5, 0.1] + 7
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id int, embedding array<double>").repartition(3)
    got = np.array([(r.x, r.y) for r in evaluation.plane(df).orderBy("id").collect()])
    centred = x - x.mean(axis=0)
    _, _, axes = np.linalg.svd(centred, full_matrices=False)
    for j in range(2):
        a = axes[j] * np.sign(axes[j][np.abs(axes[j]).argmax()])
        assert np.allclose(got[:, j], centred @ a)


def test_objects_and_replay(spark):
    texts = ['{"a": 1}', 'x ```json\n{"a": {"b": 2}}\n``` y', "no {broken", 'first {bad} then {"ok": true} and {"no": 1}', None, "[1, 2]"]
    assert [seeds.first_object(t) for t in texts] == ['{"a": 1}', '{"a": {"b": 2}}', None, '{"ok": true}', None, None]
    item = {"query": "where is it kept", "positive_coordinate": "A.x", "relevant_coordinates": ["A.x"]}
    log = [{"world_id": "w", "split": "val", "batches": [{"batch": 0, "source": "mock", "competition_set": ["A.x"], "raw": {"parsed": None, "content": f"ok: {json.dumps({'items': [item, item]})}"}}, {"batch": 1, "source": "openai", "competition_set": [], "raw": {"parsed": json.dumps({"items": [item]}), "content": None}}, {"batch": 2, "source": "openai", "competition_set": [], "raw": None}]}]
    df = spark.read.schema("world_id string, split string, batches array<struct<batch:int,source:string,competition_set:array<string>,raw:struct<parsed:string,content:string>>>").json(spark.sparkContext.parallelize([json.dumps(x) for x in log]))
    w = spark.createDataFrame([("w", "test", "travel")], "world_id string, split string, domain string")
    got = sorted((r.batch, r.item_no, r.source, r.split, r.domain, r.positive_coordinate) for r in seeds.replay(df, w).collect())
    assert got == [(0, 0, "mock", "test", "travel", "A.x"), (0, 1, "mock", "test", "travel", "A.x"), (1, 0, "openai", "test", "travel", "A.x")]
    assert {r.split for r in seeds.replay(df).collect()} == {"val"}


def test_seed_rows(spark):
    rows = [("w", "d", "train", "openai", 0, "q one", "A.x", None, ["A.y", "A.z"], "hard", "lookup", ["t"], ["a"], ["r"], "hard", -0.12345, "A.z"), ("w", "d", "train", "other", 1, "q two", "A.x", ["A.x", "A.y"], None, "easy", "lookup", None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "world_id string, domain string, split string, batch_source string, no int, query string, positive_coordinate string, relevant_coordinates array<string>, negative_coordinates array<string>, difficulty string, intent string, confuser_tags array<string>, adversarial_tags array<string>, rationale_tags array<string>, bucket string, margin double, base_wrong string")
    a, b = seeds.seed_rows(df).orderBy("query_id").collect()[::-1]
    assert (a.source, a.quality_score, a.negative_coordinates, a.relevant_coordinates, a.owner_type, a.field_name, a.family_id) == ("openai-world-seed", 0.92, ["A.z", "A.y"], ["A.x"], "A", "x", "w:A.x")
    assert a.rationale_tags == ["r", "base_hard", "margin=-0.1234"] and a.adversarial_tags == ["a", "base_model_confuses_with:A.z"]
    assert (b.source, b.quality_score, b.negative_coordinates, b.rationale_tags) == ("local-fallback", 0.3, [], ["base_unmined", "margin=0.0"])


@pytest.fixture(scope="module")
def made(spark):
    w = worlds.generate_worlds(spark, 12, (8, 14), seed=3)
    return w.cache()


def test_worlds(spark, made):
    assert made.exceptAll(worlds.generate_worlds(spark, 12, (8, 14), seed=3).repartition(5)).count() == 0
    rows = made.collect()
    assert {r.world_id for r in rows} == {f"world_{i:04d}" for i in range(12)}
    for r in rows:
        names = [f.name for f in r.fields]
        assert names[:3] == ["id", "createdAt", "updatedAt"] and len(names) == len(set(names)) <= 10 and r.type_name not in r.neighbors and 2 <= len(r.neighbors) <= 4
    splits = {r.world_index: r.split for r in worlds.world_splits(made).collect()}
    assert [splits[i] for i in range(12)] == ["train"] * 9 + ["val"] + ["test"] * 2
    many = worlds.type_names(("A", "B", "C"), 5, __import__("random").Random(1))
    assert many == ["A", "B", "C", "AExtension1", "BExtension2"]
    catalog = worlds.field_catalog(made)
    corpus = worlds.world_corpus(catalog)
    assert corpus.count() == catalog.count() == sum(len(r.fields) for r in rows) and corpus.select("doc_id").distinct().count() == corpus.count()
    first = corpus.filter("field_name = 'createdAt'").first()
    assert first.description == "Timestamp when the record was created." and first.path_to_root == [first.coordinate, f"Query.{first.owner_type[0].lower()}{first.owner_type[1:]}"]
    assert worlds.type_lookup(made).filter("key = 'world_0000:Hotel'").count() == 1
    assert worlds.catalog_of(corpus).filter("owner_description = ''").count() == 0
    again = worlds.rekey(corpus.drop("world_id", "domain", "source"), F.lit("real_x"), F.lit("shop")).first()
    assert again.doc_id == f"real_x:{again.coordinate}" and again.source == "real-schema"


def test_schema_text_reads_back(spark, made):
    for r in worlds.schema_texts(made).collect():
        types = {t["type_name"]: t for t in schemas.parse_sdl(r.sdl)}
        own = {x.type_name: x for x in made.filter(F.col("world_id") == r.world_id).collect()}
        assert set(own) | {"Query", "User", "Node"} == set(types)
        for name, t in own.items():
            got = [f["name"] for f in types[name]["fields"]]
            assert len(got) == len(set(got)) and set(got) >= {f.name for f in t.fields}


def test_ingest(spark, tmp_path):
    (tmp_path / "shopify.graphql").write_text("type A { x: Int }\ntype Query { a: A }")
    (tmp_path / "b.graphql").write_text("type B { y: Int }")
    types, w = schemas.ingest_schemas(spark, f"{tmp_path}/*.graphql", {"b": "val", "shopify.graphql": "train"})
    assert [(r.file, r.domain, r.split, r.type_count) for r in w.collect()] == [("b.graphql", "real", "val", 1), ("shopify.graphql", "shop", "train", 2)]
    assert types.count() == 3


def test_local_generation_and_prompts(spark, made):
    fields = worlds.field_catalog(made)
    got = seeds.generate_locally(fields, 30).collect()
    assert len(got) > 150 and {r.intent for r in got} >= {"lookup", "temporal", "status"}
    for r in got:
        owner, field = r.positive_coordinate.lower().split(".")
        assert owner not in r.query.lower() and field not in r.query.lower() and len(r.query.split()) >= 4 and "{" not in r.query
        assert r.positive_coordinate not in r.negative_coordinates and ("owner_vs_field" in r.adversarial_tags) == ("same_owner" in r.confuser_tags)
    from fieldloom.operators.planning import competition_sets

    sets = competition_sets(fields, 4)
    asked = seeds.competition_prompts(sets, fields, 2).collect()
    assert len(asked) == sets.filter("place = 0").count()
    assert all(p.prompt.count("\n- plain") == 1 and "multi_clause" not in p.prompt and p.coordinate in p.prompt for p in asked)
    assert seeds.generic_prompts(fields).count() == 12
    said = fields.select(seeds.document_competitor(F.col("coordinate"), F.col("return_type"), F.lit(" "), F.lit("d")).alias("x")).first().x
    assert "Owner" not in said and said.endswith(". Description: d")


def test_bootstrap_and_suites(spark):
    types = spark.createDataFrame([("a", "OrderType", 0), ("b", "UserType", 3)], "type_id string, type_name string, field_count int")
    got = seeds.bootstrap(types).collect()
    assert len(got) == 28 and {r.query for r in got if r.type_id == "a" and r.intent == "comparative"} == {"difference between OrderType and UserType", "when should i use OrderType instead of UserType"}
    assert "what can i query about order" in {r.query for r in got} and "what can i query about usertype" in {r.query for r in got}
    q = spark.createDataFrame([("1", "test", "a", "f1", 0.5), ("2", "test", "zz", "f2", 0.5), ("3", "val", "b", "f3", 0.95), ("4", "val", "b", "f4", 0.2)], "query_id string, split string, type_id string, family_id string, quality_score double")
    adv = {r.query_id: r.query for r in seeds.adversarial_ambiguity(q, types).collect()}
    assert adv == {"adv-1": "i need ordertype info, not usertype, which graphql type is correct", "adv-2": "i need zz info, not ordertype, which graphql type is correct"}
    assert sorted((r.query_id, r.quality_score, r.source) for r in seeds.realism_seed(q).collect()) == [("3", 0.95, "manual-realism-seed"), ("4", 0.9, "manual-realism-seed")]


def test_curated(spark, tmp_path):
    corpus = spark.createDataFrame([(f"d{i}", f"A.{f}", "A", f, "w", "travel") for i, f in enumerate(("author", "status", "priceCents"))], "doc_id string, coordinate string, owner_type string, field_name string, world_id string, domain string")
    got = {(r.coordinate, r.query): r.difficulty for r in seeds.curated_queries(corpus).collect()}
    assert len(got) == 5 and got["A.priceCents", "Which field gives me the price amount?"] == "medium" and got["A.status", "Not the history, the field with the current status"] == "hard"
    (tmp_path / "c.jsonl").write_text('# note\n{"query": "q", "positive_coordinate": "A.status", "relevant_coordinates": ["No.x"], "negative_coordinates": ["A.author", "A.status", "No.y"]}\n{"query": "r", "positive_coordinate": "No.x"}\n{torn\n')
    rows, torn = scans.read_tolerant(spark, str(tmp_path / "c.jsonl"), "query string, positive_coordinate string, relevant_coordinates array<string>, negative_coordinates array<string>")
    kept, rejected = seeds.merge_curated(rows, corpus)
    (k,) = kept.collect()
    assert (k.line, k.relevant_coordinates, k.negative_coordinates, k.owner_type, k.field_name) == (2, ["A.status"], ["A.author"], "A", "status")
    assert [(r.line, r.reason) for r in rejected.collect()] == [(3, "positive_coordinate not in corpus: No.x")] and [r.line for r in torn.collect()] == [4]


def test_scans_and_sinks(spark, tmp_path):
    scans.write_jsonl(spark.createDataFrame([("é😀\"x", None), ("plain", 1)], "a string, b int"), str(tmp_path / "o"))
    text = "\n".join(sorted(r.value for r in spark.read.text(str(tmp_path / "o")).collect()))
    assert text.isascii() and sorted(json.loads(x)["a"] for x in text.splitlines()) == ["plain", "é😀\"x"] and '"b":null' in text
    scans.write_json({"b": 1, "a": [2]}, str(tmp_path / "x" / "m.json"))
    assert (tmp_path / "x" / "m.json").read_text().index('"a"') < (tmp_path / "x" / "m.json").read_text().index('"b"')
    assert scans.read_json(spark, str(tmp_path / "x" / "m.json")).first().b == 1
    (tmp_path / "q.jsonl").write_text('{"q": "x", "split": "val"}\n{"q": "y", "split": "test"}\n')
    assert [r.q for r in scans.read_split(spark, str(tmp_path / "q.jsonl"), "q string, split string", "val").collect()] == ["x"]
    assert scans.read_split(spark, str(tmp_path / "q.jsonl"), "q string, split string", "").count() == scans.read_split(spark, str(tmp_path / "q.jsonl"), "q string, split string").count() > 1
    (tmp_path / "s.yaml").write_text("a: 1\nb:\n  c: 0.5 # note\n  d: text\n")
    assert scans.read_settings(str(tmp_path / "s.yaml")) == {"a": 1, "b": {"c": 0.5, "d": "text"}} == scans._plain_yaml((tmp_path / "s.yaml").read_text()) and scans.read_settings(None) == {}
    for run, side, m in (("r1", "base", 0.1), ("r1", "tuned", 0.3), ("r2", "base", 0.2)):
        scans.write_json({"mrr@10": m, "note": "x"}, str(tmp_path / "runs" / run / f"metrics_{side}.json"))
    assert [(r.run, r.metric, r.base, r.tuned) for r in scans.read_runs(spark, str(tmp_path / "runs")).collect()] == [("r1", "mrr@10", 0.1, 0.3)]
    c = spark.createDataFrame([("2", "A.x", None, "late"), ("1", "A.x", "", "first")], "doc_id string, coordinate string, retrieval_text string, full_text string")
    assert [tuple(r) for r in scans.corpus_texts(c).collect()] == [("A.x", "first")]
    t = scans.look_up(spark.createDataFrame([("w", "val"), ("v", None)], "world_id string, split string"), spark.createDataFrame([("w", "test", "d")], "world_id string, split string, domain string"), "world_id", {"split": "train", "domain": "unknown"})
    assert sorted((r.world_id, r.split, r.domain) for r in t.collect()) == [("v", "train", "unknown"), ("w", "test", "d")]
    assert scans.as_markdown([{"a": 0.5, "b": None}], ["a", "b"]) == "| a | b |\n|---|---|\n| 0.500 |  |"
    assert "**A.x** (target)" in scans.as_example("q", "A.x", [{"rank": 1, "coordinate": "A.x", "score": 0.5}], [])


def test_digests(spark):
    import hashlib

    rows = [(f"d{i:02d}", f"c{i}", f"s{i}", None if i == 3 else f"t{i}", f"l{i}") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id string, coordinate_text string, field_signature_text string, field_semantic_text string, sdl_snippet_text string").repartition(5)
    want = hashlib.sha256("".join(f"{a}\n{b}\n{c}\n{d or ''}\n{e}\n" for a, b, c, d, e in rows).encode()).hexdigest()
    assert tables.structural_digest(df).first().digest == want


def test_index(spark, tmp_path):
    texts = ["red apple pie", "blue sky above", "green grass field"]
    df = spark.createDataFrame([(f"d{i}", f"A.f{i}", t, t, t, t) for i, t in enumerate(texts)], "doc_id string, coordinate string, coordinate_text string, field_signature_text string, field_semantic_text string, sdl_snippet_text string")
    got = index.build_index(df, str(tmp_path / "i"), "semantic")
    assert got["encoder_id"] == "token-buckets-512" and index.read_index(spark, str(tmp_path / "i"))[1] == got
    q = spark.createDataFrame([(0, "a blue sky"), (1, "the green grass")], "query_id long, query string")
    found = {(r.query_id, r.rank): r.coordinate for r in index.search_index(q, str(tmp_path / "i"), 2).collect()}
    assert found[0, 1] == "A.f1" and found[1, 1] == "A.f2" and len(found) == 4

    class Letters:
        def encode(self, texts):
            return [[t.count(c) for c in "abcdefghijklmnopqrstuvwxyz"] for t in texts]

    index.build_index(df, str(tmp_path / "j"), "semantic", Letters(), "letters")
    assert {r.coordinate for r in index.search_index(q, str(tmp_path / "j"), 1, Letters()).collect()} == {"A.f1", "A.f2"}
    with pytest.raises(ValueError, match="blank"):
        index.build_index(df.withColumn("field_semantic_text", F.lit(" ")).withColumn("coordinate", F.lit("")), str(tmp_path / "k"), "semantic")


def test_dataset_build(spark, made):
    corpus = worlds.world_corpus(worlds.field_catalog(made))
    items = seeds.generate_locally(worlds.field_catalog(made), 30)
    splits = made.select("world_id", "world_index", "domain").distinct().join(worlds.world_splits(made), "world_index")
    rows = seeds.seed_rows(items.join(splits.select("world_id", "split", "domain"), "world_id").selectExpr("*", "'mock' as batch_source", "cast(null as string) as bucket", "cast(null as double) as margin", "cast(null as string) as base_wrong"))
    settings = dataset.Settings(leakage_threshold=1.0)
    final, stages = dataset.build(rows, corpus, settings)
    per = {r.split: r for r in stages.collect()}
    assert set(per) == {"train", "val", "test"}
    for r in per.values():
        assert r.pre_filter >= r.after_ambiguity >= r.after_world_leakage >= r.after_strict_leakage >= r.final == r.after_semantic_dedupe > 0
    out = final.collect()
    assert len(out) == sum(r.final for r in per.values()) and all(r.negative_coordinates and r.positive_coordinate not in r.negative_coordinates for r in out)
    suites = {r.benchmark: r["count"] for r in dataset.suites(final, corpus).groupBy("benchmark").count().collect()}
    n_test = sum(r.split == "test" for r in out)
    assert suites["synthetic_holdout"] == n_test == suites.get("adversarial_eval", 0) + suites.get("realism_eval", 0) and suites["curated_challenge_eval"] > 5 and "real_schema_eval" not in suites
    told = json.loads(dataset.manifest(final, stages, tables.structural_digest(corpus).first().digest, settings))
    assert told["per_stage_counts"]["train"]["final"] == told["counts"]["split"]["train"] and told["ratios"]["fallback_share"] == 0 and told["counts"]["source"] == {"mock-seed": len(out)}
    with pytest.raises(ValueError, match="held-out"):
        dataset.build(rows.filter("world_split = 'train'"), corpus)
    small = dataset.build(rows, corpus, dataset.Settings(leakage_threshold=1.0, target_train_max=3))[0]
    assert small.filter("split = 'train'").count() == 3
    both = dataset.union_corpora(corpus, worlds.rekey(corpus.select("doc_id", "coordinate", "owner_type", "field_name"), F.lit("real_x"), F.lit("shop")))
    assert both.count() == 2 * corpus.count()


def test_warnings(spark):
    stages = spark.createDataFrame([("train", 100, 10), ("val", 10, 10)], "split string, pre_filter long, final long")
    assert sorted(r.warning for r in dataset.warnings(stages, 0.6).collect()) == ["60% of the rows are from the local fallback", "Aggressive filtering on split 'train': 10/100 rows survived (<20%)"]


def test_small_parts(spark):
    """View names, split routes, competitor texts, rivals, examples, background, ordered distinct."""
    from fieldloom.operators.generation import competitor_text

    assert views.parse_views("SDL, typename,sdl,,field_paths") == ["sdl", "coordinate", "signature"] and views.parse_views("") == ["semantic"]
    with pytest.raises(ValueError, match="unknown view"):
        views.parse_views("other")
    routes = [(None, None), ("VAL", "test"), ("", "Test"), ("odd", "val")]
    assert [one(spark, tables.route_split(F.lit(a).cast("string"), F.lit(b).cast("string")))[0] for a, b in routes] == ["train", "val", "test", "train"]
    long = "w" * 138 + " tail of it"
    said = one(spark, competitor_text(F.lit("A.b"), F.lit(long), F.lit("d")), competitor_text(F.lit("A.b"), F.lit(" "), F.lit("d")), competitor_text(F.lit("A.b"), F.lit(None).cast("string"), F.lit("")))
    assert said == ("A.b: " + "w" * 138 + "…", "A.b: d", "A.b")
    scored = spark.createDataFrame([(1, f"A.f{i}", 1 - i / 10, i == 9) for i in range(10)], "query_id int, coordinate string, sim double, is_target boolean")
    assert [(r.coordinate, r.place) for r in evaluation.close_rivals(scored, 3).orderBy("place").collect()] == [("A.f0", 1), ("A.f1", 2), ("A.f2", 3), ("A.f9", 10)]
    deltas = spark.createDataFrame([(1, 5, 2, "Thing"), (2, -9, 2, "Thing"), (3, 1, 7, "Odd"), (4, 1, 1, "Odd")], "query_id int, delta int, siblings int, owner string")
    assert [r.query_id for r in evaluation.ranked_examples(deltas, filters.is_friendly(F.col("owner"), ("thing",))).collect()] == [2, 1, 3, 4]
    coords = spark.createDataFrame([(f"A{i}.x",) for i in range(5)] + [(f"A{i}.y",) for i in range(300)], "coordinate string")
    some = [r.coordinate for r in evaluation.background(coords, "A0.X").collect()]
    assert len(some) == len(set(some)) == 200 and all(c.endswith(".y") for c in some)
    assert one(spark, evaluation.relevant_of(F.lit("b"), F.array(*map(F.lit, ("a", "b", "", "a", "c"))))) == (["b", "a", "c"],)


def test_semantic_dedupe_against_a_greedy_walk(spark):
    """Families capped by a greedy walk, then all survivors, against plain Python on hashed counts."""
    import hashlib
    import random

    from fieldloom.operators.dedupe import semantic_dedupe

    rnd = random.Random(4)
    base = [[f"t{rnd.randrange(60)}" for _ in range(12)] for _ in range(12)]
    rows = []
    for i in range(160):
        words = list(rnd.choice(base))
        for _ in range(rnd.choice([0, 0, 1, 2, 4])):
            words[rnd.randrange(12)] = f"t{rnd.randrange(60)}"
        rows.append((i, " ".join(words) if i % 40 else "", f"f{rnd.randrange(14)}" if i % 11 else None))

    def vector(text):
        v = np.zeros(512)
        for t in text.lower().split():
            v[int(hashlib.md5(t.encode()).hexdigest()[:8], 16) % 512] += 1
        return (v / (np.linalg.norm(v) + 1e-9)).astype(np.float32).astype(float)

    vec = {i: vector(t) for i, t, _ in rows}

    def walk(ids, most=None):
        out = []
        for i in ids:
            if (most is None or len(out) < most) and all(vec[i] @ vec[j] < 0.9 for j in out):
                out.append(i)
        return out

    by = {}
    for i, _, f in rows:
        by.setdefault(f or "", []).append(i)
    left = sorted(x for ids in by.values() for x in (ids if len(ids) <= 4 else walk(ids, 4)))
    want = walk(left)
    got = semantic_dedupe(spark.createDataFrame(rows, "k long, text string, family string").repartition(5), "k", "text", "family", 0.9)
    assert sorted(r.k for r in got.collect()) == want and len(want) < len(left) < 160
