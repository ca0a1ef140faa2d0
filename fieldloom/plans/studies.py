"""Registered queries of evaluation, mining, seeds and counts, each with SQL of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.functions import text as T
from fieldloom.operators import evaluation, filters, mining, planning, retrieval, seeds, tables
from fieldloom.plans import dataset
from fieldloom.sources import worlds


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as fields: ``blue bolt`` of Brand#12, size 3, is Brand12.blueBolt of world 3."""
    w = F.split("p_name", " ")
    name = F.concat(w[0], F.initcap(F.coalesce(F.get(w, F.lit(1)), F.lit(""))))
    owner = F.replace("p_brand", F.lit("#"), F.lit(""))
    aliases = F.array(w[0], F.concat(w[0], F.lit("Gear")), F.coalesce(F.get(w, F.lit(1)), F.lit("")))
    return read(spark, sf_dir, "part").select(F.col("p_partkey").alias("doc_id"), F.concat(F.lit("w"), F.col("p_size") % 10).alias("world_id"), owner.alias("owner_type"), name.alias("field_name"), F.col("p_type").alias("return_type"), F.concat(owner, F.lit("."), name).alias("coordinate"), aliases.alias("aliases"))


def ranked_rows(spark: SparkSession, sf_dir: str, dims: int = 64) -> DataFrame:
    """Every tenth vector as a query with its ten nearest others; vectors of its label are its field's owner's."""
    vec = read(spark, sf_dir, "embeddings").select("vec_id", "label", F.slice("embedding", 1, dims).alias("embedding"))
    where = F.concat(F.lit("L"), F.col("label"), F.lit(".v"), F.col("vec_id"))
    asked = vec.filter("vec_id % 10 = 0")
    found = retrieval.top_k(asked, vec, 10)
    lists = evaluation.ranked_lists(found.join(vec.select(F.col("vec_id").alias("doc_id"), where.alias("coordinate")), "doc_id"))
    firsts = vec.groupBy("label").agg(F.min("vec_id").alias("m1"))
    seconds = vec.join(firsts, "label").filter("vec_id > m1").groupBy("label").agg(F.min("vec_id").alias("m2"))
    of = asked.select("vec_id", "label").join(firsts, "label").join(seconds, "label", "left")
    to = lambda c: F.concat(F.lit("L"), F.col("label"), F.lit(".v"), c)
    positive = F.when(F.col("vec_id") == F.col("m1"), to(F.col("m2"))).otherwise(to(F.col("m1")))
    rows = of.select(
        F.col("vec_id").alias("query_id"), F.coalesce(positive, F.lit("")).alias("positive_coordinate"), F.when(F.col("vec_id") % 20 == 0, F.array(F.coalesce(to(F.col("m2")), F.lit("")), F.lit(""))).otherwise(F.array().cast("array<string>")).alias("relevant_coordinates"), F.concat(F.lit("L"), "label").alias("owner_type"),
        F.when(F.col("vec_id") % 40 == 0, F.lit(None)).otherwise(F.concat(F.lit("i"), F.col("vec_id") % 4)).alias("intent"), F.concat(F.lit("d"), F.col("vec_id") % 3).alias("difficulty"), F.lit("bench").alias("source"), F.when(F.col("vec_id") % 30 == 0, F.array(F.lit("a"), F.lit("b"))).when(F.col("vec_id") % 30 == 10, F.array(F.lit("a"))).otherwise(F.array().cast("array<string>")).alias("confuser_tags"), F.concat(F.lit("suite"), F.col("label") % 3).alias("benchmark"),
    )
    return evaluation.judge(rows.join(lists, "query_id", "left"))


PER_QUERY = ("exact_match_at_1", "recall_at_1", "recall_at_3", "recall_at_5", "recall_at_10", "set_recall_at_5", "set_recall_at_10", "set_recall_all_at_5", "set_recall_all_at_10", "coverage_at_5", "coverage_at_10", "mrr_at_10", "ndcg_at_10", "same_owner_wrong_field_at_1", "ambiguity_rate")


def query_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair = evaluation.pair_recall(F.col("ranked"), F.col("positive_coordinate"), F.coalesce(F.get("relevant", F.lit(1)), F.lit("")), 10)
    return ranked_rows(spark, sf_dir).select("query_id", *(F.round(c, 6).alias(c) for c in PER_QUERY), pair.alias("pair_recall_at_10"))


def suite_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.run_suites(ranked_rows(spark, sf_dir), names=("suite0", "suite1", "suite2", "empty"))


def slice_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.slices(ranked_rows(spark, sf_dir))


def epoch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suites under three encoders, as the epochs of one."""
    every = None
    for epoch, dims in ((1, 16), (2, 32), (3, 64)):
        one = ranked_rows(spark, sf_dir, dims).withColumn("epoch", F.lit(epoch))
        every = one if every is None else every.unionByName(one)
    return evaluation.run_epochs(every)


def document_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    tags = lambda c: F.when(c, F.array(F.lit("x"))).otherwise(F.array().cast("array<string>"))
    return docs.join(labels, "doc_id", "left").select("doc_id", F.when(F.col("toxic") == 1, "test").when(F.col("quality") == 0, "val").otherwise("train").alias("split"), F.concat_ws("-", F.when(F.col("quality").isNull(), "local-fallback"), F.col("source")).alias("source"), F.col("lang").alias("intent"), tags(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("adversarial_tags"), tags(F.coalesce(F.col("quality") == 0, F.lit(False))).alias("confuser_tags"), F.array_repeat(F.lit("r"), F.coalesce("quality", F.lit(2))).alias("relevant_coordinates"))


def column_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dataset.counts_by(document_rows(spark, sf_dir), ("split", "source", "intent"))


def row_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dataset.ratios(document_rows(spark, sf_dir)).select(*(F.round(c, 6).alias(c) for c in ("avg_relevant_coordinates", "adversarial_ratio", "confuser_ratio", "fallback_share")))


def name_siblings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mining.name_siblings(fields(spark, sf_dir))


def mined_pools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pools of the mining that follow from one row a coordinate: structural, lexical and semantic."""
    return mining.mined_pools(fields(spark, sf_dir)).filter("tag in ('structural', 'lexical', 'semantic')")


def field_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, stem, root path, hint, aliases and a wrapped description of every field."""
    f, o, r = F.col("field_name"), F.col("owner_type"), F.col("return_type")
    words = lambda c: F.array_join(c, ",")
    return fields(spark, sf_dir).select("doc_id", words(T.camel_tokens(f)).alias("words"), T.name_stem(f).alias("stem"), words(T.path_to_root(o, f)).alias("path"), T.owner_of(F.col("coordinate")).alias("owner"), T.field_of(F.col("coordinate")).alias("field"), seeds.hint(F.concat(f, F.lit("Id")), r).alias("hint"), words(filters.safe_aliases(F.col("aliases"), o, f)).alias("safe"), filters.is_friendly(f, ("gear", "blue")).alias("friendly"), T.wrap(F.concat(f, F.lit(" of "), o, F.lit(" returning "), r), 24).alias("wrapped"), T.half_even(F.col("doc_id") / 8, 2).alias("rounded"), T.domain_of(f, ("blue", "bolt", "gear")).alias("domain"))


def types_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fields(spark, sf_dir).groupBy(F.col("owner_type").alias("type_id")).agg(F.count(F.lit(1)).alias("field_count")).withColumn("type_name", F.concat("type_id", F.lit("Type")))


def bootstrap_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seeds.bootstrap(types_of(spark, sf_dir)).select("type_id", "family_id", "intent", "query", "source", "quality_score")


def adversarial_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fields(spark, sf_dir).select(F.format_string("q%06d", F.col("doc_id")).alias("query_id"), F.lit("test").alias("split"), F.col("owner_type").alias("type_id"), F.concat_ws("-", "owner_type", "return_type").alias("family_id"))
    return seeds.adversarial_ambiguity(rows, types_of(spark, sf_dir))


def realism_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fields(spark, sf_dir).select(F.format_string("q%06d", F.col("doc_id")).alias("query_id"), F.when(F.col("return_type").startswith("E"), "val").otherwise("train").alias("split"), F.lit("bootstrap").alias("source"), (F.col("doc_id") % 11 / 10.0).alias("quality_score"))
    return seeds.realism_seed(rows).select("query_id", "source", "quality_score")


def curated_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seeds.curated_queries(fields(spark, sf_dir))


def family_leakage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as queries of their source, held against the benchmark's long words as names of types; sources over a third go."""
    docs = read(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("family_id"), F.coalesce("text", F.lit("")).alias("query"), F.lit(0.6).alias("quality_score"))
    names = read(spark, sf_dir, "benchmark").select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0))).alias("name")).filter(F.length("name") >= 11)
    return filters.family_leakage(filters.good_synthetic(docs), names, 0.3).select("doc_id", "family_id")


def world_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return worlds.world_splits(read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("world_index")))


def stratified_worlds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of mining stratified within each label's world."""
    from fieldloom.plans.catalog import standings

    vec = read(spark, sf_dir, "embeddings").filter("vec_id % 10 = 0")
    items = vec.select(F.col("vec_id").alias("item"), (F.col("label") % 2).cast("string").alias("world_id"), F.lit(0).alias("comp_set"))
    return mining.stratify_groups(items, standings(spark, sf_dir), {"hard": 0.55, "medium": 0.3, "easy": 0.15}).select("item", "world_id", "bucket", "base_wrong")


def triplets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of a pair for each field: its own view, and that of the field its owner's ring gives."""
    f = fields(spark, sf_dir)
    docs = f.groupBy("coordinate").agg(F.min("doc_id").alias("d")).select("coordinate", F.array(F.concat(F.lit("view of "), "coordinate")).alias("views"), F.concat(F.lit("text of "), "coordinate").alias("text"))
    picked = mining.confusers(f, tags=(("same_owner", "owner_type"),)).filter("tag = 'same_owner'").select("world_id", "coordinate", "negative")
    rows = f.join(picked, ["world_id", "coordinate"], "left").select(F.col("doc_id").alias("query_id"), F.concat(F.lit("where is "), "field_name").alias("query"), F.col("coordinate").alias("positive_coordinate"), F.lit(None).cast("array<string>").alias("relevant_coordinates"), F.when(F.col("negative").isNotNull(), F.array("negative")).alias("negative_coordinates"))
    return planning.pair_texts(rows.filter("negative_coordinates is not null"), docs)


QUERIES = {f.__name__: f for f in (query_metrics, suite_metrics, slice_metrics, epoch_metrics, column_counts, row_ratios, name_siblings, mined_pools, field_texts, bootstrap_queries, adversarial_texts, realism_seed, curated_suite, family_leakage, world_splits, stratified_worlds, triplets)}

P = """f AS (SELECT p_partkey AS doc_id, 'w' || p_size % 10 AS world_id, replace(p_brand, '#', '') AS owner_type, p_name[:instr(p_name, ' ') - 1] || upper(substr(p_name, instr(p_name, ' ') + 1, 1)) || substr(p_name, instr(p_name, ' ') + 2) AS field_name, p_type AS return_type, string_split(p_name, ' ') AS w FROM part),
c AS (SELECT *, owner_type || '.' || field_name AS coordinate, [w[1], w[1] || 'Gear', w[2]] AS aliases FROM f)"""


def _judged(dims: int, name: str) -> str:
    """CTEs of a table of per-query metrics with the name."""
    return f"""{name}_s AS (SELECT a.vec_id AS query_id, 'L' || b.label || '.v' || b.vec_id AS item, row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_dot_product(a.embedding[1:{dims}]::double[], b.embedding[1:{dims}]::double[]), 6) DESC, b.vec_id) AS rank FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE a.vec_id % 10 = 0),
{name}_l AS (SELECT query_id, list(item ORDER BY rank) AS ranked FROM {name}_s WHERE rank <= 10 GROUP BY query_id),
{name}_m AS (SELECT label, min(vec_id) AS m1 FROM embeddings GROUP BY label), {name}_n AS (SELECT e.label, m1, min(CASE WHEN vec_id > m1 THEN vec_id END) AS m2 FROM embeddings e JOIN {name}_m m ON e.label = m.label GROUP BY 1, 2),
{name}_q AS (SELECT vec_id AS query_id, 'L' || e.label AS owner_type, e.label, coalesce('L' || e.label || '.v' || CASE WHEN vec_id = m1 THEN m2 ELSE m1 END, '') AS pos, CASE WHEN vec_id % 20 = 0 THEN [coalesce('L' || e.label || '.v' || m2, ''), ''] ELSE [] END AS more FROM embeddings e JOIN {name}_n n ON e.label = n.label WHERE vec_id % 10 = 0),
{name}_r AS (SELECT q.*, ranked, CASE WHEN pos <> '' THEN list_concat([pos], list_filter(list_distinct(more), lambda x: x <> '' AND x <> pos)) ELSE list_filter(list_distinct(more), lambda x: x <> '') END AS rel, list_position(ranked, pos) AS at_ FROM {name}_q q LEFT JOIN {name}_l l USING (query_id)),
{name} AS (SELECT *, CASE WHEN list_contains(rel, ranked[1]) THEN 1.0::double ELSE 0 END AS exact_match_at_1, {", ".join(f"CASE WHEN at_ <= {k} THEN 1.0::double ELSE 0 END AS recall_at_{k}" for k in (1, 3, 5, 10))},
{", ".join(f"CASE WHEN list_has_any(ranked[1:{k}], rel) THEN 1.0::double ELSE 0 END AS set_recall_at_{k}, CASE WHEN len(rel) > 0 AND list_has_all(ranked[1:{k}], rel) THEN 1.0::double ELSE 0 END AS set_recall_all_at_{k}, CASE WHEN len(rel) > 0 THEN len(list_filter(rel, lambda x: list_contains(ranked[1:{k}], x)))::double / len(rel) ELSE 0 END AS coverage_at_{k}" for k in (5, 10))},
CASE WHEN at_ <= 10 THEN 1.0::double / at_ ELSE 0 END AS mrr_at_10, CASE WHEN at_ <= 10 THEN 1.0::double / log2(at_ + 1.0::double) ELSE 0 END AS ndcg_at_10, CASE WHEN NOT list_contains(rel, ranked[1]) AND string_split(ranked[1], '.')[1] = owner_type THEN 1.0::double ELSE 0 END AS same_owner_wrong_field_at_1, CASE WHEN len(rel) > 1 THEN 1.0::double ELSE 0 END AS ambiguity_rate,
'suite' || label % 3 AS benchmark FROM {name}_r)"""


def _avg(names: tuple[str, ...]) -> str:
    return ", ".join(f"round(coalesce(avg({m}), 0), 6) AS {m}" for m in names)


_MEANS = ("exact_match_at_1", "recall_at_1", "recall_at_3", "recall_at_5", "recall_at_10", "set_recall_at_5", "set_recall_at_10", "coverage_at_5", "coverage_at_10", "mrr_at_10", "ndcg_at_10", "same_owner_wrong_field_at_1", "ambiguity_rate")
_DOCS = "r AS (SELECT d.doc_id, CASE WHEN toxic = 1 THEN 'test' WHEN quality = 0 THEN 'val' ELSE 'train' END AS split, CASE WHEN quality IS NULL THEN concat_ws('-', 'local-fallback', source) ELSE source END AS source, lang AS intent, toxic = 1 AS adv, quality = 0 AS conf, coalesce(quality, 2) AS n FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"
_STEM = "CASE WHEN length(regexp_extract(field_name, '^[^A-Z]+')) >= 4 THEN regexp_extract(field_name, '^[^A-Z]+') ELSE coalesce(lower(list_filter(regexp_extract_all(field_name, '[A-Z][^A-Z]*'), lambda x: length(x) >= 4)[1]), lower(list_reverse_sort(list_transform(regexp_extract_all(field_name, '^[^A-Z]+|[A-Z][^A-Z]*'), lambda x: {'n': length(x), 'x': x}))[1]['x'])) END"


def _ring(source: str, group: str, item: str, seed: str) -> str:
    return f"SELECT {group}, {item}, row_number() OVER (PARTITION BY {group} ORDER BY md5('{seed}|' || {item}), {item}) - 1 AS place, count(*) OVER (PARTITION BY {group}) AS n FROM (SELECT DISTINCT {group}, {item} FROM {source})"


def _drawn(tag: str, key: str) -> str:
    ring = _ring("c", f"world_id, {key}", "coordinate", "7")
    return f"SELECT a.world_id, a.coordinate, '{tag}' AS tag, b.coordinate AS negative FROM ({ring}) a JOIN ({ring}) b ON a.world_id = b.world_id AND a.{key} = b.{key} AND b.place = (a.place + 1 + ('0x' || substr(md5('7d|' || a.coordinate), 1, 8))::bigint % greatest(a.n - 1, 1)) % a.n WHERE a.n > 1"


# fixed values, for the SQL alone: the templates of bootstrap queries
_TEMPLATES = [
    ("lookup", "what is {type}"), ("lookup", "show me details of {type}"), ("lookup", "explain graphql type for {type}"), ("capability", "what can i query about {topic}"), ("capability", "which graphql type handles {topic}"), ("capability", "where do i fetch {topic}"), ("filtering", "how can i filter {topic}"), ("filtering", "which type supports filtering {topic}"),
    ("aggregation", "how do i aggregate {topic}"), ("aggregation", "which type gives summary for {topic}"), ("troubleshooting", "query for {topic} returns null, which type should i use"), ("troubleshooting", "i cannot find {topic} in schema, where is it"), ("comparative", "difference between {type} and {other}"), ("comparative", "when should i use {type} instead of {other}"),
]
_LISTED = "[" + ", ".join(f"{{'i': {i}, 'intent': '{a}', 't': '{t}'}}" for i, (a, t) in enumerate(_TEMPLATES)) + "]"

ORACLES = {
    "query_metrics": f"WITH {_judged(64, 'j')} SELECT query_id, {', '.join(f'round({c}, 6) AS {c}' for c in PER_QUERY)}, CASE WHEN pos <> '' AND len(rel) > 1 AND list_has_all(ranked, rel[1:2]) THEN 1.0::double ELSE 0 END AS pair_recall_at_10 FROM j",
    "suite_metrics": f"WITH {_judged(64, 'j')} SELECT b AS benchmark, count(j.query_id) AS n, {_avg(_MEANS)} FROM (SELECT unnest(['suite0', 'suite1', 'suite2', 'empty']) AS b) s LEFT JOIN j ON s.b = j.benchmark GROUP BY b",
    "slice_metrics": f"""WITH {_judged(64, 'j')}, t AS (SELECT *, unnest(list_concat(['intent:' || CASE WHEN query_id % 40 = 0 THEN 'unknown' ELSE 'i' || query_id % 4 END, 'difficulty:d' || query_id % 3, 'source:bench', 'ambiguity:' || CASE WHEN len(rel) > 1 THEN 'multi' ELSE 'single' END || '_relevant'],
CASE WHEN query_id % 30 = 0 THEN ['confuser:a', 'confuser:b'] WHEN query_id % 30 = 10 THEN ['confuser:a'] ELSE [] END)) AS slice FROM j) SELECT slice, count(*) AS n, {_avg(("exact_match_at_1", "recall_at_5", "mrr_at_10", "ndcg_at_10", "set_recall_at_5", "coverage_at_5"))} FROM t GROUP BY slice""",
    "epoch_metrics": f"WITH {_judged(16, 'a')}, {_judged(32, 'b')}, {_judged(64, 'j')} " + " UNION ALL ".join(f"SELECT {e} AS epoch, benchmark, {_avg(('recall_at_1', 'recall_at_5', 'recall_at_10', 'mrr_at_10', 'ndcg_at_10', 'exact_match_at_1', 'recall_at_3', 'same_owner_wrong_field_at_1'))} FROM {t} GROUP BY benchmark" for e, t in ((1, "a"), (2, "b"), (3, "j"))),
    "column_counts": f"WITH {_DOCS}, p AS (SELECT unnest(['split', 'source', 'intent']) AS \"column\", unnest([split, source, intent]) AS v FROM r) SELECT \"column\", coalesce(nullif(v, ''), 'unknown') AS value, count(*) AS n FROM p GROUP BY 1, 2",
    "row_ratios": f"WITH {_DOCS} SELECT round(avg(n), 6) AS avg_relevant_coordinates, round(avg(coalesce(adv, false)::int), 6) AS adversarial_ratio, round(avg(coalesce(conf, false)::int), 6) AS confuser_ratio, round(round_even(avg(contains(coalesce(source, ''), 'fallback')::int), 4), 6) AS fallback_share FROM r",
    "name_siblings": f"WITH {P}, s AS (SELECT DISTINCT world_id, field_name, {_STEM} AS stem FROM c) SELECT a.world_id, a.field_name, b.field_name AS other FROM s a JOIN s b ON a.world_id = b.world_id WHERE length(a.stem) >= 4 AND (a.stem = b.stem OR contains(lower(b.field_name), a.stem) OR contains(lower(a.field_name), b.stem))",
    "mined_pools": f"""WITH {P}, x AS ({_drawn("structural", "owner_type")} UNION ALL {_drawn("lexical", "field_name")}), al AS (SELECT DISTINCT a.world_id, a.coordinate, b.coordinate AS negative FROM (SELECT world_id, coordinate, unnest(aliases) AS f FROM c) a JOIN c b ON a.world_id = b.world_id AND a.f = b.field_name WHERE a.coordinate <> b.coordinate),
y AS (SELECT * FROM x UNION ALL SELECT world_id, coordinate, 'semantic', arg_min(negative, md5('7|' || coordinate || '|' || negative) || negative) FROM al GROUP BY 1, 2)
SELECT world_id, coordinate, CASE tag WHEN 'structural' THEN 2 WHEN 'lexical' THEN 3 ELSE 5 END AS place, tag, negative FROM y""",
    "field_texts": f"""WITH {P} SELECT doc_id, w[1] || ',' || w[2] AS words, {_STEM} AS stem, coordinate || ',Query.' || lower(owner_type[1]) || owner_type[2:] AS path, owner_type AS owner, field_name AS field, 'unique reference' AS hint, array_to_string(list_filter(aliases, lambda x: NOT contains(lower(owner_type), lower(x)) AND NOT contains(lower(field_name), lower(x)) AND NOT contains(lower(x), lower(owner_type)) AND NOT contains(lower(x), lower(field_name))), ',') AS safe,
w[1] = 'blue' OR w[2] = 'gear' AS friendly, CASE WHEN length(field_name || ' of ' || owner_type) <= 24 THEN field_name || ' of ' || owner_type || chr(10) || 'returning ' || return_type ELSE field_name || ' of' || chr(10) || owner_type || ' returning' || chr(10) || return_type END AS wrapped, round_even(doc_id / 8.0::double, 2) AS rounded, CASE WHEN contains(lower(field_name), 'blue') THEN 'blue' WHEN contains(lower(field_name), 'bolt') THEN 'bolt' WHEN contains(lower(field_name), 'gear') THEN 'gear' ELSE 'real' END AS domain FROM c""",
    "bootstrap_queries": f"""WITH {P}, o AS (SELECT DISTINCT 0 AS g, owner_type FROM c), r AS ({_ring("o", "g", "owner_type", "7")}), n AS (SELECT a.owner_type AS type_id, b.owner_type || 'Type' AS other FROM r a JOIN r b ON b.place = (a.place + 1 + ('0x' || substr(md5('7d|' || a.owner_type), 1, 8))::bigint % greatest(a.n - 1, 1)) % a.n),
t AS (SELECT type_id, other, unnest({_LISTED}) AS x FROM n) SELECT type_id, type_id || '-' || x.intent || '-' || x.i AS family_id, x.intent AS intent, replace(replace(replace(x.t, '{{type}}', type_id || 'Type'), '{{topic}}', lower(type_id || 'Type')), '{{other}}', other) AS query, 'bootstrap' AS source, 0.8::double AS quality_score FROM t""",
    "adversarial_texts": f"""WITH {P}, o AS (SELECT owner_type, row_number() OVER (ORDER BY owner_type) - 1 AS place, count(*) OVER () AS n FROM (SELECT DISTINCT owner_type FROM c)), q AS (SELECT *, printf('q%06d', doc_id) AS query_id, row_number() OVER (ORDER BY printf('q%06d', doc_id)) - 1 AS i FROM c)
SELECT 'adv-' || query_id AS query_id, 'i need ' || lower(q.owner_type) || 'type info, not ' || lower(o.owner_type) || 'type, which graphql type is correct' AS query, q.owner_type AS type_id, 'test' AS split, 'adversarial-ambiguity' AS source, 'adv-' || q.owner_type || '-' || return_type AS family_id, 0.8::double AS quality_score FROM q JOIN o ON o.place = (q.i + 1) % o.n""",
    "realism_seed": "SELECT printf('q%06d', p_partkey) AS query_id, 'manual-realism-seed' AS source, greatest(p_partkey % 11 / 10.0::double, 0.9::double) AS quality_score FROM part WHERE starts_with(p_type, 'E') ORDER BY 1 LIMIT 50",
    "curated_suite": f"WITH {P}, o AS (SELECT * FROM c ORDER BY doc_id LIMIT 100), q AS (SELECT coordinate, 'Which field gives me the ' || lower(replace(replace(field_name, 'Id', ' identifier'), 'Cents', ' amount')) || '?' AS query, min(doc_id) AS d FROM o GROUP BY 1, 2) SELECT coordinate, query, 'lookup' AS intent, 'obvious' AS slice, 'medium' AS difficulty FROM q ORDER BY d LIMIT 200",
    "family_leakage": r"""WITH n AS (SELECT DISTINCT lower(t) AS n FROM (SELECT unnest(regexp_extract_all(text, '[A-Za-z]+')) AS t FROM benchmark) WHERE length(t) >= 11), d AS (SELECT doc_id, source AS family_id, lower(coalesce(text, '')) AS q FROM documents WHERE len(list_filter(regexp_split_to_array(trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g')), ' '), lambda x: x <> '')) >= 3),
h AS (SELECT *, EXISTS (SELECT 1 FROM n WHERE contains(q, n.n)) AS hit FROM d) SELECT doc_id, family_id FROM (SELECT *, avg(hit::int) OVER (PARTITION BY family_id) AS share FROM h) WHERE share <= 0.3""",
    "world_splits": "WITH w AS (SELECT DISTINCT s_suppkey AS world_index, (SELECT count(DISTINCT s_suppkey) FROM supplier) AS n FROM supplier) SELECT world_index, CASE WHEN world_index < trunc(n * 0.8::double) THEN 'train' WHEN world_index < trunc(n * 0.8::double) + trunc(n * 0.1::double) THEN 'val' ELSE 'test' END AS split FROM w",
    "triplets": f"""WITH {P}, x AS ({_drawn("s", "owner_type")}) SELECT doc_id AS query_id, 'where is ' || field_name AS anchor, 'view of ' || c.coordinate AS positive, 'text of ' || negative AS negative FROM c JOIN x ON c.world_id = x.world_id AND c.coordinate = x.coordinate""",
}
