"""Registered queries of the retrieval operators over the test tables, each with SQL of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.functions import text as T
from fieldloom.operators import compare, filters, generation, mining, planning, retrieval, tables
from fieldloom.plans import studies, views


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def coords(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("doc_id"), F.col("p_brand").alias("owner_type"), F.col("p_name").alias("field_name"), F.col("p_type").alias("return_type"), (F.col("p_size") % 10).alias("world_id"))
    return own.withColumn("coordinate", views.coordinate(F.col("owner_type"), F.col("field_name")))


def query_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All words of each document, a space apart, as a query of its source."""
    docs = read(spark, sf_dir, "documents").select("doc_id", F.array_join(F.filter(F.split("text", r"[ \t\n\r\f\x0B]+"), lambda x: x != ""), " ").alias("query"), F.col("source").alias("world"), F.col("lang").alias("intent"))
    labels = read(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("quality"))
    return docs.join(labels, "doc_id", "left").withColumn("quality", F.coalesce("quality", F.lit(0.5)))


def retrieval_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec = read(spark, sf_dir, "embeddings")
    ranked = retrieval.top_k(vec.filter("vec_id % 10 = 0"), vec, 10)
    labels = vec.select("vec_id", "label")
    firsts = labels.groupBy("label").agg(F.min("vec_id").alias("m1"), F.count(F.lit(1)).alias("n"))
    second = labels.join(firsts, "label").filter("vec_id > m1").groupBy("label").agg(F.min("vec_id").alias("m2"))
    truth = labels.filter("vec_id % 10 = 0").join(firsts, "label").join(second, "label", "left").select(F.col("vec_id").alias("query_id"), "label", F.when(F.col("vec_id") == F.col("m1"), F.col("m2")).otherwise(F.col("m1")).alias("positive"), (F.col("n") - 1).alias("n_relevant"))
    a, b = labels.select(F.col("vec_id").alias("query_id"), F.col("label").alias("ql")), labels.select(F.col("vec_id").alias("doc_id"), F.col("label").alias("dl"))
    judged = ranked.join(a, "query_id").join(b, "doc_id").select("query_id", "doc_id", "rank", (F.col("ql") == F.col("dl")).alias("relevant"))
    return retrieval.summarise(retrieval.per_query(judged, truth)).withColumn("label", F.coalesce("label", F.lit(-1)))


def top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec = read(spark, sf_dir, "embeddings")
    return retrieval.top_k(vec.filter("vec_id % 10 = 0"), vec, 5).select("query_id", "doc_id", "sim", F.col("rank").cast("long").alias("rank"))


def text_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = query_rows(spark, sf_dir)
    stems = F.transform(T.alnum_tokens(F.col("query")), T.light_stem)
    return q.select("doc_id", T.normalise(F.col("query")).alias("norm"), F.size(T.words(F.col("query"))).cast("long").alias("n_words"), F.array_join(stems, " ").alias("stems"))


def coordinate_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, f, r = F.col("owner_type"), F.col("field_name"), F.col("return_type")
    return coords(spark, sf_dir).select("doc_id", "coordinate", views.signature(o, f, r).alias("signature"), views.sdl(o, f, r).alias("sdl"), views.semantic(o, f, r, F.lit(None).cast("string"), F.lit(" ")).alias("semantic"), views.keywords(F.col("coordinate"), o, f, r).alias("keywords"))


def terms_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(world, term): the long words of the benchmark's items, dealt round the worlds of the documents; three shares have no world there."""
    worlds = read(spark, sf_dir, "documents").select(F.col("source").alias("world")).distinct().filter("world is not null")
    numbered = worlds.withColumn("place", F.row_number().over(mining.Window.partitionBy(F.lit(0)).orderBy("world")) - 1)
    words = read(spark, sf_dir, "benchmark").select("item_id", F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0))).alias("term")).filter(F.length("term") >= 9)
    deal = words.select((F.col("item_id") % (numbered.count() + 3)).alias("place"), "term").join(numbered, "place", "left")
    return deal.select(F.coalesce("world", F.lit("elsewhere")).alias("world"), "term").distinct()


def clear_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = filters.min_quality(query_rows(spark, sf_dir))
    return q.filter(filters.is_clear(F.col("query"), F.col("world"))).select("doc_id", "quality")


def world_leakage(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = query_rows(spark, sf_dir)
    flagged = filters.leak_flags(q.select("world", "query"), terms_of(spark, sf_dir))
    return flagged.groupBy("world").agg(F.count(F.lit(1)).alias("n"), F.sum("leaked").alias("n_leaked")).filter(F.col("n_leaked") / F.col("n") <= 0.5)


def strict_leakage(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = coords(spark, sf_dir)
    q = c.withColumn("query", F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("show the "), F.col("field_name"), F.lit("s for me"))).otherwise(F.concat(F.lit("what about "), F.lower("return_type"))))
    return q.filter(~filters.leaks_schema(F.col("query"), F.col("owner_type"), F.regexp_replace("field_name", " ", "_"))).select("doc_id", "query")


def ambiguous_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.ambiguous_names(coords(spark, sf_dir))


def sibling_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct siblings of each coordinate by owner, by name and by return type, from group counts: no self-join of groups."""
    c = coords(spark, sf_dir).select("world_id", "owner_type", "field_name", "return_type").distinct()
    by_owner = c.groupBy("world_id", "owner_type").agg(F.count_distinct("field_name").alias("a"))
    by_name = c.groupBy("world_id", "field_name").agg(F.count_distinct("owner_type").alias("b"))
    by_type = c.groupBy("world_id", "return_type").agg(F.count_distinct("owner_type", "field_name").alias("d"))
    return c.join(by_owner, ["world_id", "owner_type"]).join(by_name, ["world_id", "field_name"]).join(by_type, ["world_id", "return_type"]).select("world_id", "owner_type", "field_name", "return_type", (F.col("a") - 1).alias("same_owner"), (F.col("b") - 1).alias("same_name"), (F.col("d") - 1).alias("same_type"))


def mined_confusers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mining.confusers(coords(spark, sf_dir))


def tiered_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec = read(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.col("label").alias("owner"), F.pmod("vec_id", F.lit(4)).alias("field"))
    return mining.tiered_search(vec.filter("vec_id % 10 = 0"), vec, 3)


def standings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth vector as an item whose target is the least other id of its remainder by 3, by the two least ids of each."""
    vec = read(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.pmod("vec_id", F.lit(3)).alias("of"))
    ids = vec.select("vec_id", "of")
    firsts = ids.groupBy("of").agg(F.min("vec_id").alias("m1"))
    seconds = ids.join(firsts, "of").filter("vec_id > m1").groupBy("of").agg(F.min("vec_id").alias("m2"))
    asked = vec.filter("vec_id % 10 = 0").join(firsts, "of").join(seconds, "of", "left").select("vec_id", "embedding", F.when(F.col("vec_id") == F.col("m1"), F.col("m2")).otherwise(F.col("m1")).alias("target"))
    return mining.searched_standings(asked.join(vec.select(F.col("vec_id").alias("target"), F.col("embedding").alias("target_embedding")), "target", "left"), vec)


def margin_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mining.verdicts(standings(spark, sf_dir)).select("item", "bucket", "top1_correct", F.col("target_rank").cast("long").alias("target_rank"), "margin")


def stratified_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mining.stratify(mining.verdicts(standings(spark, sf_dir)), {"hard": 0.55, "medium": 0.3, "easy": 0.15}).select("item", "bucket")


def best_by_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.best_by_text(query_rows(spark, sf_dir), "query", "quality", "doc_id")


def family_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.family_split(query_rows(spark, sf_dir), "world")


def sanity_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.sample(query_rows(spark, sf_dir).select("doc_id", "world"), "doc_id")


def quality_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.slices(query_rows(spark, sf_dir), {"intent": "intent", "source": "world"}, ["quality"])


def content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.content_hash(coords(spark, sf_dir), "world_id", "doc_id", "coordinate")


def stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts after the filters of quality and clarity and, of what they leave, one row a text."""
    q = query_rows(spark, sf_dir)
    good, clear = F.col("quality") >= 0.25, filters.is_clear(F.col("query"), F.col("world"))
    best = tables.best_by_text(q.filter(good & clear), "query", "quality", "doc_id").select("doc_id", F.lit(True).alias("first"))
    return tables.stage_counts(q.join(best, "doc_id", "left"), "intent", [("quality_ok", good), ("clear", clear), ("deduped", F.coalesce("first", F.lit(False)))])


def best_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = read(spark, sf_dir, "events").groupBy(F.col("event_type").alias("suite"), F.hour("ts").cast("long").alias("epoch")).agg(F.round(F.avg("value"), 4).alias("score"))
    return tables.best_epoch(runs, "suite", "epoch", "score")


def curated_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items with their state: kept where a document holds the whole of their normalised text as a word of its own, or rejected."""
    texts = query_rows(spark, sf_dir).select(F.explode(F.array_distinct(F.split(F.lower("query"), " "))).alias("w")).distinct()
    items = read(spark, sf_dir, "benchmark").select("item_id", F.explode(F.array_distinct(T.words(F.col("text")))).alias("w"))
    known = items.join(texts, "w", "left_semi").groupBy("item_id").agg(F.count(F.lit(1)).alias("n_known"))
    every = items.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_words"))
    return every.join(known, "item_id", "left").select("item_id", "n_words", F.coalesce("n_known", F.lit(0)).alias("n_known"), F.when(F.col("n_known") == F.col("n_words"), "kept").otherwise("rejected").alias("state"))


def bucket_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token-bucket counts of each query, as sparse vectors: entries and squared norm."""
    t = query_rows(spark, sf_dir).select("doc_id", F.explode(T.words(F.col("query"))).alias("t")).groupBy("doc_id", T.bucket(F.col("t")).alias("b")).agg(F.count(F.lit(1)).alias("c"))
    return t.groupBy("doc_id").agg(F.count(F.lit(1)).alias("entries"), F.sum(F.col("c") * F.col("c")).alias("norm2"), F.sum(F.col("b") * F.col("c")).alias("checksum"))


def competition_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = F.when(F.col("owner_type").like("%#1%"), F.lit("described")).otherwise(F.lit(" "))
    return planning.competition_sets(coords(spark, sf_dir).withColumn("owner_description", told))


def batch_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planning.batch_plan(coords(spark, sf_dir).withColumn("requested", 1 + F.col("doc_id") % 4), 40)


def training_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = coords(spark, sf_dir)
    place = F.when(F.col("tag") == "same_owner", 1).when(F.col("tag") == "same_field_name", 2).when(F.col("tag") == "same_return_type", 3).otherwise(4)
    firsts = c.groupBy("world_id", F.col("coordinate").alias("negative")).agg(F.min("doc_id").alias("negative_id"))
    ranked = c.select("doc_id", "world_id", "coordinate").join(mining.confusers(c), ["world_id", "coordinate"]).join(firsts, ["world_id", "negative"]).select("doc_id", place.alias("place"), F.col("negative_id").alias("negative"))
    return planning.training_pairs(c, ranked)


def two_encoders(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec = read(spark, sf_dir, "embeddings")
    firsts = vec.groupBy("label").agg(F.min("vec_id").alias("target_id"))
    targets = firsts.join(vec.select(F.col("vec_id").alias("target_id"), F.col("embedding").alias("target")), "target_id")
    asked = vec.filter("vec_id % 10 = 0").join(targets, "label").filter("vec_id <> target_id")
    return compare.rank_delta(asked, vec, {"base": (0, 32), "tuned": (0, 64)})


def rank_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return two_encoders(spark, sf_dir)


def base_and_tuned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.base_and_tuned(two_encoders(spark, sf_dir))


FIELD_NAMES, FIELD_TYPES = ("author", "status", "createdAt", "email", "tags", "priceCents", "lastError", "approvedBy", "weight"), ("String!", "[Item!]!", "DateTime", "User", "Int!", "ID", "Date!")


def field_intents(spark: SparkSession, sf_dir: str) -> DataFrame:
    pick = lambda own: F.element_at(F.array(*map(F.lit, own)), (F.col("doc_id") % len(own) + 1).cast("int"))
    return coords(spark, sf_dir).select("doc_id", F.array_join(generation.intents(pick(FIELD_NAMES), pick(FIELD_TYPES)), ",").alias("intents"))


def query_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = query_rows(spark, sf_dir).select("doc_id", F.concat(F.lit("Show the type of "), "query", F.lit(" number?")).alias("query"))
    return generation.expand(q).select("doc_id", F.col("place").cast("long").alias("place"), "variant", "origin", "quality_score")


TEMPLATES = {"lookup": ["what is {type}", "show {type} of {owner}"], "comparative": ["difference between {type} and {owner}"]}


def template_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generation.from_templates(coords(spark, sf_dir).select("doc_id", "owner_type", "return_type"), TEMPLATES, {"type": "return_type", "owner": "owner_type"}).select("doc_id", "intent", "query")


def valid_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = query_rows(spark, sf_dir).select("doc_id", "world", "query", F.element_at(F.array(*map(F.lit, ("easy", "medium", "hard", "odd"))), (F.col("doc_id") % 4 + 1).cast("int")).alias("difficulty"), F.element_at(F.array(*map(F.lit, ("lookup", "status", "other"))), (F.col("doc_id") % 3 + 1).cast("int")).alias("intent"))
    id_ = lambda n: F.concat(F.lit("c"), ((F.col("doc_id") * n) % 100).cast("string"))
    items = q.select("*", id_(1).alias("positive"), F.array(id_(3), id_(5)).alias("relevant"), F.array(id_(1), id_(7), id_(9)).alias("negative"))
    known = q.join(read(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi").select("world", F.concat(F.lit("c"), (F.col("doc_id") % 100).cast("string")).alias("coordinate")).distinct()
    terms = terms_of(spark, sf_dir)
    got = generation.valid_items(items, terms, known)
    return got.select("doc_id", "difficulty", "intent", F.array_join("relevant", ",").alias("relevant"), F.array_join("negative", ",").alias("negative"))


QUERIES = {f.__name__: f for f in (retrieval_metrics, top_k_search, text_functions, coordinate_views, clear_queries, world_leakage, strict_leakage, ambiguous_names, sibling_counts, mined_confusers, tiered_negatives, margin_buckets, stratified_items, best_by_text, family_split, sanity_sample, quality_slices, content_hash, stage_counts, best_epoch, curated_merge, bucket_vectors, competition_sets, batch_plan, training_pairs, rank_delta, base_and_tuned, field_intents, query_variants, template_queries, valid_items)}

Q = r"""q AS (SELECT d.doc_id, array_to_string(list_filter(regexp_split_to_array(text, '[ \t\n\r\f\x0B]+'), lambda x: x <> ''), ' ') AS query, source AS world, lang AS intent, coalesce(quality::double, 0.5) AS quality
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""
C = "c AS (SELECT p_partkey AS doc_id, p_brand AS owner_type, p_name AS field_name, p_type AS return_type, p_size % 10 AS world_id, p_brand || '.' || p_name AS coordinate FROM part)"
SIM = """sims AS (SELECT a.vec_id AS query_id, b.vec_id AS doc_id, round(list_dot_product(a.embedding::double[], b.embedding::double[]), 6) AS sim, a.label AS ql, b.label AS dl
FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE a.vec_id % 10 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, doc_id) AS rank FROM sims)"""
NORM = r"trim(regexp_replace(lower(query), '\s+', ' ', 'g'))"
CLEAR = f"(len(list_filter(string_split({NORM}, ' '), lambda x: x <> '')) >= 4 AND NOT contains({NORM}, 'something') AND NOT contains({NORM}, 'anything') AND NOT contains({NORM}, 'whatever') AND NOT contains({NORM}, 'some data') AND NOT contains({NORM}, 'etc') AND world IS NOT NULL)"


# fixed values, for the SQL alone: words that say nothing in world terms, and in the names of a target
WORLD_TRIVIAL = """('id','name','type','value','data','item','list','count','total','date','time','user','post','order','cart','hotel','flight','trip','product','catalog','unit','text','body','record','mode','state','status','created','updated','amount','price','active','label','title','notes','start','email','phone','image','score','error','token','slug',
'field','when','last','update','create','creation','unique','identifier','display','number','model','case','times','member','which','what','this','that','with','from','have','does','used','tell','show','give','find','look','help','need','want','know','there','here','some','only','also','more','most','many','each','been','info','read','like','make','take','come','work','year')"""
ITEM_TRIVIAL = """('id','name','type','value','data','item','list','count','total','date','time','user','post','order','cart','hotel','flight','trip','product','catalog','unit','text','body','record','mode','state','status','created','updated','amount','price','active','label','title','notes','start','email','phone','image','score','error','token','slug',
'field','when','last','update','create','creation','unique','identifier','display','number','model','case','times','member')"""
NAME_TRIVIAL = "('id','name','type','value','data','item','list','count','total','date','time')"
ENDINGS = ("ies", "ing", "ers", "ier", "ied", "ed", "es", "er", "ly", "s")


def _stem(t: str) -> str:
    return "CASE " + " ".join(f"WHEN length({t}) > {len(s) + 2} AND ends_with({t}, '{s}') THEN left({t}, length({t}) - {len(s)})" for s in ENDINGS) + f" ELSE {t} END"


TERMS = """w AS (SELECT DISTINCT source AS world FROM documents WHERE source IS NOT NULL), wn AS (SELECT world, row_number() OVER (ORDER BY world) - 1 AS place, count(*) OVER () + 3 AS n FROM w),
b AS (SELECT item_id, unnest(regexp_extract_all(text, '[A-Za-z]+')) AS term FROM benchmark), terms AS (SELECT DISTINCT coalesce(wn.world, 'elsewhere') AS world, term FROM (SELECT item_id % (SELECT count(*) + 3 FROM w) AS place, term FROM b WHERE length(term) >= 9) d LEFT JOIN wn USING (place))"""
SCORES = f"""{SIM}, hit AS (SELECT query_id AS item, doc_id, sim, doc_id % 3 = query_id % 3 AS h FROM ranked),
t AS (SELECT *, h AND doc_id = min(CASE WHEN h THEN doc_id END) OVER (PARTITION BY item) AS is_target, row_number() OVER (PARTITION BY item ORDER BY sim DESC, doc_id) AS rn FROM hit),
g AS (SELECT item, count(*) AS n, min(CASE WHEN is_target THEN rn END) AS at_, max(CASE WHEN is_target THEN sim END) AS target, max(CASE WHEN rn = 1 THEN sim END) AS s1, max(CASE WHEN rn = 2 THEN sim END) AS s2 FROM t GROUP BY item),
m AS (SELECT *, n >= 2 AND at_ IS NOT NULL AS valid, CASE WHEN at_ = 1 THEN target - s2 ELSE target - s1 END AS gap FROM g),
b AS (SELECT item, CASE WHEN NOT valid THEN 'easy' WHEN at_ > 1 THEN 'hard' WHEN round(gap, 6) < 0.05 THEN 'medium' ELSE 'easy' END AS bucket, CASE WHEN valid THEN at_ = 1 END AS top1_correct, CASE WHEN valid THEN at_ - 1 END AS target_rank, CASE WHEN valid THEN round(gap, 6) END AS margin FROM m)"""


def _ring(source: str, group: str, item: str, seed: str) -> str:
    return f"SELECT {group}, {item}, row_number() OVER (PARTITION BY {group} ORDER BY md5('{seed}|' || {item}), {item}) - 1 AS place, count(*) OVER (PARTITION BY {group}) AS n FROM (SELECT DISTINCT {group}, {item} FROM {source})"


def _draw(seed: str, item: str) -> str:
    return f"('0x' || substr(md5('{seed}|' || {item}), 1, 8))::bigint"


def _confuser(tag: str, key: str) -> str:
    ring = _ring("c", f"world_id, {key}", "coordinate", "7")
    return f"""SELECT a.world_id, a.coordinate, '{tag}' AS tag, b.coordinate AS negative FROM ({ring}) a JOIN ({ring}) b ON a.world_id = b.world_id AND a.{key} = b.{key} AND b.place = (a.place + 1 + {_draw("7d", "a.coordinate")} % greatest(a.n - 1, 1)) % a.n WHERE a.n > 1"""


ORACLES = {
    "retrieval_metrics": f"""WITH {SIM},
truth AS (SELECT a.vec_id AS query_id, a.label, min(b.vec_id) AS positive, count(b.vec_id) AS n_relevant FROM embeddings a LEFT JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE a.vec_id % 10 = 0 GROUP BY 1, 2),
h AS (SELECT t.query_id, t.label, t.n_relevant, min(CASE WHEN r.doc_id = t.positive THEN rank END) AS rank, coalesce(max(CASE WHEN rank = 1 AND ql = dl THEN 1 ELSE 0 END), 0) AS top1, coalesce(sum(CASE WHEN rank <= 5 AND ql = dl THEN 1 ELSE 0 END), 0) AS hits5, coalesce(sum(CASE WHEN ql = dl THEN 1 ELSE 0 END), 0) AS hits10
FROM truth t LEFT JOIN ranked r ON t.query_id = r.query_id AND r.rank <= 10 GROUP BY 1, 2, 3)
SELECT coalesce(label, -1)::int AS label, count(*) AS n, round(avg(CASE WHEN rank <= 1 THEN 1.0::double ELSE 0 END), 6) AS recall_at_1, round(avg(CASE WHEN rank <= 5 THEN 1.0::double ELSE 0 END), 6) AS recall_at_5, round(avg(CASE WHEN rank <= 10 THEN 1.0::double ELSE 0 END), 6) AS recall_at_10,
round(avg(CASE WHEN rank <= 10 THEN 1.0::double / rank ELSE 0 END), 6) AS mrr_at_10, round(avg(CASE WHEN rank <= 10 THEN 1.0::double / log2(rank + 1.0::double) ELSE 0 END), 6) AS ndcg_at_10, round(avg(top1), 6) AS exact_match_at_1, round(avg(CASE WHEN hits5 > 0 THEN 1 ELSE 0 END), 6) AS set_recall_any_at_5, round(avg(CASE WHEN n_relevant > 0 THEN hits10::double / n_relevant ELSE 0 END), 6) AS coverage_at_10
FROM h GROUP BY GROUPING SETS ((label), ())""",
    "top_k_search": f"WITH {SIM} SELECT query_id, doc_id, sim, rank FROM ranked WHERE rank <= 5",
    "text_functions": f"""WITH {Q} SELECT doc_id, {NORM} AS norm, len(list_filter(string_split({NORM}, ' '), lambda x: x <> '')) AS n_words, array_to_string(list_transform(regexp_extract_all(lower(query), '[a-z0-9]+'), lambda t: {_stem("t")}), ' ') AS stems FROM q""",
    "coordinate_views": f"""WITH {C} SELECT doc_id, coordinate, coordinate || ': ' || return_type AS signature, 'type ' || owner_type || ' {{' || chr(10) || '  ' || field_name || ': ' || return_type || chr(10) || '}}' AS sdl,
'GraphQL field ' || coordinate || '. Owner type: ' || owner_type || '. Returns: ' || return_type || '. Arguments: names none; types none. Field description: No description provided. Owner description: No description provided. Aliases: ' || array_to_string(list_sort(list_distinct([replace(field_name, '_', ' '), lower(field_name)])), ', ') || '.' AS semantic,
array_to_string(list_sort(list_distinct([lower(coordinate), lower(owner_type), lower(field_name), lower(return_type)])), ' | ') AS keywords FROM c""",
    "clear_queries": f"WITH {Q} SELECT doc_id, quality FROM q WHERE quality >= 0.25 AND {CLEAR}",
    "world_leakage": f"""WITH {Q}, {TERMS}, k AS (SELECT DISTINCT world, lower(term) AS term FROM terms WHERE length(term) >= 4 AND lower(term) NOT IN {WORLD_TRIVIAL}), have AS (SELECT DISTINCT world FROM terms), qq AS (SELECT doc_id, query, coalesce(nullif(world, ''), 'unknown') AS world FROM q),
l AS (SELECT world, CASE WHEN EXISTS (SELECT 1 FROM k WHERE (k.world = qq.world OR qq.world NOT IN (SELECT world FROM have)) AND contains(lower(query), term)) THEN 1 ELSE 0 END AS leaked FROM qq)
SELECT world, count(*) AS n, sum(leaked)::bigint AS n_leaked FROM l GROUP BY world HAVING avg(leaked) <= 0.5""",
    "strict_leakage": f"""WITH {C}, s AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'show the ' || field_name || 's for me' ELSE 'what about ' || lower(return_type) END AS query,
list_concat(string_split(lower(owner_type), '.'), string_split(lower(field_name), ' ')) AS names FROM c)
SELECT doc_id, query FROM s WHERE NOT list_has_any(list_transform(list_filter(regexp_extract_all(lower(query), '[a-z0-9]+'), lambda x: length(x) >= 3), lambda t: {_stem("t")}), list_transform(list_filter(names, lambda x: length(x) >= 3 AND x NOT IN {NAME_TRIVIAL}), lambda t: {_stem("t")}))""",
    "ambiguous_names": f"WITH {C} SELECT lower(field_name) AS field_name, count(DISTINCT owner_type) AS owners FROM c WHERE lower(field_name) NOT IN ('id', 'createdat', 'updatedat', 'deletedat', 'publishedat', 'version', 'type') GROUP BY 1 HAVING count(DISTINCT owner_type) >= 2",
    "sibling_counts": f"""WITH {C}, d AS (SELECT DISTINCT world_id, owner_type, field_name, return_type FROM c)
SELECT world_id, owner_type, field_name, return_type, (SELECT count(DISTINCT field_name) FROM d x WHERE x.world_id = d.world_id AND x.owner_type = d.owner_type AND x.field_name <> d.field_name) AS same_owner,
(SELECT count(DISTINCT owner_type) FROM d x WHERE x.world_id = d.world_id AND x.field_name = d.field_name AND x.owner_type <> d.owner_type) AS same_name,
(SELECT count(DISTINCT x.owner_type || '.' || x.field_name) FROM d x WHERE x.world_id = d.world_id AND x.return_type = d.return_type AND (x.owner_type <> d.owner_type OR x.field_name <> d.field_name)) AS same_type FROM d""",
    "mined_confusers": f"WITH {C} " + " UNION ALL ".join(_confuser(*x) for x in (("same_owner", "owner_type"), ("same_field_name", "field_name"), ("same_return_type", "return_type"))),
    "tiered_negatives": f"""WITH {SIM}, a AS (SELECT query_id, doc_id, rank, ql = dl AS so, query_id % 4 = doc_id % 4 AS sf FROM ranked),
h AS (SELECT *, so AND sum(so::int) OVER (PARTITION BY query_id ORDER BY rank) <= 3 AS hard FROM a), m AS (SELECT *, NOT hard AND sf AND sum((NOT hard AND sf)::int) OVER (PARTITION BY query_id ORDER BY rank) <= 3 AS medium FROM h),
e AS (SELECT *, NOT hard AND NOT medium AND sum((NOT hard AND NOT medium)::int) OVER (PARTITION BY query_id ORDER BY rank) <= 3 AS easy FROM m)
SELECT query_id, doc_id, rank, CASE WHEN hard THEN 'hard' WHEN medium THEN 'medium' ELSE 'easy' END AS tier FROM e WHERE hard OR medium OR easy""",
    "margin_buckets": f"WITH {SCORES} SELECT * FROM b",
    "stratified_items": f"""WITH {SCORES}, f AS (SELECT * FROM (VALUES ('hard', 0.55::double), ('medium', 0.3::double), ('easy', 0.15::double)) v(bucket, share)), n AS (SELECT bucket, count(*) AS k FROM b GROUP BY bucket),
tot AS (SELECT coalesce(min(trunc(k / share)), 0)::bigint AS total FROM n JOIN f USING (bucket)), r AS (SELECT item, bucket, row_number() OVER (PARTITION BY bucket ORDER BY item) AS nth FROM b)
SELECT item, bucket FROM r JOIN f USING (bucket), tot WHERE total = 0 OR nth <= round_even(total * share, 0)""",
    "best_by_text": f"WITH {Q} SELECT {NORM} AS norm, first(doc_id ORDER BY quality DESC, doc_id) AS doc_id, count(*) AS n_rows FROM q GROUP BY 1",
    "family_split": f"""WITH {Q}, f AS (SELECT DISTINCT world FROM q), r AS (SELECT world, row_number() OVER (ORDER BY md5('11|' || world), world) AS nth, count(*) OVER () AS n FROM f)
SELECT world, CASE WHEN nth <= trunc(n * 0.8::double) THEN 'train' WHEN nth <= trunc(n * 0.8::double) + trunc(n * 0.1::double) THEN 'val' ELSE 'test' END AS split FROM r""",
    "sanity_sample": f"WITH {Q} SELECT doc_id, world FROM q ORDER BY md5('12|' || doc_id), doc_id LIMIT 20",
    "quality_slices": f"WITH {Q}, s AS (SELECT unnest(['intent:' || coalesce(intent, 'unknown'), 'source:' || coalesce(world, 'unknown')]) AS slice, quality FROM q) SELECT slice, count(*) AS n, round(avg(quality), 6) AS avg_quality FROM s GROUP BY slice",
    "content_hash": f"WITH {C} SELECT world_id, sha256(string_agg(coordinate, chr(10) ORDER BY doc_id)) AS digest FROM c GROUP BY world_id",
    "stage_counts": f"WITH {Q} SELECT intent, count(*) AS raw, count(*) FILTER (quality >= 0.25) AS quality_ok, count(*) FILTER (quality >= 0.25 AND {CLEAR}) AS clear, count(*) FILTER (quality >= 0.25 AND {CLEAR} AND nth = 1) AS deduped FROM (SELECT *, row_number() OVER (PARTITION BY quality >= 0.25 AND {CLEAR}, {NORM} ORDER BY quality DESC, doc_id) AS nth FROM q) q GROUP BY intent",
    "best_epoch": "WITH r AS (SELECT event_type AS suite, hour(ts) AS epoch, round(avg(value), 4) AS score FROM events GROUP BY 1, 2) SELECT suite, first(epoch ORDER BY score DESC, epoch) AS best_epoch, max(score) AS best_score FROM r GROUP BY suite",
    "curated_merge": f"""WITH {Q}, w AS (SELECT DISTINCT unnest(string_split(lower(query), ' ')) AS w FROM q), i AS (SELECT DISTINCT item_id, unnest(list_filter(string_split(trim(regexp_replace(lower(text), '\\s+', ' ', 'g')), ' '), lambda x: x <> '')) AS w FROM benchmark)
SELECT item_id, count(*) AS n_words, count(w.w) AS n_known, CASE WHEN count(w.w) = count(*) THEN 'kept' ELSE 'rejected' END AS state FROM i LEFT JOIN w USING (w) GROUP BY item_id""",
    "bucket_vectors": f"WITH {Q}, t AS (SELECT doc_id, unnest(list_filter(string_split({NORM}, ' '), lambda x: x <> '')) AS t FROM q), b AS (SELECT doc_id, ('0x' || substr(md5(t), 1, 8))::bigint % 512 AS b, count(*) AS c FROM t GROUP BY 1, 2) SELECT doc_id, count(*) AS entries, sum(c * c)::bigint AS norm2, sum(b * c)::bigint AS checksum FROM b GROUP BY doc_id",
}

ORACLES["competition_sets"] = f"""WITH {C}, s AS (SELECT lower(field_name) AS name FROM c WHERE lower(field_name) NOT IN ('id', 'createdat', 'updatedat', 'deletedat', 'publishedat', 'version', 'type') GROUP BY 1 HAVING count(DISTINCT owner_type) >= 2),
d AS (SELECT DISTINCT world_id, lower(field_name) AS name, coordinate, owner_type LIKE '%#1%' AS told FROM c WHERE lower(field_name) IN (SELECT name FROM s)), r AS ({_ring("d", "world_id, name, told", "coordinate", "3")}),
a AS (SELECT d.world_id, d.name, d.coordinate, m.told, m.n, coalesce(o.place, {_draw("3", "d.coordinate")} % m.n) AS at_ FROM d JOIN (SELECT DISTINCT world_id, name, told, n FROM r) m USING (world_id, name) LEFT JOIN r o ON o.world_id = d.world_id AND o.name = d.name AND o.told = m.told AND o.coordinate = d.coordinate),
x AS (SELECT a.world_id, a.coordinate, a.told, step, r.coordinate AS rival FROM (SELECT *, unnest(range(0, least(6, n))) AS step FROM a) a JOIN r ON r.world_id = a.world_id AND r.name = a.name AND r.told = a.told AND r.place = (a.at_ + step) % a.n WHERE r.coordinate <> a.coordinate),
y AS (SELECT *, row_number() OVER (PARTITION BY world_id, coordinate ORDER BY told DESC, step) AS place FROM x)
SELECT world_id, coordinate, 0 AS place, coordinate AS rival FROM d UNION ALL SELECT world_id, coordinate, place, rival FROM y WHERE place <= 5"""
ORACLES["batch_plan"] = f"""WITH {C}, t AS (SELECT world_id, doc_id, 1 + doc_id % 4 AS want, md5('5|' || doc_id) AS k FROM c),
b AS (SELECT *, coalesce(sum(want) OVER (PARTITION BY world_id ORDER BY k, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, row_number() OVER (PARTITION BY world_id ORDER BY k, doc_id) - 1 AS batch_no FROM t)
SELECT world_id, batch_no, doc_id, least(want, 40 - before)::bigint AS requested FROM b WHERE before < 40"""
ORACLES["training_pairs"] = f"""WITH {C}, conf AS ({" UNION ALL ".join(_confuser(*x) for x in (("1", "owner_type"), ("2", "field_name"), ("3", "return_type")))}), firsts AS (SELECT world_id, coordinate, min(doc_id) AS id FROM c GROUP BY 1, 2),
own AS (SELECT c.doc_id, tag::int AS place, f.id AS negative FROM c JOIN conf ON c.world_id = conf.world_id AND c.coordinate = conf.coordinate JOIN firsts f ON f.world_id = c.world_id AND f.coordinate = conf.negative WHERE f.id <> c.doc_id),
r AS ({_ring("c", "world_id", "doc_id", "9")}), fill AS (SELECT a.doc_id, 10 + step AS place, b.doc_id AS negative FROM (SELECT *, unnest(range(1, 7)) AS step FROM r) a JOIN r b ON a.world_id = b.world_id AND b.place = (a.place + a.step) % a.n WHERE a.step < a.n),
e AS (SELECT doc_id, negative, min(place) AS place FROM (SELECT * FROM own UNION ALL SELECT * FROM fill) GROUP BY 1, 2), m AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY place, negative) AS nth FROM e)
SELECT doc_id, max(CASE WHEN nth = 1 THEN negative END) AS negative_1, max(CASE WHEN nth = 2 THEN negative END) AS negative_2, max(CASE WHEN nth = 3 THEN negative END) AS negative_3 FROM m GROUP BY doc_id HAVING count(*) >= 3"""
RANKS = """t AS (SELECT label, min(vec_id) AS target_id FROM embeddings GROUP BY label), a AS (SELECT q.vec_id, q.embedding::double[] AS e, x.embedding::double[] AS g FROM embeddings q JOIN t USING (label) JOIN embeddings x ON x.vec_id = t.target_id WHERE q.vec_id % 10 = 0 AND q.vec_id <> t.target_id),
s AS (SELECT a.vec_id AS query_id, round(list_dot_product(e[1:32], d.embedding[1:32]::double[]), 6) > round(list_dot_product(e[1:32], g[1:32]), 6) AS b, round(list_dot_product(e, d.embedding::double[]), 6) > round(list_dot_product(e, g), 6) AS u FROM a JOIN embeddings d ON d.vec_id <> a.vec_id),
r AS (SELECT query_id, count(*) FILTER (b) + 1 AS base_rank, count(*) FILTER (u) + 1 AS tuned_rank FROM s GROUP BY query_id)"""
ORACLES["rank_delta"] = f"WITH {RANKS} SELECT *, base_rank - tuned_rank AS delta FROM r"


def _mean(f: str) -> str:
    one = lambda c: f"round(coalesce(avg({f.format(c)}), 0), 6)"
    return f"SELECT {one('base_rank')} AS base, {one('tuned_rank')} AS tuned FROM r"


ORACLES["base_and_tuned"] = f"WITH {RANKS}, m AS (" + " UNION ALL ".join(f"SELECT '{name}' AS metric, * FROM ({_mean(f)})" for name, f in (("exact_match_at_1", "({0} <= 1)::int::double"), ("recall_at_5", "({0} <= 5)::int::double"), ("mrr_at_10", "CASE WHEN {0} <= 10 THEN 1.0::double / {0} ELSE 0 END"), ("ndcg_at_10", "CASE WHEN {0} <= 10 THEN 1.0::double / log2({0} + 1.0::double) ELSE 0 END"))) + ") SELECT *, round(tuned - base, 6) AS delta FROM m"
ORACLES["field_intents"] = f"""WITH {C}, f AS (SELECT doc_id, {list(FIELD_NAMES)}[doc_id % {len(FIELD_NAMES)} + 1] AS n, {list(FIELD_TYPES)}[doc_id % {len(FIELD_TYPES)} + 1] AS t FROM c), k AS (SELECT *, translate(t, '![]', '') AS kind FROM f)
SELECT doc_id, CASE WHEN n = 'createdAt' OR kind IN ('DateTime', 'Date') THEN 'temporal' ELSE coalesce(nullif(concat_ws(',', CASE n WHEN 'author' THEN 'authorship' WHEN 'approvedBy' THEN 'authorship' WHEN 'status' THEN 'status' WHEN 'lastError' THEN 'troubleshooting' WHEN 'priceCents' THEN 'comparison' WHEN 'tags' THEN 'filtering' WHEN 'email' THEN 'lookup' END,
CASE WHEN contains(t, '[') THEN 'list_vs_single' END, CASE WHEN kind IN ('Item', 'User') THEN 'root_vs_nested' END), ''), 'lookup') END AS intents FROM k"""
# fixed values, for the SQL alone: words that rewrites swap
_SWAPS = [("show", "list"), ("find", "locate"), ("fetch", "retrieve"), ("explain", "describe"), ("difference", "compare"), ("information", "info"), ("identifier", "id"), ("number", "num"), ("query", "qry")]
_REWRITES = ", ".join(["s", *(rf"regexp_replace(s, '\b{a}\b', '{b}', 'gi')" for a, b in _SWAPS), "replace(s, 'graphql', 'gql')", "replace(s, 'how do i', 'how can i')"])
ORACLES["query_variants"] = f"""WITH {Q}, s AS (SELECT doc_id, trim('Show the type of ' || query || ' number?') AS s FROM q), w AS (SELECT doc_id, s, unnest([{_REWRITES}]) AS w FROM s),
v AS (SELECT DISTINCT doc_id, s, trim(unnest([trim(w), lower(trim(w)), replace(trim(w), '?', ''), replace(trim(w), '  ', ' '), replace(trim(w), 'type', 'typ')])) AS v FROM w),
n AS (SELECT doc_id, v, row_number() OVER (PARTITION BY doc_id ORDER BY v <> s, v) - 1 AS place FROM v WHERE v <> '')
SELECT doc_id, place, v AS variant, CASE WHEN place = 0 THEN 'bootstrap' ELSE 'deterministic-augment' END AS origin, CASE WHEN place = 0 THEN 0.85::double ELSE 0.65::double END AS quality_score FROM n WHERE place <= 6"""
ORACLES["template_queries"] = f"WITH {C} SELECT doc_id, 'lookup' AS intent, 'what is ' || return_type AS query FROM c UNION ALL SELECT doc_id, 'lookup', 'show ' || return_type || ' of ' || owner_type FROM c UNION ALL SELECT doc_id, 'comparative', 'difference between ' || return_type || ' and ' || owner_type FROM c"
ORACLES["valid_items"] = f"""WITH {Q}, i AS (SELECT doc_id, world, query, ['easy', 'medium', 'hard', 'odd'][doc_id % 4 + 1] AS difficulty, ['lookup', 'status', 'other'][doc_id % 3 + 1] AS intent, 'c' || doc_id % 100 AS positive FROM q),
k AS (SELECT world, list(DISTINCT 'c' || doc_id % 100) AS known FROM q WHERE doc_id IN (SELECT doc_id FROM labels) GROUP BY world),
{TERMS}, t AS (SELECT DISTINCT world, lower(term) AS term FROM terms WHERE contains(term, '.') AND length(term) >= 5 OR length(term) >= 4 AND lower(term) NOT IN {ITEM_TRIVIAL}),
g AS (SELECT i.*, known, list_filter(['c' || doc_id * 3 % 100, 'c' || doc_id * 5 % 100], lambda x: list_contains(known, x)) AS rel, list_filter(['c' || doc_id % 100, 'c' || doc_id * 7 % 100, 'c' || doc_id * 9 % 100], lambda x: list_contains(known, x) AND x <> positive) AS neg FROM i JOIN k ON i.world = k.world)
SELECT doc_id, difficulty, intent, CASE WHEN len(rel) > 0 THEN array_to_string(rel, ',') ELSE positive END AS relevant, coalesce(array_to_string(neg, ','), '') AS negative FROM g
WHERE difficulty <> 'odd' AND intent <> 'other' AND len(list_filter(string_split({NORM}, ' '), lambda x: x <> '')) >= 3 AND NOT list_bool_or(list_transform(['field', 'schema', 'coordinate', 'graphql', 'column', 'attribute', 'property', 'endpoint', 'parameter', 'which field', 'what field', 'same as the', 'is the same as'], lambda w: contains(lower(query), w))) AND list_contains(known, positive)
AND NOT EXISTS (SELECT 1 FROM t WHERE t.world = g.world AND contains(lower(query), term))"""
ORACLES["stratified_worlds"] = f"""WITH {SCORES}, i AS (SELECT vec_id AS item, (label % 2)::varchar AS world_id FROM embeddings WHERE vec_id % 10 = 0), x AS (SELECT i.item, world_id, coalesce(bucket, 'easy') AS bucket FROM i LEFT JOIN b ON i.item = b.item),
f AS (SELECT * FROM (VALUES ('hard', 0.55::double), ('medium', 0.3::double), ('easy', 0.15::double)) v(bucket, share)), n AS (SELECT world_id, bucket, count(*) AS k FROM x GROUP BY 1, 2), tot AS (SELECT world_id, min(floor(k / share)) AS total FROM n JOIN f USING (bucket) GROUP BY 1),
r AS (SELECT *, row_number() OVER (PARTITION BY world_id, bucket ORDER BY item) AS nth FROM x) SELECT r.item, r.world_id, r.bucket, CASE WHEN r.bucket = 'hard' THEN w.doc_id END AS base_wrong FROM r JOIN f USING (bucket) JOIN tot USING (world_id) LEFT JOIN (SELECT query_id, doc_id FROM ranked WHERE rank = 1) w ON w.query_id = r.item WHERE total = 0 OR nth <= round_even(total * share, 0)"""

QUERIES |= studies.QUERIES
ORACLES |= studies.ORACLES
