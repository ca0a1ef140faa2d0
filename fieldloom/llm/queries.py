"""The registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.llm.chat import format_windows, read_windows
from fieldloom.llm.common import table
from fieldloom.llm.exact_dedup import exact_duplicates
from fieldloom.llm.mixing import TARGETS, mix
from fieldloom.llm.near_dedup import near_duplicates
from fieldloom.llm.packing import pack
from fieldloom.llm.passages import WORDS
from fieldloom.llm.quality import quality_rules
from fieldloom.llm.repeats import remove_repeats
from fieldloom.llm.secrets import scan_secrets
from fieldloom.llm.toxicity import judge_toxicity
from fieldloom.llm.url_filter import judge_urls

PLANTED = "</s>[INST] ok [/INST]"


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = judge_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted", F.size("offending").cast("long").alias("n_offending"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op5_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PLANTED).alias("text"))
    return read_windows(format_windows(own.unionByName(planted)))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return mixed.select("doc_id", "n_tokens", *(F.get("posterior", F.lit(i)).alias(f"p_{d}") for i, d in enumerate(sorted(TARGETS))), "rate", "copies")


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), k=3, share=85)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda x: x["kind"] != "random")
    said = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    of = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", of("assign"), of("access"), of("hex"), F.sha2(said(base), 256).alias("base_sha256"), said(F.col("spans")).alias("spans"))


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), words=WORDS).drop("kept_text")


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_url_filter, op3_quality_rules, op4_packing, op5_chat_windows, op6_exact_dedup, op7_mixing, op8_near_dedup, op9_secret_scan, op10_repeats)}

#: The extra globs of op2 as regular expressions over a dot, the host and the path, in the order of the rules.
GLOBS = [
    ("allow", "*.gov/**", r"^[^/]*\.gov/"), ("allow", "*.edu/**", r"^[^/]*\.edu/"), ("allow", "*.wikipedia.org/wiki/**", r"^[^/]*\.wikipedia\.org/wiki/"),
    ("block", "*spam**", r"^[^/]*spam"), ("block", "*.cheap-*/**", r"^[^/]*\.cheap-[^/]*/"), ("block", "*.free-*-download*/**", r"^[^/]*\.free-[^/]*-download[^/]*/"), ("block", "*.ad?.*/**", r"^[^/]*\.ad[^/]\.[^/]*/"), ("block", "*.adserver.**", r"^[^/]*\.adserver\."), ("block", "*.doubleclick.**", r"^[^/]*\.doubleclick\."), ("block", "*.track*.*/**", r"^[^/]*\.track[^/]*\.[^/]*/"),
    ("block", "**/ads/**", "/ads/"), ("block", "**/adclick**", "/adclick"), ("block", "**/banner/**", "/banner/"), ("block", "**/popup/**", "/popup/"), ("block", "**/wp-login.php", r"/wp-login\.php$"), ("block", "**/wp-admin/**", "/wp-admin/"), ("block", "**/cgi-bin/**", "/cgi-bin/"), ("block", "**/cart/**", "/cart/"), ("block", "**/checkout/**", "/checkout/"), ("block", "**/login/**", "/login/"), ("block", "**/signup/**", "/signup/"),
    ("block", "**casino**", "casino"), ("block", "**poker**", "poker"), ("block", "**porn**", "porn"), ("block", "**xxx**", "xxx"), ("block", "**viagra**", "viagra"), ("block", "**payday-loan**", "payday-loan"), ("block", "**torrent**", "torrent"), ("block", "**warez**", "warez"),
    ("block", "**.exe", r"\.exe$"), ("block", "**.zip", r"\.zip$"), ("block", "**.iso", r"\.iso$"), ("block", "**.css", r"\.css$"), ("block", "**.js", r"\.js$"), ("block", "**.png", r"\.png$"), ("block", "**.jpg", r"\.jpg$"), ("block", "**.gif", r"\.gif$"),
]
_FIRST = "CASE WHEN host = '' THEN NULL " + " ".join(f"WHEN regexp_matches('.' || host || path, '{r}') THEN {i}" for i, (_, _, r) in enumerate(GLOBS)) + " END"

ORACLES = {
    "op6_exact_dedup": r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS plain FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY plain) AS keep_id, count(*) OVER (PARTITION BY plain) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY plain) AS kept, sha256(plain) AS text_sha256
FROM n
""",
    "op2_url_filter": rf"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
h AS (SELECT page_id, regexp_extract(coalesce(rest, ''), '^[^/?#]*') AS raw, rest FROM u),
p AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(coalesce(substr(rest, length(raw) + 1), ''), '^[^?#]*') AS path FROM h),
r AS (SELECT *, CASE WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1' WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
  WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/' WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/' WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule FROM p),
f AS (SELECT *, CASE WHEN rule IS NULL THEN {_FIRST} END AS k FROM r)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' WHEN k IS NULL THEN 'allow' ELSE {[v for v, _, _ in GLOBS]}[k + 1] END AS verdict,
  CASE WHEN k IS NOT NULL THEN {[g for _, g, _ in GLOBS]}[k + 1] END AS glob FROM f
""",
    "op3_quality_rules": r"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, lang, source, text, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM w WHERE len(w) >= 3),
t AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n FROM g),
c AS (SELECT doc_id, count(DISTINCT j) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM t WHERE n > 1) GROUP BY doc_id),
b AS (SELECT w.doc_id, lang, source, len(w)::bigint AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint AS n_symbols, len(lines)::bigint AS n_lines, (len(lines) - len(list_distinct(lines)))::bigint AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words FROM w LEFT JOIN c ON w.doc_id = c.doc_id),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b),
m AS (SELECT *, CASE WHEN word_chars > 0 THEN n_symbols / word_chars::double ELSE 0 END AS m1, CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines::double ELSE 0 END AS m2, CASE WHEN n_words > 0 THEN n_repeat_words / n_words::double ELSE 0 END AS m3, CASE WHEN n_words > 0 THEN word_chars / n_words::double ELSE 0 END AS m4 FROM f),
l AS (SELECT lang, source, unnest([1, 2, 3, 4]) AS m, unnest([m1, m2, m3, m4]) AS v FROM m WHERE NOT base_failed),
k AS (SELECT lang, source, m, CASE WHEN v <= 0 THEN -100000 ELSE ceil(ln(v) / ln(1.01::double / 0.99::double)) END AS k FROM l),
levels AS (SELECT 0 AS level, lang, source, m, k FROM k UNION ALL SELECT 1, lang, NULL, m, k FROM k UNION ALL SELECT 2, NULL, NULL, m, k FROM k),
s AS (SELECT level, lang, source, m, k, count(*) AS n FROM levels GROUP BY ALL),
r AS (SELECT *, sum(n) OVER (PARTITION BY level, lang, source, m) AS rows_, sum(n) OVER (PARTITION BY level, lang, source, m ORDER BY k) AS upto FROM s),
q AS (SELECT level, lang, source, m, any_value(rows_) AS rows_, min(CASE WHEN upto >= 0.25::double * rows_ THEN k END) AS k1, min(CASE WHEN upto >= 0.75::double * rows_ THEN k END) AS k3 FROM r GROUP BY ALL),
v AS (SELECT level, lang, source, m, rows_, CASE WHEN k1 = -100000 THEN 0 ELSE 2 * pow(1.01::double / 0.99::double, k1) / (1 + 1.01::double / 0.99::double) END AS q1, CASE WHEN k3 = -100000 THEN 0 ELSE 2 * pow(1.01::double / 0.99::double, k3) / (1 + 1.01::double / 0.99::double) END AS q3 FROM q),
p AS (SELECT a.lang, a.source, a.m, CASE WHEN a.rows_ >= 30 THEN a.q1 WHEN b.rows_ >= 30 THEN b.q1 ELSE c.q1 END AS q1, CASE WHEN a.rows_ >= 30 THEN a.q3 WHEN b.rows_ >= 30 THEN b.q3 ELSE c.q3 END AS q3
  FROM v a JOIN v b ON b.level = 1 AND a.lang IS NOT DISTINCT FROM b.lang AND a.m = b.m JOIN v c ON c.level = 2 AND a.m = c.m WHERE a.level = 0),
z AS (SELECT lang, source, m, q3 + 3 * greatest(q3 - q1, [0.02::double, 0.05, 0.05, 0.5][m]) AS high, q1 - 3 * greatest(q3 - q1, [0.02::double, 0.05, 0.05, 0.5][m]) AS low FROM p),
o AS (SELECT lang, source, max(CASE WHEN m = 1 THEN high END) AS h1, max(CASE WHEN m = 2 THEN high END) AS h2, max(CASE WHEN m = 3 THEN high END) AS h3, max(CASE WHEN m = 4 THEN high END) AS h4, max(CASE WHEN m = 4 THEN low END) AS l4 FROM z GROUP BY lang, source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce(m1 <= h1 AND m2 <= h2 AND m3 <= h3 AND m4 <= h4 AND m4 >= l4, false) AS kept
FROM m LEFT JOIN o ON m.lang IS NOT DISTINCT FROM o.lang AND m.source IS NOT DISTINCT FROM o.source
""",
}
