"""Quality rules with thresholds from mergeable quantile sketches, in DataFrame functions only.

Each text gives counts (words, symbols, repeated lines and word windows). Per
language and source, every measure is summed into a log-bucket sketch: counts by
ceil(log_gamma(value)), which merge by addition in any order, are partially
aggregated before the shuffle, and give every quantile within one per cent of
its value. A measure's bounds are fences around the sketch's quartiles, so they
follow each group's own texts. A group of fewer than ``least_rows`` texts takes
the merged sketch of its language, or else of all texts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldloom.llm.common import SPACE, materialize, text_or_empty

SYMBOLS = r"[#*$%&|<>]+"
MIN_WORDS, LEAST_ROWS, FENCE = 50, 30, 3.0
#: measure -> (numerator, denominator, least spread of the quartiles, bound below too)
MEASURES = {"symbol_share": ("n_symbols", "word_chars", 0.02, False), "dup_line_share": ("n_dup_lines", "n_lines", 0.05, False), "repeat_share": ("n_repeat_words", "n_words", 0.05, False), "word_length": ("word_chars", "n_words", 0.5, True)}
ALPHA = 0.01
GAMMA = (1 + ALPHA) / (1 - ALPHA)
ZERO = -100_000
POS_BITS = 20


def _covered(pos: Column) -> Column:
    """Words in 3-word windows that start at the sorted places."""
    steps = F.zip_with(pos, F.slice(pos, F.lit(2), F.size(pos)), lambda a, b: F.when(b.isNull(), F.lit(3)).otherwise(F.least(b - a, F.lit(3))).cast("long"))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda s, x: s + x)


def text_counts(docs: DataFrame, keep: tuple[str, ...] = ("doc_id", "lang", "source")) -> DataFrame:
    """The columns kept, with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words (long)."""
    text = text_or_empty()
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = docs.select(*keep, text.alias("text"))
    df = df.select(*keep, F.array_remove(F.split("text", SPACE), "").alias("w"), lines.alias("lines"), F.char_length(F.regexp_replace("text", SPACE, "")).cast("long").alias("word_chars"), (F.char_length("text") - F.char_length(F.regexp_replace("text", SYMBOLS, ""))).cast("long").alias("n_symbols"))
    counts = [F.size("w").cast("long").alias("n_words"), "word_chars", "n_symbols", F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines")]
    names = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines"]
    # a window is the hash of its words with its place in the low bits: sorting longs brings equal windows together
    w, low = F.col("w"), F.lit((1 << POS_BITS) - 1).cast("long")
    fits = (F.size(w) >= 3) & (F.size(w) < (1 << POS_BITS))
    packed = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.shiftleft(F.shiftright(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)), POS_BITS), POS_BITS).bitwiseOR(i.cast("long")))
    df = df.select(*keep, *counts, "w", F.when(fits, F.sort_array(packed)).alias("packed"))
    at = lambda x: x.bitwiseAND(low).cast("int")
    same = lambda a, b: (F.get(w, at(a)) == F.get(w, at(b))) & (F.get(w, at(a) + 1) == F.get(w, at(b) + 1)) & (F.get(w, at(a) + 2) == F.get(w, at(b) + 2))
    pairs = F.filter(F.zip_with("packed", F.slice("packed", F.lit(2), F.size("packed")), lambda a, b: F.when(F.shiftright(a, POS_BITS) == F.shiftright(b, POS_BITS), F.struct(at(a).alias("a"), at(b).alias("b"), same(a, b).alias("same")))), lambda x: x.isNotNull())
    df = df.select(*keep, *names, "w", pairs.alias("pairs"))
    places = F.array_sort(F.array_distinct(F.flatten(F.transform("pairs", lambda x: F.array(x["a"], x["b"])))))
    # where two different windows share the hash bits, or a text is too long for them, the windows themselves are sorted
    whole = F.sort_array(F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.struct(F.get(w, i).alias("x"), F.get(w, i + 1).alias("y"), F.get(w, i + 2).alias("z"), i.alias("i"))))
    slow = F.transform(F.array(whole), lambda s: F.array_sort(F.array_distinct(F.flatten(F.filter(F.zip_with(s, F.slice(s, F.lit(2), F.size(s)), lambda a, b: F.when((a["x"] == b["x"]) & (a["y"] == b["y"]) & (a["z"] == b["z"]), F.array(a["i"], b["i"]))), lambda x: x.isNotNull())))))[0]
    bad = F.coalesce(F.exists("pairs", lambda x: ~x["same"]), F.size(w) >= 3)
    df = df.select(*keep, *names, F.when(bad, slow).when(F.size("pairs") > 0, places).alias("places"))
    return df.select(*keep, *names, F.when(F.size("places") > 0, _covered(F.col("places"))).otherwise(F.lit(0)).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.lit(100) * F.col("n_repeat_words") > F.lit(50) * F.col("n_words"))


def bucket(value: Column) -> Column:
    return F.when(value <= 0, F.lit(ZERO)).otherwise(F.ceil(F.log(value) / F.lit(math.log(GAMMA)))).cast("int")


def bucket_value(b: Column) -> Column:
    return F.when(b == ZERO, F.lit(0.0)).otherwise(F.lit(2.0) * F.pow(F.lit(GAMMA), b) / F.lit(1 + GAMMA))


def measure(name: str) -> Column:
    top, under, _, _ = MEASURES[name]
    return F.when(F.col(under) > 0, F.col(top) / F.col(under)).otherwise(F.lit(0.0))


def sketches(counts: DataFrame) -> DataFrame:
    """(lang, source, level, measure, bucket, n): one mergeable sketch for each measure of each group, language, and all."""
    measures = F.array(*(F.struct(F.lit(m).alias("measure"), bucket(measure(m)).alias("bucket")) for m in MEASURES))
    own = counts.select("lang", "source", F.explode(measures).alias("m")).groupBy("lang", "source", "m.measure", "m.bucket").agg(F.count(F.lit(1)).alias("n"))
    own = own.withColumn("level", F.lit(0))
    langs = own.groupBy("lang", "measure", "bucket").agg(F.sum("n").alias("n")).select("lang", F.lit(None).cast("string").alias("source"), "measure", "bucket", "n", F.lit(1).alias("level"))
    every = own.groupBy("measure", "bucket").agg(F.sum("n").alias("n")).select(F.lit(None).cast("string").alias("lang"), F.lit(None).cast("string").alias("source"), "measure", "bucket", "n", F.lit(2).alias("level"))
    return own.unionByName(langs).unionByName(every)


def quartiles(sketch: DataFrame) -> DataFrame:
    """(lang, source, level, measure, rows, q1, q3) of each sketch."""
    of = Window.partitionBy("level", "lang", "source", "measure")
    up = of.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    ranked = sketch.withColumn("rows", F.sum("n").over(of)).withColumn("upto", F.sum("n").over(up))
    at = lambda q: F.min(F.when(F.col("upto") >= F.lit(q) * F.col("rows"), F.col("bucket")))
    return ranked.groupBy("level", "lang", "source", "measure").agg(F.first("rows").alias("rows"), bucket_value(at(0.25)).alias("q1"), bucket_value(at(0.75)).alias("q3"))


def thresholds(counts: DataFrame, least_rows: int = LEAST_ROWS, fence: float = FENCE) -> DataFrame:
    """(lang, source, {measure}_low, {measure}_high): the bounds of each group that has rows."""
    marks = quartiles(sketches(counts))
    own = marks.filter("level = 0").drop("level")
    lang = marks.filter("level = 1").select("lang", "measure", F.col("rows").alias("rows1"), F.col("q1").alias("q1_1"), F.col("q3").alias("q3_1"))
    every = marks.filter("level = 2").select("measure", F.col("q1").alias("q1_2"), F.col("q3").alias("q3_2"))
    lang = lang.withColumnRenamed("lang", "lang1").withColumnRenamed("measure", "measure1")
    df = own.join(lang, own["lang"].eqNullSafe(lang["lang1"]) & (own["measure"] == lang["measure1"])).join(every, "measure")
    pick = lambda q: F.when(F.col("rows") >= least_rows, F.col(q)).when(F.col("rows1") >= least_rows, F.col(f"{q}_1")).otherwise(F.col(f"{q}_2"))
    least = F.coalesce(*(F.when(F.col("measure") == m, F.lit(x[2])) for m, x in MEASURES.items()))
    df = df.select("lang", "source", "measure", pick("q1").alias("q1"), pick("q3").alias("q3")).withColumn("spread", F.lit(fence) * F.greatest(F.col("q3") - F.col("q1"), least))
    one = lambda m, c: F.max(F.when(F.col("measure") == m, c))
    return df.groupBy("lang", "source").agg(*(one(m, F.col("q3") + F.col("spread")).alias(f"{m}_high") for m in MEASURES), *(one(m, F.col("q1") - F.col("spread")).alias(f"{m}_low") for m, x in MEASURES.items() if x[3]))


def quality_rules(docs: DataFrame, least_rows: int = LEAST_ROWS, fence: float = FENCE) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept of every row.

    Texts that fail the base rules are left out of the sketches. Null text has
    no words and fails. Null languages and sources are groups of their own.
    Repeated rows count each time; columns other than doc_id, text, lang and
    source are not read.
    """
    counts = materialize(text_counts(docs), "quality-counts").withColumn("base_failed", base_failed())
    bounds = thresholds(counts.filter("not base_failed"), least_rows, fence).withColumnRenamed("lang", "lang_of").withColumnRenamed("source", "source_of")
    # no hint: the planner broadcasts the bounds only while they are small, and else splits skewed groups
    df = counts.join(bounds, counts["lang"].eqNullSafe(bounds["lang_of"]) & counts["source"].eqNullSafe(bounds["source_of"]), "left")
    inside = F.lit(True)
    for m, x in MEASURES.items():
        inside = inside & (measure(m) <= F.col(f"{m}_high"))
        if x[3]:
            inside = inside & (measure(m) >= F.col(f"{m}_low"))
    return df.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & F.coalesce(inside, F.lit(False))).alias("kept"))
