"""JSON-lines scans and the sinks of datasets, suites and metrics."""

from __future__ import annotations

import json
import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_jsonl(spark: SparkSession, path: str, schema: str, legacy: dict[str, str] | None = None) -> DataFrame:
    """Typed rows; a bad line fails the read. legacy: old key -> column, used where the column is null."""
    legacy = legacy or {}
    kinds = {f.name: f.dataType.simpleString() for f in spark.createDataFrame([], schema).schema}
    old = "".join(f", `{k}` {kinds[c]}" for k, c in legacy.items())
    df = spark.read.schema(schema + old).option("mode", "FAILFAST").json(path)
    back = {c: [k for k, to in legacy.items() if to == c] for c in kinds}
    return df.select(*(F.coalesce(c, *back[c]).alias(c) for c in kinds))


def read_suites(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """Rows of every .jsonl file of a folder, with its stem as ``suite``."""
    return spark.read.schema(schema).option("mode", "FAILFAST").option("pathGlobFilter", "*.jsonl").json(folder).withColumn("suite", F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.jsonl$", 1))


def read_tolerant(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """Good rows and rejected ones (line, value), both with their line, from 1; blank lines and those that begin with # are neither.

    A file is read whole, to number its lines: curated files are small.
    """
    whole = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\r?\n")).alias("i", "value"))
    lines = whole.select((F.col("i") + 1).alias("line"), "value").filter("trim(value) <> '' and not ltrim(value) like '#%'")
    rows = lines.select("line", "value", F.from_json("value", f"{schema}, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("r"))
    bad = F.col("r").isNull() | F.col("r._bad").isNotNull()
    return rows.filter(~bad).select("line", "r.*").drop("_bad"), rows.filter(bad).select("line", "value")


def pending(plan: DataFrame, checkpoint: DataFrame, keys: list[str]) -> DataFrame:
    """Batches of a plan that a checkpoint doesn't hold yet."""
    return plan.join(checkpoint.select(*keys).distinct(), keys, "left_anti")


def read_json(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Whole JSON documents, a row each (a list gives a row an element); a bad one fails the read."""
    reader = spark.read.option("multiLine", True).option("mode", "FAILFAST")
    return (reader.schema(schema) if schema else reader).json(path)


def read_split(spark: SparkSession, path: str, schema: str, split: str | None = None) -> DataFrame:
    """Typed rows of a dataset in JSON lines, of one split where that is given and not empty."""
    df = read_jsonl(spark, path, schema)
    return df if not split else df.filter(F.col("split") == split)


def read_settings(path: str | None) -> dict:
    """Settings of a run from YAML or JSON; none for no path. YAML needs its library."""
    if not path:
        return {}
    with open(path, encoding="utf-8") as f:
        if path.endswith(".json"):
            return json.load(f)
        try:
            import yaml
        except ImportError:
            return _plain_yaml(f.read())
        return yaml.safe_load(f) or {}


def _plain_yaml(text: str) -> dict:
    """Nested ``key: value`` lines by indentation, for where no YAML library is installed."""
    root: dict = {}
    stack = [(-1, root)]
    for line in text.splitlines():
        bare = line.split(" #")[0].rstrip()
        if not bare.strip() or bare.lstrip().startswith("#"):
            continue
        if bare.lstrip().startswith("- ") or ":" not in bare:
            raise ValueError("lists in settings need a YAML library")
        depth, (key, _, value) = len(bare) - len(bare.lstrip()), bare.strip().partition(":")
        while stack[-1][0] >= depth:
            stack.pop()
        if value.strip():
            try:
                stack[-1][1][key] = json.loads(value.strip())
            except ValueError:
                stack[-1][1][key] = value.strip().strip("'\"")
        else:
            stack[-1][1][key] = {}
            stack.append((depth, stack[-1][1][key]))
    return root


def first_of(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The first row of each key in an order."""
    return df.withColumn("_nth", F.row_number().over(Window.partitionBy(*keys).orderBy(order))).filter("_nth = 1").drop("_nth")


def corpus_texts(corpus: DataFrame, order: str = "doc_id") -> DataFrame:
    """(coordinate, text), once a coordinate, the first in order: its retrieval text, or else the semantic one, the full one, itself."""
    said = [F.nullif(F.col(c), F.lit("")) for c in ("retrieval_text", "field_semantic_text", "full_text") if c in corpus.columns]
    return first_of(corpus, ["coordinate"], order).select("coordinate", F.coalesce(*said, F.col("coordinate")).alias("text"))


def read_runs(spark: SparkSession, folder: str) -> DataFrame:
    """(run, metric, base, tuned) of run folders that hold metrics_base.json and metrics_tuned.json; others are skipped."""
    df = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "metrics_*.json").text(folder, wholetext=True)
    path = F.col("_metadata.file_path")
    df = df.select(F.regexp_extract(path, r"([^/]+)/metrics_(base|tuned)\.json$", 1).alias("run"), F.regexp_extract(path, r"metrics_(base|tuned)\.json$", 1).alias("side"), F.explode(F.from_json("value", "map<string,string>")).alias("metric", "value"))
    df = df.select("run", "side", "metric", F.expr("try_cast(value as double)").alias("n")).filter("side <> '' and n is not null")
    side = lambda s: df.filter(F.col("side") == s).select("run", "metric", F.col("n").alias(s))
    return side("base").join(side("tuned"), ["run", "metric"])


def look_up(rows: DataFrame, table: DataFrame, key: str, defaults: dict[str, str]) -> DataFrame:
    """rows with the columns of a lookup table by key, and a default where the key isn't there."""
    out = rows.join(table.select(key, *(F.col(c).alias(f"_{c}") for c in defaults)), key, "left")
    for c, d in defaults.items():
        own = F.col(c) if c in rows.columns else F.lit(None)
        out = out.withColumn(c, F.coalesce(f"_{c}", own, F.lit(d))).drop(f"_{c}")
    return out


def ascii_only(c: Column) -> Column:
    """JSON text with characters beyond ASCII as ``\\uXXXX``, in pairs beyond the first plane."""
    def one(ch: Column) -> Column:
        units = F.hex(F.encode(ch, "UTF-16BE"))
        low = F.concat(F.lit("\\u"), F.lower(F.left(units, F.lit(4))))
        pair = F.concat(low, F.lit("\\u"), F.lower(F.substr(units, F.lit(5), F.lit(4))))
        return F.when(F.octet_length(ch) == 1, ch).when(F.length(units) > 4, pair).otherwise(low)

    return F.when(F.octet_length(c) == F.char_length(c), c).otherwise(F.array_join(F.transform(F.regexp_extract_all(c, F.lit(r"(?s)."), F.lit(0)), one), ""))


def write_jsonl(df: DataFrame, path: str, ascii: bool = True) -> None:
    """JSON lines, in ASCII unless told not to; nulls are written."""
    line = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    df.select((ascii_only(line) if ascii else line).alias("value")).write.mode("overwrite").text(path)


def write_json(value: dict, path: str) -> None:
    """A small document with sorted keys."""
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        json.dump(value, f, indent=2, sort_keys=True)


def as_markdown(rows: list[dict], columns: list[str], digits: int = 3) -> str:
    """A table of a few rows."""
    cell = lambda v: f"{v:.{digits}f}" if isinstance(v, float) else "" if v is None else str(v)
    lines = [f"| {' | '.join(columns)} |", f"|{'---|' * len(columns)}"]
    return "\n".join(lines + [f"| {' | '.join(cell(r.get(c)) for c in columns)} |" for r in rows])


def as_example(query: str, target: str, base: list[dict], tuned: list[dict]) -> str:
    """A query's best coordinates under two encoders, as Markdown; the target is marked."""
    mark = lambda rows: [{**r, "coordinate": f"**{r['coordinate']}** (target)" if r["coordinate"] == target else r["coordinate"]} for r in rows]
    cols = ["rank", "coordinate", "score"]
    return f"## {query}\n\nTarget: `{target}`\n\n### Base\n\n{as_markdown(mark(base), cols)}\n\n### Tuned\n\n{as_markdown(mark(tuned), cols)}\n"


def write_dataset(df: DataFrame, path: str, by: str = "split") -> None:
    """Parquet by split or suite, so that reads of one prune the others."""
    df.write.mode("overwrite").partitionBy(by).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
