"""Type records from SDL text or introspection JSON."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ARG = "struct<name:string,type_name:string,description:string>"
TYPE_SCHEMA = f"type_id string, type_name string, type_kind string, description string, interfaces array<string>, possible_types array<string>, enum_values array<string>, fields array<struct<name:string,type_name:string,description:string,args:array<{ARG}>>>"
# fixed values: the kinds as records name them
KINDS = {"type": "GraphQLObjectType", "interface": "GraphQLInterfaceType", "input": "GraphQLInputObjectType", "union": "GraphQLUnionType", "enum": "GraphQLEnumType", "scalar": "GraphQLScalarType"}
INTROSPECTED = {"OBJECT": "type", "INTERFACE": "interface", "INPUT_OBJECT": "input", "UNION": "union", "ENUM": "enum", "SCALAR": "scalar"}
LEXEME = re.compile(r'"""(?:\\"""|[^"]|"(?!""))*"""|"(?:\\.|[^"\\\n])*"|#[^\n]*|\.\.\.|[_A-Za-z][_0-9A-Za-z]*|-?[0-9][0-9.eE+-]*|[!$&():=@\[\]{|}]')


def _said(token: str) -> str:
    if not token.startswith('"""'):
        return json.loads(token)
    lines = token[3:-3].replace('\\"""', '"""').split("\n")
    rest = [x for x in lines[1:] if x.strip()]
    pad = min((len(x) - len(x.lstrip()) for x in rest), default=0)
    return "\n".join([lines[0].strip(), *(x[pad:] for x in lines[1:])]).strip("\n ")


class Reader:
    """A cursor over the lexemes of one SDL text."""

    def __init__(self, text: str):
        self.tokens = [t for t in LEXEME.findall(text) if t[0] != "#"]
        self.at = 0

    def peek(self) -> str:
        return self.tokens[self.at] if self.at < len(self.tokens) else ""

    def take(self, want: str | None = None) -> str:
        t = self.peek()
        if not t or want not in (None, t):
            raise ValueError(f"SDL: {want or 'more'} expected, {t or 'the end'} found")
        self.at += 1
        return t

    def maybe(self, t: str) -> bool:
        if self.peek() == t:
            self.at += 1
            return True
        return False

    def description(self) -> str | None:
        return _said(self.take()) if self.peek().startswith('"') else None

    def value(self) -> None:
        t = self.take()
        if t in "[{":
            end = "]" if t == "[" else "}"
            while not self.maybe(end):
                self.value()
                self.maybe(":")
        elif t == "$":
            self.take()

    def directives(self) -> None:
        while self.maybe("@"):
            self.take()
            if self.maybe("("):
                while not self.maybe(")"):
                    self.take()
                    self.take(":")
                    self.value()

    def type_name(self) -> str:
        """The base name, without lists and non-null marks."""
        if self.maybe("["):
            name = self.type_name()
            self.take("]")
        else:
            name = self.take()
        self.maybe("!")
        return name

    def inputs(self, end: str) -> list[dict]:
        out = []
        while not self.maybe(end):
            said, name = self.description(), self.take()
            self.take(":")
            kind = self.type_name()
            if self.maybe("="):
                self.value()
            self.directives()
            out.append({"name": name, "type_name": kind, "description": said})
        return out

    def fields(self) -> list[dict]:
        out = []
        while not self.maybe("}"):
            said, name = self.description(), self.take()
            args = self.inputs(")") if self.maybe("(") else []
            self.take(":")
            kind = self.type_name()
            self.directives()
            out.append({"name": name, "type_name": kind, "description": said, "args": args})
        return out

    def names(self, mark: str) -> list[str]:
        self.maybe(mark)
        out = [self.take()]
        while self.maybe(mark):
            out.append(self.take())
        return out


def parse_sdl(text: str) -> list[dict]:
    """Type records of an SDL text, by name; extensions join their type; introspection's own types (__*) are left out."""
    r, found = Reader(text), {}
    while r.peek():
        said = r.description()
        r.maybe("extend")
        word = r.take()
        if word == "schema":
            r.directives()
            if r.maybe("{"):
                r.inputs("}")
            continue
        if word == "directive":
            r.take("@")
            r.take()
            if r.maybe("("):
                r.inputs(")")
            r.maybe("repeatable")
            r.take("on")
            r.names("|")
            continue
        if word not in KINDS:
            raise ValueError(f"SDL: unknown definition {word!r}")
        name = r.take()
        own = found.setdefault(name, {"type_id": name, "type_name": name, "type_kind": KINDS[word], "description": None, "interfaces": [], "possible_types": [], "enum_values": [], "fields": []})
        own["description"] = said or own["description"]
        if r.maybe("implements"):
            own["interfaces"] += r.names("&")
        r.directives()
        if word == "union" and r.maybe("="):
            own["possible_types"] += r.names("|")
        elif r.maybe("{"):
            if word == "enum":
                while not r.maybe("}"):
                    r.description()
                    own["enum_values"].append(r.take())
                    r.directives()
            elif word == "input":
                own["fields"] += [{**x, "args": []} for x in r.inputs("}")]
            else:
                own["fields"] += r.fields()
    return [found[n] for n in sorted(found) if not n.startswith("__")]


def parse_introspection(text: str) -> list[dict]:
    """The same records of an introspection result, bare or under ``data``."""
    top = json.loads(text)

    def base(t: dict) -> str:
        while t.get("ofType"):
            t = t["ofType"]
        return t["name"]

    def plain(x: dict) -> dict:
        return {"name": x["name"], "type_name": base(x["type"]), "description": x.get("description")}

    out = []
    for t in (top.get("data") or top)["__schema"]["types"]:
        if not t["name"].startswith("__"):
            fields = [{**plain(f), "args": [plain(a) for a in f.get("args") or []]} for f in t.get("fields") or t.get("inputFields") or []]
            out.append({"type_id": t["name"], "type_name": t["name"], "type_kind": KINDS[INTROSPECTED[t["kind"]]], "description": t.get("description"), "interfaces": [i["name"] for i in t.get("interfaces") or []], "possible_types": [p["name"] for p in t.get("possibleTypes") or []] if t["kind"] == "UNION" else [], "enum_values": [e["name"] for e in t.get("enumValues") or []], "fields": fields})
    return sorted(out, key=lambda t: t["type_name"])


def read_schemas(spark: SparkSession, glob: str) -> DataFrame:
    """Type records of every schema file (.graphql, .json), with ``file`` and ``world_id`` (file stem and content hash). Bad files fail."""
    files = spark.read.text(glob, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("raw"))
    files = files.withColumn("world_id", F.concat(F.lit("real_"), F.regexp_extract("file", r"^(.*)\.[^.]*$", 1), F.lit("_"), F.left(F.sha2("raw", 256), F.lit(12))))

    def run(parts):
        for pdf in parts:
            for f, raw, world in pdf[["file", "raw", "world_id"]].itertuples(index=False):
                rows = (parse_introspection if f.endswith(".json") else parse_sdl)(raw)
                yield pd.DataFrame([{"file": f, "world_id": world, **x} for x in rows], columns=["file", "world_id", *(c.split()[0] for c in ("type_id", "type_name", "type_kind", "description", "interfaces", "possible_types", "enum_values", "fields"))])

    return files.mapInPandas(run, f"file string, world_id string, {TYPE_SCHEMA}")


# fixed values: names of files that tell a domain, the first that fits
KNOWN_DOMAINS = ("ecommerce", "shop", "shopify", "stripe", "fintech", "github", "hotel", "travel", "healthcare", "support")


def ingest_schemas(spark: SparkSession, glob: str, splits: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(types, worlds) of real schemas: read_schemas with domain and split, and a row a world with its number of types.

    splits: a file's split by its name, else by its stem, else test.
    """
    from fieldloom.functions.text import domain_of

    stem = F.regexp_extract("file", r"^(.*)\.[^.]*$", 1)
    told = [F.when(F.col("file") == k, F.lit(v)) for k, v in (splits or {}).items()] + [F.when(stem == k, F.lit(v)) for k, v in (splits or {}).items()]
    types = read_schemas(spark, glob).withColumn("domain", domain_of(stem, KNOWN_DOMAINS)).withColumn("split", F.coalesce(*told, F.lit("test")))
    worlds = types.groupBy("file", "world_id", "domain", "split").agg(F.count_distinct("type_name").alias("type_count")).orderBy("file")
    return types, worlds
