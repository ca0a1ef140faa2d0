import json

import pytest

from fieldloom.plans.corpus import assert_view, backfill, build_corpus, view_text
from fieldloom.sources import tables
from fieldloom.sources.schemas import parse_introspection, parse_sdl, read_schemas

SDL = '''
"""The root"""
schema { query: Query }
directive @old(reason: String = "x") repeatable on FIELD_DEFINITION | ENUM_VALUE
"Start" type Query { "One user" user(id: ID!, "How many" first: Int = 10, by: Order = {field: NAME, up: [1, 2]}): User @old(reason: "no")
  users: [User!]! }
interface Node { id: ID! }
type User implements Node & Named @key(fields: "id") { id: ID!, """
    Mail
      address
  """ e_mail: String # comment
}
extend type User { age: Int }
enum Color { RED "g" GREEN @old }
union Any = | User | Query
input Order { field: Color = RED, up: [Int!] }
scalar Date
type __Hidden { a: Int }
'''


def test_sdl():
    got = {t["type_name"]: t for t in parse_sdl(SDL)}
    assert list(got) == ["Any", "Color", "Date", "Node", "Order", "Query", "User"]
    assert got["Query"]["description"] == "Start" and got["User"]["interfaces"] == ["Node", "Named"]
    user = got["Query"]["fields"][0]
    assert user["description"] == "One user" and [(a["name"], a["type_name"], a["description"]) for a in user["args"]] == [("id", "ID", None), ("first", "Int", "How many"), ("by", "Order", None)]
    assert [(f["name"], f["type_name"]) for f in got["User"]["fields"]] == [("id", "ID"), ("e_mail", "String"), ("age", "Int")]
    assert got["User"]["fields"][1]["description"] == "Mail\n  address"
    assert got["Color"]["enum_values"] == ["RED", "GREEN"] and got["Any"]["possible_types"] == ["User", "Query"] and got["Order"]["type_kind"] == "GraphQLInputObjectType"
    with pytest.raises(ValueError):
        parse_sdl("type A { b: ")


def test_introspection():
    t = {"kind": "OBJECT", "name": "A", "fields": [{"name": "b", "args": [{"name": "c", "type": {"kind": "SCALAR", "name": "Int"}}], "type": {"kind": "NON_NULL", "ofType": {"kind": "LIST", "ofType": {"kind": "SCALAR", "name": "ID"}}}}], "interfaces": []}
    bare = {"__schema": {"types": [t, {"kind": "OBJECT", "name": "__Type"}]}}
    got = parse_introspection(json.dumps({"data": bare}))
    assert got == parse_introspection(json.dumps(bare)) and len(got) == 1
    assert got[0]["fields"] == [{"name": "b", "type_name": "ID", "description": None, "args": [{"name": "c", "type_name": "Int", "description": None}]}]


def test_corpus(spark, tmp_path):
    (tmp_path / "shop.graphql").write_text(SDL)
    types = read_schemas(spark, str(tmp_path))
    assert types.select("world_id").distinct().first()[0].startswith("real_shop_")
    rows = {r.coordinate: r for r in build_corpus(types).collect()}
    r = rows["Query.user"]
    assert r.field_signature_text == "Query.user(id: ID, first: Int, by: Order): User" and r.argument_signature == "id: ID, first: Int, by: Order"
    assert r.field_semantic_text == "GraphQL field Query.user. Owner type: Query. Returns: User. Arguments: names id, first, by; types ID, Int, Order. Field description: One user Owner description: Start Aliases: user."
    assert rows["User.e_mail"].sdl_snippet_text == "type User {\n  e_mail: String\n}" and rows["User.e_mail"].aliases == ["e_mail", "e mail"]
    assert rows["Node.id"].field_semantic_text.endswith("Arguments: names none; types none. Field description: No description provided. Owner description: No description provided. Aliases: id.")
    corpus = build_corpus(types)
    assert_view(corpus, "sdl_snippet_text")
    blank = corpus.selectExpr("doc_id", "coordinate", "'' as field_semantic_text")
    with pytest.raises(ValueError, match="backfill"):
        assert_view(blank, "field_semantic_text")
    assert {x[0] for x in blank.select(view_text("semantic")).collect()} == set(rows)
    again = {x.doc_id: x for x in backfill(blank, corpus.filter("owner_type = 'User'")).collect()}
    assert again["User.age"].field_semantic_text and not again["Query.user"].field_semantic_text


def test_jsonl(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"q": "x", "old": "p"}\n\n{"q": "y", "pos": "r"}\n')
    (tmp_path / "b.jsonl").write_text('{"q": "z"}\n')
    assert [tuple(r) for r in tables.read_jsonl(spark, str(tmp_path / "a.jsonl"), "q string, pos string", {"old": "pos"}).orderBy("q").collect()] == [("x", "p"), ("y", "r")]
    assert [tuple(r) for r in tables.read_suites(spark, str(tmp_path), "q string").orderBy("q").collect()] == [("x", "a"), ("y", "a"), ("z", "b")]
    (tmp_path / "c.txt").write_text('# no\n\n{"q": "x"}\n{bad\n')
    good, bad = tables.read_tolerant(spark, str(tmp_path / "c.txt"), "q string")
    assert [tuple(r) for r in good.collect()] == [(3, "x")] and [tuple(r) for r in bad.collect()] == [(4, "{bad")]
    tables.write_dataset(spark.createDataFrame([("x", "val"), ("y", "test")], "q string, split string"), str(tmp_path / "d"))
    assert spark.read.parquet(str(tmp_path / "d")).filter("split = 'val'").count() == 1
    plan = spark.createDataFrame([("w", 0), ("w", 1)], "world_id string, batch int")
    assert [tuple(r) for r in tables.pending(plan, plan.filter("batch = 0"), ["world_id", "batch"]).collect()] == [("w", 1)]


def test_stream(spark, tmp_path):
    from fieldloom.streaming.batches import append_batches

    (tmp_path / "in").mkdir()
    where = [str(tmp_path / x) for x in ("in", "out", "state")]
    (tmp_path / "in" / "1.jsonl").write_text('{"world_id": "w", "batch": 0, "requested": 2, "taken_items": 1, "at": "2026-01-01T00:00:00Z"}\n{"world_id": "w", "batch": 1, "requested": 2, "taken_items": 2, "at": "2026-01-01T00:01:00Z"}\n{"torn')
    append_batches(spark, *where).awaitTermination()
    (tmp_path / "in" / "2.jsonl").write_text('{"world_id": "w", "batch": 1, "requested": 2, "taken_items": 2, "at": "2026-01-01T00:01:00Z"}\n{"world_id": "v", "batch": 0, "requested": 1, "taken_items": 1, "at": "2026-01-01T00:02:00Z"}\n')
    append_batches(spark, *where).awaitTermination()
    assert sorted((r.world_id, r.batch) for r in spark.read.parquet(where[1]).collect()) == [("v", 0), ("w", 0), ("w", 1)]
    from fieldloom.streaming.batches import finish

    plan = spark.createDataFrame([("w", 0), ("w", 2)], "world_id string, batch int")
    assert not finish(spark, plan, where[1]) and spark.read.parquet(where[1]).count() == 3
    assert finish(spark, plan.filter("batch = 0"), where[1]) and not (tmp_path / "out").exists()
    (tmp_path / "log.jsonl").write_text('{"_world_id": "w", "batch": 1, "source": "mock"}\n\n{"_world_id": "w"}\n{"torn')
    from fieldloom.operators.seeds import read_checkpoint

    assert [(r._world_id, r.batch, r.source) for r in read_checkpoint(spark, str(tmp_path / "log.jsonl")).collect()] == [("w", 1, "mock")]
