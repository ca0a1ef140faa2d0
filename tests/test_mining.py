import hashlib
from collections import Counter

from pyspark.sql import functions as F

from fieldloom.functions.text import choice_key
from fieldloom.operators import mining, planning

COORDS = "world_id string, owner_type string, field_name string, return_type string, coordinate string, aliases array<string>"


def coords(spark, rows):
    return spark.createDataFrame([(w, o, f, r, f"{o}.{f}", a) for w, o, f, r, a in rows], COORDS)


def test_confusers_of_large_groups(spark):
    """One owner with 150 fields of one type: each draws from all the others, not from a few."""
    got = mining.confusers(coords(spark, [("w", "Owner", f"f{i}", "Int", []) for i in range(150)])).collect()
    for tag in ("same_owner", "same_return_type"):
        own = {r.coordinate: r.negative for r in got if r.tag == tag}
        assert len(own) == 150 and all(a != b for a, b in own.items())
        assert len(set(own.values())) > 75 and max(Counter(own.values()).values()) < 10


def test_confusers_beyond_repeated_coordinates(spark):
    """Ninety rows of the target's own coordinate don't hide the one other field; two owners of a name find each other."""
    got = mining.confusers(coords(spark, [("w", "Owner", "same", "Int", [])] * 90 + [("w", "Owner", "other", "Int", [])]))
    assert {(r.coordinate, r.negative) for r in got.filter("tag = 'same_owner'").collect()} == {("Owner.same", "Owner.other"), ("Owner.other", "Owner.same")}
    rows = [("w", "A", f"f{i}", "Int", []) for i in range(300)] + [("w", "A", "name", "S", []), ("w", "B", "name", "T", [])]
    got = mining.confusers(coords(spark, rows)).filter("tag = 'same_field_name'").collect()
    assert {(r.coordinate, r.negative) for r in got} == {("A.name", "B.name"), ("B.name", "A.name")}


def test_confusers_of_two_return_types(spark):
    """A coordinate with rows of two types is in two groups and has a row for each, as in the SQL, though the other of both is the same."""
    got = mining.confusers(coords(spark, [("w", o, "f", t, []) for o in "AB" for t in ("Int", "ID")])).filter("tag = 'same_return_type'").collect()
    assert sorted((r.coordinate, r.negative) for r in got) == [("A.f", "B.f")] * 2 + [("B.f", "A.f")] * 2


def test_lone_coordinate_gets_any_of_its_world(spark):
    got = mining.confusers(coords(spark, [("w", "A", "x", "Int", []), ("w", "B", "y", "Int2", []), ("v", "B", "z", "Int2", [])])).collect()
    assert {(r.world_id, r.coordinate, r.tag, r.negative) for r in got} == {("w", "A.x", "semantic", "B.y"), ("w", "B.y", "semantic", "A.x")}


def stem(name):
    import re

    parts = [p for p in re.split(r"(?<!^)(?=[A-Z])", name)]
    long = [p.lower() for p in parts if len(p) >= 4]
    return long[0] if long else max((p.lower() for p in parts), key=len)


def test_name_siblings(spark):
    names = ["status", "statusHistory", "currentStatus", "id", "idle", "author", "authorId", "statuses", "at", "hat"]
    got = {(r.field_name, r.other) for r in mining.name_siblings(coords(spark, [("w", "A", n, "Int", []) for n in names])).collect()}
    want = {(a, b) for a in names for b in names if len(stem(a)) >= 4 and (stem(a) == stem(b) or stem(a) in b.lower() or stem(b) in a.lower())}
    assert got == want


def test_mined_negatives(spark):
    rows = [("w", "Order", "status", "String", ["state"]), ("w", "Order", "statusHistory", "[S]", []), ("w", "Ticket", "status", "Int", []), ("w", "Ticket", "state", "String", []), ("w", "Order", "id", "ID", []), ("v", "Order", "status", "String", []), ("v", "Far", "thing", "X", [])]
    q = spark.createDataFrame([("1", "w", "Order.status", ["Own.one"], ["t"]), ("2", "none", "Far.thing", None, None), ("3", "w", "No.where", [f"n{i}" for i in range(12)], ["t"]), ("4", None, "Order.status", [], [])], "query_id string, world_id string, positive_coordinate string, negative_coordinates array<string>, confuser_tags array<string>")
    got = {r.query_id: r for r in mining.mine_negatives(q, coords(spark, rows)).collect()}
    one = got["1"]
    assert one.negative_coordinates[0] == "Own.one" and one.negative_coordinates[1] in ("Order.statusHistory", "Ticket.status") and "Order.status" not in one.negative_coordinates
    assert one.confuser_tags == ["t", "name_similarity", "structural", "lexical", "argument-shape", "semantic"]
    assert set(one.negative_coordinates[1:]) <= {"Order.statusHistory", "Ticket.status", "Ticket.state", "Order.id"} and 4 <= len(one.negative_coordinates) <= 5
    assert got["2"].negative_coordinates == ["Order.status"] and got["2"].confuser_tags == []
    assert got["3"].negative_coordinates == [f"n{i}" for i in range(8)] and got["3"].confuser_tags == ["t"]
    assert got["4"].negative_coordinates  # by coordinate alone


def test_alias_siblings_pair_coordinates_not_rows(spark):
    """300 rows of each of two coordinates: the aliases' join makes a row a pair, not 300 times 300."""
    got = mining.alias_siblings(coords(spark, [("w", "A", "id", "Int", ["key"]), ("w", "A", "key", "Int", ["id"])] * 300))
    assert {(r.coordinate, r.negative) for r in got.collect()} == {("A.id", "A.key"), ("A.key", "A.id")}
    joined = spark._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "simple").split("Join", 1)[1]
    assert joined.count("Aggregate") >= 4  # both sides are distinct before they meet


def test_competition_prefers_described_owners(spark):
    rows = [("w", f"O{i}", "status", "String", []) for i in range(20)]
    df = coords(spark, rows).selectExpr("*", "case when owner_type in ('O1', 'O2', 'O3') then 'told' else ' ' end as owner_description")
    got = planning.competition_sets(df, 6).collect()
    by = {}
    for r in sorted(got, key=lambda r: r.place):
        by.setdefault(r.coordinate, []).append(r.rival)
    assert len(by) == 20
    for c, rivals in by.items():
        assert rivals[0] == c and len(rivals) == len(set(rivals)) == 6
        others = [f"O{i}.status" for i in (1, 2, 3) if f"O{i}.status" != c]
        assert sorted(rivals[1 : 1 + len(others)]) == others


def test_training_pairs_fill_from_the_world(spark):
    df = spark.createDataFrame([(i, "w") for i in range(40)] + [(100, "v"), (101, "v")], "doc_id long, world_id string")
    ranked = spark.createDataFrame([(0, 1, 5), (0, 2, 5), (0, 3, 0)], "doc_id long, place int, negative long")
    got = {r.doc_id: (r.negative_1, r.negative_2, r.negative_3) for r in planning.training_pairs(df, ranked).collect()}
    assert set(got) == set(range(40)) and got[0][0] == 5
    assert all(len({d, *n}) == 4 for d, n in got.items())


def test_back_fill_and_mock_responses(spark):
    plan = spark.createDataFrame([("w", 0, 7, 3), ("w", 1, 8, 3)], "world_id string, batch_no int, doc_id long, requested int")
    worlds = spark.createDataFrame([("w",), ("v",)], "world_id string")
    full = planning.back_fill(plan, 10, 3, worlds=worlds)
    got = sorted((r.world_id, r.batch_no, r.doc_id or 0, r.requested) for r in full.collect())
    assert got == [("v", 0, 0, 3), ("v", 1, 0, 3), ("v", 2, 0, 3), ("v", 3, 0, 1), ("w", 0, 7, 3), ("w", 1, 8, 3), ("w", 2, 0, 3), ("w", 3, 0, 1)]
    answers = spark.createDataFrame([(0, "a"), (1, "b")], "place int, response string")
    told = planning.mock_responses(full.selectExpr("*", "case when world_id = 'v' then 1 else 0 end as world_index"), answers).collect()
    assert {(r.world_id, r.batch_no): r.response for r in told}[("v", 0)] == "b" and {(r.world_id, r.batch_no): r.response for r in told}[("w", 2)] == "a"


def test_pair_texts(spark):
    docs = spark.createDataFrame([(f"A.f{i}", [f"v{i}", f"u{i}"], f"t{i}") for i in range(8)], "coordinate string, views array<string>, text string")
    q = spark.createDataFrame([("1", "ask", "A.f1", [], ["A.f2", "A.f2", "No.x", "A.f1"]), ("2", "no", "No.y", ["No.z"], []), ("3", "two", "A.f0", ["No.z", "A.f4"], [])], "query_id string, query string, positive_coordinate string, relevant_coordinates array<string>, negative_coordinates array<string>")
    got = {r.query_id: r for r in planning.pair_texts(q, docs).collect()}
    assert set(got) == {"1", "3"} and got["1"].positive in ("v1", "u1") and got["1"].negative == "t2" and got["3"].positive in ("v4", "u4") and got["3"].negative not in ("t4", None)
    many = {r.query_id: r for r in planning.pair_texts(q, docs, "mnrl", 3).collect()}
    assert many["1"].negative_1 == "t2" and len({many["1"].negative_1, many["1"].negative_2, many["1"].negative_3, "t1"}) == 4
    assert planning.pair_texts(q, docs, "mnrl", 9).count() == 0


def test_stratified_groups(spark):
    items = spark.createDataFrame([(i, "w", 0) for i in range(40)], "item long, world_id string, comp_set int")
    rows = [(i, d, s, d == 0) for i in range(40) for d, s in ((0, 0.5), (1, 0.9 if i < 22 else 0.49 if i < 34 else 0.1))]
    got = mining.mine_groups(items, spark.createDataFrame(rows, "item long, doc_id long, sim double, is_target boolean")).collect()
    assert Counter(r.bucket for r in got) == {"hard": 22, "medium": 12, "easy": 6}
    assert all((r.base_wrong == 1) == (r.bucket == "hard") for r in got)
    counts = {r.bucket: r.n for r in mining.bucket_counts(spark.createDataFrame([("hard",)], "bucket string")).collect()}
    assert counts == {"hard": 1, "medium": 0, "easy": 0}


def test_running_sums_of_a_hot_group(spark):
    """A group far larger than the others, null groups, null amounts and equal keys: the sums of a plain loop."""
    rows = [(i, "hot" if i < 3000 else None if i < 3010 else f"g{i % 7}", None if i % 11 == 0 else i % 4) for i in range(3100)]
    key = lambda i: hashlib.md5(f"5|{i // 2}".encode()).hexdigest()
    df = spark.createDataFrame(rows, "i long, g string, want long").repartition(5)
    got = mining.before(df, ["g"], choice_key("5", F.floor(F.col("i") / 2)), "i", {"place": F.lit(1), "had": F.col("want")})
    assert got.columns == ["i", "g", "want", "place", "had", "place_all", "had_all"]
    want, place, had = set(), Counter(), Counter()
    for i, g, w in sorted((r for r in rows if r[1] is not None), key=lambda r: (key(r[0]), r[0])):
        want.add((i, g, w, place[g], had[g]))
        place[g] += 1
        had[g] += w or 0
    assert {tuple(r) for r in got.collect()} == {(*r, place[r[1]], had[r[1]]) for r in want}
    assert mining.before(df.limit(0), ["g"], choice_key("5", F.col("i")), "i", {"place": F.lit(1)}).count() == 0


def test_batch_plan_of_null_worlds(spark):
    """Null worlds share one budget, and a boosted source has more of it."""
    rows = [(i, None if i < 40 else "w", 2, "real" if i % 2 else "made") for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, world_id string, requested long, source string")
    got = planning.batch_plan(df, 11).collect()
    for world in (None, "w"):
        own = sorted((r for r in got if r.world_id == world), key=lambda r: r.batch_no)
        ids = sorted((r[0] for r in rows if r[1] == world), key=lambda i: hashlib.md5(f"5|{i}".encode()).hexdigest())
        assert [(r.batch_no, r.doc_id, r.requested) for r in own] == [(n, i, 1 if n == 5 else 2) for n, i in enumerate(ids[:6])]
    more = planning.batch_plan(df, 11, boost={"real": 3}).collect()
    assert all(sum(r.requested for r in more if r.world_id == w and r.doc_id % 2) > sum(r.requested for r in got if r.world_id == w and r.doc_id % 2) for w in (None, "w"))
