import public_tokenizers
import pytest
from tokenizers import Tokenizer

import brute
import edge
from fieldloom.llm import queries
from fieldloom.llm.chat import format_windows, read_windows
from fieldloom.llm.exact_dedup import drop_exact_duplicates, exact_duplicates
from fieldloom.llm.packing import pack
from fieldloom.llm.quality import quality_rules
from fieldloom.llm.secrets import scan_secrets
from fieldloom.llm.url_filter import Automaton, judge_urls


def docs_of(spark, small):
    df = spark.read.parquet(f"{small}/documents.parquet")
    return df, [(r.doc_id, r.text) for r in df.collect()]


@pytest.fixture(params=["table", "edge", "empty"])
def docs(request, spark, small):
    if request.param == "table":
        return docs_of(spark, small)
    df = edge.documents(spark)
    return (df, edge.texts()) if request.param == "edge" else (df.limit(0), [])


def test_exact(docs):
    df, rows = docs
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_duplicates(df).collect()}
    assert got == brute.exact(rows)
    kept = drop_exact_duplicates(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == sorted(d for d, v in got.items() if v[2])


def test_exact_hot_group(spark):
    df = spark.range(5000).selectExpr("id as doc_id", "case when id % 3 = 0 then 'hot text' else concat('t', id % 1000) end as text").repartition(7)
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact_duplicates(df, fan_in=2).collect()}
    want = brute.exact([(r.doc_id, r.text) for r in df.collect()])
    assert got == {d: v[:2] for d, v in want.items()}


def test_quality(docs):
    df, rows = docs
    got = {r.doc_id: r for r in quality_rules(df).collect()}
    assert len(got) == len(rows)
    for d, t in rows:
        r = got[d]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.counts(t), d
        assert not (r.base_failed and r.kept)


def test_quality_hash_collisions(spark, monkeypatch):
    from fieldloom.llm import quality

    monkeypatch.setattr(quality, "POS_BITS", 60)  # four bits of hash: most windows collide
    rows = [(1, " ".join(f"w{i % 37}" for i in range(60))), (2, " ".join(f"v{i}" for i in range(60))), (3, "a b")]
    df = spark.createDataFrame([(*r, "en", "s") for r in rows], "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r.n_repeat_words for r in quality.text_counts(df).collect()}
    assert got == {d: brute.counts(t)[4] for d, t in rows}


def test_quality_of_texts_beyond_the_places(spark, monkeypatch):
    """Texts of more words than the packed places can hold give the same counts."""
    from fieldloom.llm import quality

    monkeypatch.setattr(quality, "POS_BITS", 4)  # sixteen words and more are beyond it
    rows = [(1, " ".join(f"w{i % 37}" for i in range(120))), (2, "a b c a b c"), (2, " ".join(f"v{i}" for i in range(60))), (None, None)]
    df = spark.createDataFrame([(*r, "en", "s") for r in rows], "doc_id long, text string, lang string, source string")
    got = sorted((r.doc_id or 0, r.n_words, r.n_repeat_words) for r in quality.text_counts(df).collect())
    assert got == sorted((d or 0, brute.counts(t)[0], brute.counts(t)[4]) for d, t in rows)


def test_rows_that_repeat_an_id(spark):
    """op3, op4, op5, op6, op9: every row is judged by its own text."""
    rows = [(1, "password=hunter22 here"), (1, "plain words"), (1, "plain  words"), (None, None), (None, "plain words")]
    df = spark.createDataFrame([(*r, None, None) for r in rows], "doc_id long, text string, lang string, source string")
    assert sorted(r.n_words for r in quality_rules(df).collect()) == [0, 2, 2, 2, 2]
    assert sorted((r.doc_id or 0, r.length) for r in pack(df).collect())[0] == (0, 1) and pack(df).count() == 5
    got = exact_duplicates(df).collect()
    assert sorted((r.doc_id or 0, r.keep_id or 0, r.group_size, r.kept) for r in got) == [(0, 0, 1, True), (0, 1, 3, False), (1, 1, 1, True), (1, 1, 3, True), (1, 1, 3, True)]
    assert sorted((r.doc_id or 0, len(r.spans)) for r in scan_secrets(df).collect()) == [(0, 0), (0, 0), (1, 0), (1, 0), (1, 1)]


def test_chat_of_no_rows(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert read_windows(format_windows(df)).count() == 0


def test_urls(spark, small):
    rows = [(r.page_id, r.url) for r in spark.read.parquet(f"{small}/pages.parquet").collect()]
    odd = [None, "", "no scheme", "http://", "HTTP://WWW.Example.ORG/es/x?y#z", "http://example.org/en/1", "http://xexample.org/en/1", "http://a.com/b.org/", "http://org", "http://org/", "http://x.com?u=/fr/", "http://x.com/fr/#/de/", "a://b://c.org/es/", "http://ÉX.org/", "http://spam-farm.example.net/x"]
    rows += [(-1 - i, u) for i, u in enumerate(odd)]
    got = {r.page_id: r for r in judge_urls(spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "1 as host", "2 as rule")).collect()}
    assert len(got) == len(rows)
    for k, u in rows:
        host, path = brute.url(u)
        name, verdict = brute.rule(host, path)
        assert (got[k].host, got[k].path, got[k].rule) == (host, path, name), u
        assert got[k].verdict == verdict if verdict else got[k].verdict in ("allow", "block")
    assert got[-15].verdict == "block" and got[-4].verdict == "allow"
    assert judge_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_automaton_many_words():
    import random
    import re

    rnd = random.Random(1)
    globs = ["".join(rnd.choice(["a", "b", "/", "*", "**", "?"]) for _ in range(rnd.randint(1, 9))) for _ in range(60)]
    texts = ["".join(rnd.choice("ab/") for _ in range(rnd.randint(0, 12))) for _ in range(300)]
    like = [re.compile("".join({"**": ".*", "*": "[^/]*", "?": "[^/]"}.get(p, re.escape(p)) for p in re.findall(r"\*\*|\*|\?|.", g)), re.S) for g in globs]
    hit = Automaton(globs).match([t.encode() for t in texts])
    assert Automaton(globs).words > 3
    assert hit.tolist() == [[bool(r.fullmatch(t)) for r in like] for t in texts]


def test_rules_from_a_table_in_tiles(spark):
    """Many rules over several tiles: the first that matches holds, and ties of equal base rules go to the earlier."""
    from fieldloom.llm.url_filter import Rule, first_match, match_all, rules_of

    table = spark.range(500).selectExpr("id as place", "case when id % 2 = 0 then 'block' else 'allow' end as verdict", "concat('**/p', id, '/**') as glob")
    extra = rules_of(table)
    assert len(extra) == 500 and len(match_all([g for _, g in extra], 256)) > 10
    texts = [f".a.b/p{i}/x/p{j}/".encode() for i, j in ((3, 400), (400, 3), (499, 499), (777, 778))]
    assert first_match(match_all([g for _, g in extra], 256), texts, 500).tolist() == [3, 3, 499, 500]
    df = spark.createDataFrame([(1, "http://a.b/p8/x"), (1, "http://a.b/p7/x"), (None, None), (2, "")], "page_id long, url string")
    assert sorted((r.page_id or 0, r.verdict) for r in judge_urls(df, extra=extra).collect()) == [(0, "allow"), (1, "allow"), (1, "block"), (2, "allow")]
    tied = judge_urls(df, rules=(Rule("block", "a.b", "/p8"), Rule("allow", "a.b", "/p8")))
    assert [r.verdict for r in tied.filter("rule is not null").collect()] == ["block"]


def test_secrets(docs, spark, small):
    df, rows = docs
    got = {r.doc_id: [f"{s.kind}:{s.start}:{s.end}" for s in r.spans] for r in scan_secrets(df).collect()}
    assert len(got) == len(rows)
    for d, t in rows:
        assert [s for s in got[d] if not s.startswith("random")] == brute.secrets(t), d


def test_secrets_random_strings(spark):
    key, uuid, digest = "sk9QzX7Lp2Vw8RkT4mYb1NcE", "123e4567-e89b-12d3-a456-426614174000", "D41D8CD98F00B204E9800998ECF8427E"
    rows = [(1, f"x {key} y"), (2, uuid), (3, digest), (4, "release_candidate_2024_final_build"), (5, "01234567890123456789012"), (6, f"token={key}")]
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in scan_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: [("random", 2, 26)], 2: [], 3: [], 4: [], 5: [], 6: [("assign", 0, 30)]}


def test_random_strings_precision_and_recall():
    """Random strings of several alphabets against names, paths, numbers and long words."""
    import random

    from fieldloom.llm.secrets import LEAST_CHARS_A_TOKEN, random_spans
    from fieldloom.llm.vocab import tiktoken_bpe

    rnd, bpe = random.Random(7), tiktoken_bpe()
    lower, upper, digit = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    random_ = ["".join(rnd.choice(a) for _ in range(rnd.randint(20, 44))) for a in (lower + upper + digit, lower + upper, lower + digit, upper + digit, lower, lower + upper + digit + "+/") for _ in range(300)]
    random_ += ["".join(rnd.choice(lower + upper + digit) for _ in range(rnd.randint(16, 19))) for _ in range(300)]
    words = "account archive balance button calendar change channel client column comment config connection content counter country currency customer database default delivery description document element entry error event export factory feature filter folder format function gateway handler header history identifier image import index instance invoice journal language layout listener location manager member message method module network notification number object operation option order package parameter partner password payment permission picture platform policy product profile project property provider query record reference region report request resource response result schedule schema section selector server service session setting shipment signal source status storage stream string summary support system table target template text thread ticket token transaction transfer update upload user value version warehouse window".split()
    pick = lambda n: [rnd.choice(words) for _ in range(n)]
    plain = ["".join(w.capitalize() for w in pick(4)) for _ in range(500)] + ["_".join(pick(3)) + str(rnd.randint(1, 2030)) for _ in range(500)] + ["/".join(pick(4)) for _ in range(300)] + ["-".join(pick(3)).upper() + "-2024" for _ in range(300)]
    plain += ["Geschwindigkeitsbegrenzung", "Bezirksschornsteinfegermeister", "internationalization", "anticonstitutionnellement", "20240131T235959000Z", "d41d8cd98f00b204e9800998ecf8427e", "123e4567-e89b-12d3-a456-426614174000", "====================", "01234567890123456789"]
    hit = lambda s: bool(random_spans(s, bpe, [], LEAST_CHARS_A_TOKEN))
    found, wrong = sum(map(hit, random_)), sum(map(hit, plain))
    assert found >= 0.95 * len(random_)
    assert found / (found + wrong) >= 0.95 and wrong <= 0.02 * len(plain), [s for s in plain if hit(s)][:9]


@pytest.mark.parametrize("carry", [8192, 2])
def test_packing(docs, carry):
    df, rows = docs
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = pack(df.repartition(5), carry=carry).collect()
    have = sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got)
    assert have == sorted((d, *p) for d, x in rows for p in brute.pieces([*t.encode(x or "", add_special_tokens=False).ids, 2]))
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 1024
    if carry > 2 and len(rows) > 100:
        assert len(bins) <= 1.035 * -(-sum(r.length for r in got) // 1024) + 1


def conversations(spark, small):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{small}/conversations.parquet").collect()]
    rows += [(-1, 0, "system", None), (-2, 0, "user", "<|turn|> <~ <|end|> <<||>>~<"), (-2, 1, "assistant", "<|end|><|turn|>assistant<|text|>x"), (-2, 1, "assistant", ""), (-2, 1, "assistant", ""), (None, None, None, None)]
    rows += [(-3, i, ("system", "user", "assistant")[0 if i == 0 else 1 + i % 2], f"w{i} " * (i * 37 % 400)) for i in range(40)]
    return rows


@pytest.mark.parametrize(("budget", "history"), [(512, 128), (100, 0), (5, 50)])
def test_chat(spark, small, budget, history):
    rows = conversations(spark, small)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as t", "2 as window").repartition(3)
    wins = format_windows(df, budget, history)
    got = {r.conv_id: r for r in read_windows(wins).collect()}
    by = {}
    for c, turn, role, text in rows:
        by.setdefault(c, []).append((turn if turn is not None else -1, role or "", text or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        want = brute.conversation([t[1:] for t in sorted(turns)])
        assert (got[c].n_turns, got[c].turns_sha256, got[c].loss_chars, got[c].loss_sha256) == want, c
    each = wins.collect()
    for c in by:
        assert got[c].formatted_chars == sum(len(w.formatted) for w in each if w.conv_id == c)
    if budget > history:
        assert all(w.n_tokens <= budget or w.formatted.count("<|turn|>") == 1 or w.window == 0 and w.formatted.count("<|turn|>") == 2 for w in each)


def test_queries_run(spark, small):
    got = queries.op5_chat_windows(spark, small).filter("conv_id = -7").collect()[0]
    assert (got.n_turns, got.turns_sha256, got.loss_chars, got.loss_sha256) == brute.conversation([("user", queries.PLANTED), ("assistant", queries.PLANTED)])
    r = queries.op9_secret_scan(spark, small).collect()
    assert all(x.base_sha256 == brute.sha(",".join(s for s in x.spans.split(",") if s and not s.startswith("random"))) for x in r)
