import os
import pickle
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
import edge
from fieldloom.llm import mixing, toxicity
from fieldloom.llm.repeats import Prefix, remove_repeats, sort_suffixes, stretches


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet("/root/testdata/sf0.01/labels.parquet")


def test_toxicity_held_out(docs, labels):
    got = {r.doc_id: r for r in toxicity.judge_toxicity(docs, labels).collect()}
    assert len(got) == docs.count()
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) and r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for d, r in got.items())
    test = [(got[d].score, t) for d, t in truth.items() if d in got and got[d].held_out]
    toxic, clean = [s for s, t in test if t], [s for s, t in test if not t]
    auc = np.mean([(a > b) + (a == b) / 2 for a in toxic for b in clean])
    assert auc > 0.8
    assert sum(s >= 0.5 for s in clean) <= 0.03 * len(clean)
    texts = {r.doc_id: r.text for r in docs.collect()}
    hit = [r for r in got.values() if r.predicted]
    assert hit and sum(any(w in texts[r.doc_id].lower()[s.start : s.upto] for s in r.offending for w in ("idiot", "moron", "trash", "scum", "pathetic", "stupid", "loser", "clown", "worthless", "disgusting", "achlich", "réeux")) for r in hit) > 0.5 * len(hit)


def test_toxicity_edges(spark, labels):
    df = edge.documents(spark)
    none = toxicity.judge_toxicity(df, labels.limit(0)).collect()
    assert len(none) == df.count() and not any(r.predicted for r in none)
    own = spark.createDataFrame([(i, 0, int(i == 17)) for i in range(1, 19)] + [(17, 0, 1), (None, None, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    assert toxicity.judge_toxicity(df, own).count() == df.count()
    assert toxicity.judge_toxicity(df.limit(0), labels).count() == 0


def test_long_clean_text():
    """Thousands of sentences without a weighted word don't add up to a toxic text."""
    weights = np.zeros(toxicity.SIZE, np.float32)
    weights[toxicity.features("idiot")] = 3
    m = toxicity.Model(-6.0, weights)
    clean, toxic = "a fine day. " * 20000, "you idiot."
    assert toxicity.above_background(m.logits(clean, m.word_weights())[0], m.bias) < 1e-9
    assert toxicity.above_background(m.logits(clean + toxic, m.word_weights())[0], m.bias) > 0.5


def test_drops_go_by_row(spark, labels):
    """Rows that repeat an id or have none: unique texts stay, of equal ones one does."""
    from fieldloom.llm.exact_dedup import drop_exact_duplicates
    from fieldloom.llm.near_dedup import drop_near_duplicates, near_duplicates

    text = " ".join(f"w{i}" for i in range(90))
    rows = [(1, text), (1, text), (2, "x y"), (2, text), (3, "another one"), (None, text), (None, "own"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as node", "2 as h", "3 as copies").repartition(3)
    want = sorted([(1, text), (2, "x y"), (3, "another one"), (0, "own"), (0, "")])
    for drop in (drop_exact_duplicates, drop_near_duplicates):
        out = drop(df)
        assert out.columns == df.columns
        assert sorted((r.doc_id or 0, r.text or "") for r in out.collect()) == want
    changed = text.replace("w89", "z")
    df = spark.createDataFrame([(7, changed), (7, "unlike all"), (7, text), (8, text), (9, None)], "doc_id long, text string")
    assert sorted(r.text or "" for r in drop_near_duplicates(df).collect()) in (sorted(["", "unlike all", text]), sorted(["", "unlike all", changed]))
    assert sorted((r.doc_id, r.component_id, r.n_shingles) for r in near_duplicates(df).collect()) == [(7, 7, 1), (7, 7, 86), (7, 7, 86), (8, 7, 86), (9, 9, 0)]
    bad = spark.createDataFrame([(1, "you idiot, you moron, you worthless scum."), (1, "a fine day"), (None, None)], "doc_id long, text string").withColumn("score", F.lit(1))
    real = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text", F.lit(0).alias("score"))
    all_labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    left = {(r.doc_id, r.text) for r in toxicity.drop_toxic(real.unionByName(bad), all_labels).filter("score = 1").collect()}
    assert left == {(1, "a fine day"), (None, None)}


def test_noisy_or():
    m = toxicity.Model(-3.0, np.zeros(toxicity.SIZE, np.float32))
    z, starts = m.logits("one two. three! four", m.word_weights())
    p = 1 / (1 + np.exp(3.0))
    assert starts == [0, 2, 3] and abs(toxicity.noisy_or(z) - (1 - (1 - p) ** 3)) < 1e-12


def test_mixing(docs, labels):
    rows = mixing.mix(docs, labels).collect()
    assert len(rows) == docs.count()
    t = np.array([r.n_tokens for r in rows], float)
    p = np.array([r.posterior for r in rows])
    rate = np.array([r.rate for r in rows])
    got = (rate * t) @ p
    goal = np.array([mixing.TARGETS[d] for d in sorted(mixing.TARGETS)]) * t.sum()
    assert (rate >= 0).all() and np.abs(got - goal).sum() < 1e-3 * t.sum()
    assert np.allclose(p.sum(axis=1), 1) and {r.doc_id: r.n_tokens for r in rows} == {r.doc_id: len((r.text or "").split()) for r in docs.collect()}
    assert all(r.copies in (int(np.floor(r.rate)), int(np.floor(r.rate)) + 1) for r in rows)


def test_mixing_edges(spark, labels):
    df = edge.documents(spark)
    assert mixing.mix(df, labels.limit(0)).count() == df.count()
    assert mixing.mix(df.limit(0), labels).count() == 0
    assert mixing.mix_documents(df.limit(0), labels).count() == 0
    out = mixing.mix_documents(df, labels, {0: 0.5, 1: 0.5})
    assert out.columns == df.columns


def check(df, rows, size=400, gram=200, **more):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in remove_repeats(df, size, gram, **more).collect()}
    assert got == brute.repeats(rows, size)


@pytest.mark.parametrize("which", ["table", "edge", "empty"])
def test_repeats(spark, small, which):
    df = spark.read.parquet(f"{small}/documents.parquet") if which == "table" else edge.documents(spark)
    df = df.limit(0) if which == "empty" else df
    check(df, [(r.doc_id, r.text) for r in df.collect()])


@pytest.mark.parametrize("most", [4096, 2])
def test_repeats_small_alphabet(spark, most):
    import random

    rnd = random.Random(2)
    bits = ["".join(rnd.choice("abé") for _ in range(rnd.randint(5, 60))) for _ in range(8)]
    rows = [(i, "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 9)))) for i in range(60)] + [(100, "a" * 90), (101, "a" * 41), (102, None)]
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), rows, 40, 20, most=most)


@pytest.mark.parametrize("chunk", [37, 500])
def test_repeats_in_chunks(spark, chunk):
    """Texts longer than a chunk: each window is in one, and stretches cut at a chunk's end still meet."""
    import random

    rnd = random.Random(5)
    part = ["".join(rnd.choice("abcdefgh") for _ in range(300)) for _ in range(4)]
    rows = [(1, part[0] + part[1] + part[2]), (2, part[3] + part[1] + part[0]), (3, part[2][:60] + part[2][:60]), (4, part[1][5:44])]
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows, 40, 20, chunk=chunk)


def test_repeats_rows_that_repeat_an_id(spark):
    text, other = "abcdefghij" * 9, "0123456789" * 7
    rows = [(1, text), (1, text), (1, other), (2, other), (None, text[:50]), (None, None), (3, "q" * 39)]
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_removed) for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), 40, 20).collect())
    assert got == [(0, 0, 0), (0, 50, 50), (1, 70, 70), (1, 90, 90), (1, 90, 90), (2, 70, 70), (3, 39, 0)]


def test_suffix_sort_without_a_usable_hash():
    """All strings of a length collide: order and extensions must come from the bytes."""
    rnd = np.random.default_rng(4)
    data = rnd.integers(97, 99, 900).astype(np.uint8)
    at, limit = np.arange(0, 880, 20), np.full(44, 20)
    group = np.repeat([3, 5], 22)
    prefix = Prefix()
    want = sort_suffixes(prefix, data, at, limit, group)
    prefix.code = np.ones(256, np.uint64)
    for order, ext in (want, sort_suffixes(prefix, data, at, limit, group)):
        text = [data[at[i] : at[i] + 20].tobytes() for i in order]
        assert text[:22] == sorted(text[:22]) and text[22:] == sorted(text[22:]) and ext[0] == ext[22] == -1
        for k in (*range(1, 22), *range(23, 44)):
            assert ext[k] == next((c for c in range(20) if text[k][c] != text[k - 1][c]), 20)


def test_stretches_cover_all_windows():
    data = np.random.default_rng(1).integers(0, 3, 5000).astype(np.uint8)
    lo, hi, _, _ = stretches(data, Prefix())
    assert [s for a, b in zip(lo, hi, strict=True) for s in range(a, b + 1)] == list(range(5000 - 399))


@pytest.mark.parametrize("rows", ["empty", "awkward"])
def test_pipeline_stages_on_awkward_rows(spark, small, rows):
    """No rows; null ids and texts, an id with several texts, equal rows, names that clash with the operators' own."""
    import corpus_pipeline

    text = " ".join(f"w{i}" for i in range(90))
    near = text.replace("w89", "z")
    data = [(1, text, "en", "s", 1), (1, text, "en", "s", 1), (2, "x y", "en", None, 1), (2, near, "de", "s", 1), (3, None, None, None, None), (None, "own words here", "en", "s", 1), (None, "own  words here", "en", "s", 1), (None, None, None, None, None)]
    left = spark.createDataFrame(data if rows == "awkward" else [], "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "'c' as copies", "'k' as kept", "1 as node", "2 as did")
    columns = left.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, left, small)
        assert left.columns == columns, name
        left = spark.createDataFrame(left.collect(), left.schema)
        if name == "near_dedup" and rows == "awkward":
            assert sorted((r.doc_id or 0, (r.text or "").replace("  ", " ")) for r in left.collect()) == sorted([(1, text), (2, "x y"), (3, ""), (0, "own words here")])
    packed = corpus_pipeline.STAGES[-1][1](spark, left, small)
    assert packed.count() == left.count()


def test_toxicity_of_rows_that_repeat_an_id(spark, docs, labels):
    bad = spark.createDataFrame([(5, "a fine day"), (5, "you idiot, you moron, you worthless scum."), (None, None), (None, "a fine day")], "doc_id long, text string")
    model = toxicity.fit(toxicity.labelled_sample(docs, labels, "toxic"))
    got = toxicity.score_documents(bad, model).collect()
    assert sorted((r.doc_id or 0, r.predicted) for r in got) == [(0, 0), (0, 0), (5, 0), (5, 1)]
    assert all(r.score < 1e-3 for r in got if r.doc_id is None)


def test_fits_leave_the_texts_to_a_task(docs, labels):
    """The driver neither collects the labelled texts nor fits on them, and gets the model it would have fitted."""
    rows = toxicity.labelled_sample(docs, labels, "toxic")
    here, there = toxicity.fit(rows), toxicity.taught(docs, labels, "toxic")
    assert here.bias == there.bias and (here.weights == there.weights).all() and there.weights.any()
    assert len(pickle.dumps(there)) < there.weights.nbytes / 8
    pid, same = toxicity.fitted(docs, labels, "toxic", lambda got: (os.getpid(), got))
    assert pid != os.getpid() and same == rows
    assert toxicity.fitted(docs, labels.limit(0), "toxic", len) == toxicity.fitted(docs.limit(0), labels, "toxic", len) == 0


@pytest.mark.parametrize("stage", ["toxicity", "mixing"])
def test_pipeline_collects_no_texts(spark, small, monkeypatch, stage):
    import corpus_pipeline

    def collected(*_, **__):
        raise AssertionError("the driver holds the labelled texts")

    for module in (toxicity, mixing):
        monkeypatch.setattr(module, "labelled_sample", collected, raising=False)
    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert dict(corpus_pipeline.STAGES)[stage](spark, docs, small).count()


def test_pipeline(spark, small):
    import corpus_pipeline

    docs = spark.read.parquet(f"{small}/documents.parquet")
    left = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, left, small)
        assert left.columns == docs.columns, name
        left = spark.createDataFrame(left.collect(), docs.schema)
        if name == "near_dedup":
            from fieldloom.llm.near_dedup import near_duplicates

            assert near_duplicates(left).filter("not kept").count() == 0
    got = corpus_pipeline.run(spark, small).collect()
    assert {r.doc_id for r in got} == {r.doc_id for r in left.collect()}
