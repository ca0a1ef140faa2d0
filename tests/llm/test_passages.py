"""Passages of over 50 words that several rows hold, against plain Python."""

import random
from collections import Counter

import brute
import edge
import pytest
from fieldloom.llm.passages import shared_passages
from fieldloom.llm.queries import op10_repeats
from fieldloom.llm.repeats import _keyed


def shared(rows, words):
    split = [[w for w in brute.WORD.findall(t or "")] for _, t in rows]
    grams = [[tuple(w[i : i + words]) for i in range(len(w) - words + 1)] for w in split]
    n = Counter(g for own in grams for g in set(own))
    return sorted((d or 0, len({j for i, g in enumerate(own) if n[g] > 1 for j in range(i, i + words)})) for (d, _), own in zip(rows, grams, strict=True))


def check(spark, rows, words, gram, chunk=1 << 18):
    keyed = _keyed(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    out = keyed.join(shared_passages(keyed, words, gram, chunk), ["did", "h"], "left").fillna(0, ["n_shared_words"])
    got = sorted((r.doc_id or 0, r.n_shared_words) for r in out.collect())
    assert got == shared(rows, words)
    return got


@pytest.mark.parametrize(("letters", "chunk"), [("ab", 1 << 18), ("abcdefghé", 1 << 18), ("abcdefghé", 13)])
def test_shared_passages(spark, letters, chunk):
    """Few words, so that anchors and windows repeat within a row and across rows; other white space; repeated and null ids."""
    rnd = random.Random(3)
    bits = [[rnd.choice(letters) * rnd.randint(1, 2) for _ in range(rnd.randint(3, 30))] for _ in range(9)]
    rows = [(i, "".join(w + rnd.choice([" ", "\n", " \t"]) for b in (rnd.choice(bits) for _ in range(rnd.randint(0, 7))) for w in b)) for i in range(50)]
    rows += [(100, "q " * 60), (101, "r " * 60), (101, "r  " * 15), (102, None), (None, "s t u v w " * 3), (None, "s t u v w " * 3), (7, "only once here " * 9)]
    got = check(spark, rows, 10, 4, chunk)
    assert (100, 0) in got and (7, 0) in got


def test_shared_passages_of_the_edge_rows(spark):
    check(spark, edge.texts(), 51, 16)
    assert shared_passages(_keyed(spark.createDataFrame([], "doc_id long, text string"))).count() == 0


def test_op10_reports_long_passages_of_few_bytes(spark, tmp_path):
    """51 words in 300 bytes or so: under the 400 bytes that are removed, but held by two rows."""
    rnd = random.Random(8)
    own = lambda n: " ".join("".join(rnd.choice("abcdefghij") for _ in range(5)) for _ in range(n))
    passage, shorter = own(51), own(50)
    rows = [(1, f"{own(40)} {passage} {own(9)}"), (2, f"{passage} {own(30)}"), (3, own(90)), (4, f"{own(30)} {shorter} {own(5)}"), (5, f"{own(3)} {shorter} {own(50)}"), (6, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.n_removed, r.n_shared_words) for r in op10_repeats(spark, str(tmp_path)).collect()}
    assert got == {1: (0, 51), 2: (0, 51), 3: (0, 0), 4: (0, 0), 5: (0, 0), 6: (0, 0)}
