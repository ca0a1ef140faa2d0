import random

import pytest

import brute
import edge
from fieldloom.llm.components import connected_components
from fieldloom.llm.near_dedup import near_duplicates


def check(df, rows, k=3, share=85, **more):
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(df, k, share, **more).collect()}
    assert got == brute.near(rows, k, share)


@pytest.mark.parametrize("which", ["table", "edge", "empty"])
def test_near(spark, small, which):
    df = spark.read.parquet(f"{small}/documents.parquet") if which == "table" else edge.documents(spark)
    df = df.limit(0) if which == "empty" else df
    check(df, [(r.doc_id, r.text) for r in df.collect()])


@pytest.mark.parametrize(("heads", "k", "share"), [(1, 3, 85), (4, 5, 80)])
def test_near_large_group(spark, heads, k, share):
    """Edits of one text: some link directly, some only through others, some not at all; and chains."""
    rnd = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(60):
        words = list(base)
        for _ in range(rnd.choice([0, 1, 1, 2, 3, 4, 8])):
            words[rnd.randrange(120)] = f"x{rnd.randrange(5)}"
        rows.append((1000 - i, " ".join(words)))
    chain = list(base)
    for i in range(15):
        chain[i * 3] = "y"
        rows.append((2000 + i, " ".join(chain)))
    rows += [(1, None), (2, ""), (3, "Tiny Text"), (4, "tiny\ttext"), (5, "tiny text too")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    check(df, rows, k, share, heads=heads)


def test_components(spark):
    rnd = random.Random(5)
    links = [(i, i + 1) for i in range(100, 160)] + [(rnd.randrange(1000, 1300), rnd.randrange(1000, 1300)) for _ in range(200)] + [(7, x) for x in range(2000, 2100)] + [(1, 1)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = dict(map(tuple, connected_components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {n: find(n) for n in parent if find(n) != n}


def test_texts_longer_than_a_chunk(spark):
    """Forty thousand words, with a tenth changed and with a half; and rows that repeat an id."""
    rnd = random.Random(8)
    words = [f"w{rnd.randrange(9000)}" for _ in range(40_000)]
    near, far = list(words), list(words)
    for i in range(0, 400, 4):
        near[i * 100] = "x"
    for i in range(0, 40_000, 5):
        far[i] = "y"
    rows = [(1, " ".join(words)), (2, " ".join(near)), (3, " ".join(far)), (4, " ".join(words[:100]))]
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows)
    assert brute.near(rows)[2][1] == 1 and brute.near(rows)[3][1] == 3
