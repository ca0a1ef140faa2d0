import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from fieldloom.llm import mixing, toxicity

WORDS = {0: "alpha beta gamma delta", 1: "river stone cloud meadow", 2: "engine piston valve gasket"}


def tables(spark):
    rnd = random.Random(3)
    rows = [(i, " ".join(rnd.choice(WORDS[i % 3].split()) for _ in range(30))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs, spark.createDataFrame([(i, i % 3) for i, _ in rows], "doc_id long, quality int")


def test_three_domains(spark):
    docs, labels = tables(spark)
    df = mixing.mix(docs, labels, {0: 0.2, 1: 0.3, 2: 0.5})
    rows = df.collect()
    p, rate = np.array([r.posterior for r in rows]), np.array([r.rate for r in rows])
    t = np.array([r.n_tokens for r in rows], float)
    assert all(r.posterior[r.doc_id % 3] > 0.5 for r in rows)
    got = (rate * t) @ p / t.sum()
    assert np.abs(got - [0.2, 0.3, 0.5]).sum() < 1e-3
    assert abs(df.schema["rate"].metadata["residual"] - np.abs(got - [0.2, 0.3, 0.5]).sum()) < 1e-9


def test_residual_of_unmet_targets(spark):
    docs, labels = tables(spark)
    df = mixing.mix(docs.filter("doc_id % 3 <> 2"), labels, {0: 0.2, 1: 0.3, 2: 0.5})
    assert df.schema["rate"].metadata["residual"] > 0.1


def test_labelled_sample_values_and_votes(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(40)], "doc_id long, text string")
    own = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5]
    stray, mixed, rest = own[0], own[1], own[2:]
    rows = [(stray, -1)] + [(mixed, x) for x in (0, 2, 2, 0, 2)] + [(i, i % 2) for i in rest]
    labels = spark.createDataFrame(rows, "doc_id long, toxic int")
    two = {t: y for t, y, _ in toxicity.labelled_sample(docs, labels, "toxic")}
    assert two == {f"text {i}": i % 2 for i in rest}
    three = {t: y for t, y, _ in toxicity.labelled_sample(docs, labels, "toxic", values=(0, 1, 2))}
    assert three == two | {f"text {mixed}": 2}


def dense(p, t, goal):
    """Least squares with rates of nought or more, by plain projected gradient on all rows."""
    a = p * t[:, None]
    r = np.ones(len(t))
    top = np.linalg.eigvalsh((p * t[:, None]).T @ p)[-1]
    for _ in range(20000):
        r = np.maximum(0.0, r - p @ (r @ a - goal) / top)
    return r, np.abs(r @ a - goal).sum() / t.sum()


def test_targets_far_from_the_natural_shares(spark):
    """Rates of nought and above two, as a dense solver leaves the same residual."""
    docs, labels = tables(spark)
    rows = mixing.mix(docs, labels, {0: 0.0, 1: 0.1, 2: 0.9}).collect()
    p, rate, t = np.array([r.posterior for r in rows]), np.array([r.rate for r in rows]), np.array([r.n_tokens for r in rows], float)
    goal = np.array([0.0, 0.1, 0.9]) * t.sum()
    _, left = dense(p, t, goal)
    got = np.abs((rate * t) @ p - goal).sum() / t.sum()
    assert got <= left + 1e-3 and (rate >= 0).all()
    assert all(r.rate < 0.05 for r in rows if r.doc_id % 3 == 0) and all(r.rate > 2 for r in rows if r.doc_id % 3 == 2)


def test_copies_of_rows_that_repeat_an_id(spark):
    docs, labels = tables(spark)
    again = docs.withColumn("doc_id", F.when(F.col("doc_id") % 3 == 0, F.lit(None)).otherwise(F.lit(5))).withColumn("rate", F.lit("again"))
    more = docs.withColumn("rate", F.lit("taught")).unionByName(again)
    out = mixing.mix_documents(more, labels, {0: 0.0, 1: 0.1, 2: 0.9})
    assert out.columns == more.columns
    n = {None: 0, 5: 0}
    for r in out.filter("rate = 'again'").collect():
        n[r.doc_id] += 1
    assert n[None] <= 3 and 200 < n[5] < 400
