"""Soft-membership mixing: document rates whose expected domain tokens meet target weights.

A softmax classifier, taught by the labelled table, gives each document's
posterior over the domains. Rates r >= 0 minimise ``|sum r_d t_d P_d - target|^2``
(t: tokens) by projected gradient: a document moves by its posterior times the
residual of the domain totals, scaled by the inverse of the token-weighted Gram
matrix of the posteriors of documents whose rate isn't nought, and rates under
nought become nought. A step that makes the residual larger is halved. A step
needs only the totals and that matrix from the cluster, and rates are a function
of the posterior and the steps so far, a few numbers each, which are what the
tasks get; there is no state between passes.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from fieldloom.llm.common import materialize, per_batch
from fieldloom.llm.toxicity import fitted

#: Domain (a value of the label) -> its share of the tokens.
TARGETS = {0: 0.03, 1: 0.97}
BAG, STEPS, CLOSE, RIDGE = 256, 30, 1e-5, 1e-6
#: Bytes that count as digits, capitals, symbols.
KINDS = [np.array([chr(b) in own for b in range(128)] + [False] * 128) for own in ("0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "#$%&*+/<=>@[\\]^`{|}~")]


def shape(text: str, known: dict) -> np.ndarray:
    """Features of a text: shares and spreads of its words and lines, and a hashed bag of words."""
    words = text.split()
    n = len(words)
    bag = np.bincount([known[w] for w in words], minlength=BAG).astype(np.float64) if n else np.zeros(BAG)
    lines = [x for x in text.split("\n") if x.strip()]
    chars = max(1, len(text))
    found = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=256)
    digits, capitals, symbols = (int(found[k].sum()) for k in KINDS)
    own = [math.log1p(n), len(set(words)) / max(1, n), sum(map(len, words)) / max(1, n) / 10, symbols / chars * 10, digits / chars * 10, capitals / chars * 10, len(set(lines)) / max(1, len(lines)), math.log1p(len(lines)) / 5, text.count("!") / chars * 20, max(map(len, words), default=0) / 50]
    grams = max(1, n - 2)
    own.append(len(set(zip(words, words[1:], words[2:], strict=False))) / grams if n > 2 else 1.0)
    return np.concatenate([[1.0], own, bag / max(1.0, np.linalg.norm(bag))])


def bag_slots() -> dict:
    import xxhash

    class Known(dict):
        def __missing__(self, word: str) -> int:
            if len(self) > 250_000:
                self.clear()
            self[word] = got = xxhash.xxh3_64_intdigest(word) % BAG
            return got

    return Known()


@dataclass
class Classifier:
    domains: list[int]
    weights: np.ndarray  # features by domains
    scale: np.ndarray

    def posterior(self, x: np.ndarray) -> np.ndarray:
        z = (x / self.scale) @ self.weights
        z = np.exp(z - z.max(axis=-1, keepdims=True))
        return z / z.sum(axis=-1, keepdims=True)


def fit(rows: list[tuple[str, int, float]], domains: list[int], epochs: int = 400, l2: float = 1e-4) -> Classifier:
    """Softmax regression; without rows every posterior is even, and a domain without rows gets a small one."""
    known = bag_slots()
    rows = [r for r in rows if r[1] in domains]
    if not rows:
        return Classifier(domains, np.zeros((BAG + 12, len(domains))), np.ones(BAG + 12))
    x = np.stack([shape(t, known) for t, _, _ in rows])
    scale = np.maximum(x.std(axis=0), 1e-3)
    scale[0] = 1.0
    x = x / scale
    y = np.zeros((len(rows), len(domains)))
    y[np.arange(len(rows)), [domains.index(r[1]) for r in rows]] = 1
    w = np.array([r[2] for r in rows])[:, None]
    w = w / w.sum()
    theta = np.zeros((x.shape[1], len(domains)))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for e in range(1, epochs + 1):
        z = np.exp((q := x @ theta) - q.max(axis=1, keepdims=True))
        g = x.T @ (w * (z / z.sum(axis=1, keepdims=True) - y)) + l2 * theta
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta -= 0.03 * (m / (1 - 0.9**e)) / (np.sqrt(v / (1 - 0.999**e)) + 1e-8)
    return Classifier(domains, theta, scale)


def memberships(docs: DataFrame, model: Classifier) -> DataFrame:
    """docs with _fl_tokens and _fl_posterior (array<double>) as last columns; tokens are white-space words."""
    place = docs.columns.index("text")

    def make():
        known = bag_slots()

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [v.as_py() or "" for v in batch.column(place)]
            rows = model.posterior(np.array([shape(t, known) for t in texts])).tolist() if texts else []
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array([len(t.split()) for t in texts], pa.int64()), pa.array(rows, pa.list_(pa.float64()))], names=[*batch.schema.names, "_fl_tokens", "_fl_posterior"])

        return one

    schema = StructType([*docs.schema.fields, StructField("_fl_tokens", LongType()), StructField("_fl_posterior", ArrayType(DoubleType()))])
    return docs.mapInArrow(per_batch(make), schema)


def rates_of(p: np.ndarray, steps: list[list[float]]) -> np.ndarray:
    """The rates after the steps, from rate one: a step is the domains' multipliers of a projected move."""
    r = np.ones(len(p))
    for m in steps:
        r = np.maximum(0.0, r - p @ np.array(m))
    return r


def _totals(own: DataFrame, steps: list[list[float]], k: int) -> tuple[np.ndarray, np.ndarray]:
    """The expected tokens of each domain after the steps, and the Gram matrix over documents that have a rate."""

    def make():
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            t = batch.column(0).to_numpy(zero_copy_only=False).astype(np.float64)
            p = batch.column(1).flatten().to_numpy().reshape(-1, k)
            r = rates_of(p, steps)
            s = (p * np.where(r > 0, t, 0.0)[:, None]).T @ p
            return pa.RecordBatch.from_arrays([pa.array([[*((r * t) @ p).tolist(), *s.ravel().tolist()]], pa.list_(pa.float64()))], names=["x"])

        return one

    n = k + k * k
    row = own.select("_fl_tokens", "_fl_posterior").mapInArrow(per_batch(make), "x array<double>").agg(*(F.coalesce(F.sum(F.get("x", F.lit(i))), F.lit(0.0)) for i in range(n))).first()
    got = np.array(row, np.float64)
    return got[:k], got[k:].reshape(k, k)


def fit_rates(own: DataFrame, targets: list[float], most: int = STEPS, close: float = CLOSE) -> tuple[list[list[float]], float]:
    """Steps of projected gradient, and the residual share that the rates after them leave.

    It ends when the residual is under ``close``, when a step no longer lowers
    the sum of squares by a thousandth of ``close``, or after ``most`` passes.
    """
    k = len(targets)
    a, gram = _totals(own, [], k)
    total = a.sum()  # rates of one: all tokens
    if total <= 0:
        return [], 0.0
    goal = np.array(targets) / sum(targets) * total
    steps: list[list[float]] = []
    scale = 1.0
    for _ in range(most):
        if np.abs(a - goal).sum() / total < close:
            break
        ridge = RIDGE * max(np.trace(gram), 1.0) / k * np.eye(k)
        step = (scale * np.linalg.solve(gram + ridge, a - goal)).tolist()
        after, its = _totals(own, [*steps, step], k)
        gain = np.square(a - goal).sum() - np.square(after - goal).sum()
        if gain < 0:
            scale /= 2
            continue
        steps, a, gram, scale = [*steps, step], after, its, min(1.0, 2 * scale)
        if gain < (1e-3 * close * total) ** 2:
            break
    return steps, float(np.abs(a - goal).sum() / total)


def _fitted(docs: DataFrame, labels: DataFrame, targets: dict[int, float] | None, column: str, keep: list[str]) -> tuple[DataFrame, list[list[float]], float, int]:
    targets = targets or TARGETS
    domains = sorted(targets)
    model = Classifier(**fitted(docs, labels, column, lambda rows: vars(fit(rows, domains)), values=domains))
    own = materialize(memberships(docs, model).select(*keep, "_fl_tokens", "_fl_posterior"), "memberships")
    return own, *fit_rates(own, [targets[d] for d in domains]), len(domains)


def _part(doc_id: str, text: str):
    """A share of one by the row's id and text: what a rate is rounded by."""
    return F.pmod(F.xxhash64(doc_id, text), F.lit(1 << 30)) / float(1 << 30)


def mix(docs: DataFrame, labels: DataFrame, targets: dict[int, float] | None = None, column: str = "quality") -> DataFrame:
    """doc_id, n_tokens, posterior, rate, copies of every row.

    ``copies`` is the rate rounded up or down by a hash of the id and text, so
    its mean is the rate. Null and empty texts have no tokens and a rate as
    others of their posterior. Targets out of the posteriors' reach are met as
    nearly as least squares can; the share of tokens by which the rates miss
    them is the ``residual`` in the metadata of ``rate``. A domain without
    labels is never predicted. Repeated rows, of one doc_id or none, count each
    by their own text; an empty table gives no rows. Other columns are not read.
    """
    plain = docs.select("doc_id", "text")
    own, steps, left, k = _fitted(plain.withColumn("_fl_part", _part("doc_id", "text")), labels, targets, column, ["doc_id", "_fl_part"])

    def make():
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            p = batch.column(3).flatten().to_numpy().reshape(-1, k)
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(rates_of(p, steps))], names=["doc_id", "part", "n_tokens", "posterior", "rate"])

        return one

    kind = dict(own.dtypes)["doc_id"]
    out = own.select("doc_id", "_fl_part", "_fl_tokens", "_fl_posterior").mapInArrow(per_batch(make), f"doc_id {kind}, part double, n_tokens long, posterior array<double>, rate double")
    out = out.withMetadata("rate", {"residual": left})
    return out.select("doc_id", "n_tokens", "posterior", "rate", F.floor(F.col("rate") + F.col("part")).cast("int").alias("copies"))


def mix_documents(docs: DataFrame, labels: DataFrame, targets: dict[int, float] | None = None, column: str = "quality") -> DataFrame:
    """The rows of docs, each as often as its copies say, with their columns.

    The texts are written once beside their posteriors and are not shuffled.
    Rows are rated each by its own text, whatever rows share their doc_id; see
    mix for nulls and empty texts. An empty table stays empty.
    """
    own, steps, _, k = _fitted(docs.withColumn("_fl_part", _part("doc_id", "text")), labels, targets, column, [*docs.columns, "_fl_part"])
    names = docs.columns
    n = len(names)

    def make():
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            p = batch.column(n + 2).flatten().to_numpy().reshape(-1, k)
            copies = np.floor(rates_of(p, steps) + batch.column(n).to_numpy(zero_copy_only=False)).astype(np.int64)
            return pa.RecordBatch.from_arrays(batch.columns[:n], names=names).take(pa.array(np.repeat(np.arange(len(copies)), copies)))

        return one

    return own.mapInArrow(per_batch(make), docs.schema)
