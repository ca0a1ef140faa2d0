"""Toxicity by multiple-instance learning from document labels.

A sentence has a logistic score over hashed features of its words (the word and
its prefixes); a document is toxic if any sentence is, by noisy-or:
``p = 1 - prod(1 - p_sentence)``. Sentence weights are learned through that
formula from document labels alone, and then locate the offending sentences. A
run of ``longest`` words without an end mark is a sentence of its own, so texts
without punctuation stay a set of instances.
"""

from __future__ import annotations

import pickle
import re
from array import array
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import materialize, per_batch

TOKEN = re.compile(r"[^\W\d_]+|[.!?\n]")
ENDS = {".", "!", "?", "\n"}
LONGEST, PREFIXES, SIZE, LEAST_DOCS = 40, (4, 5, 6, 7), 1 << 20, 4
#: Bounds of the labelled sample: documents of each class, and characters of one of them.
PER_CLASS, MOST_CHARS = 3000, 60_000


def features(word: str) -> list[int]:
    import xxhash

    return [xxhash.xxh3_64_intdigest(f"={word}") % SIZE, *(xxhash.xxh3_64_intdigest(word[:n]) % SIZE for n in PREFIXES if len(word) >= n)]


def sentences(tokens: list[str], longest: int = LONGEST) -> tuple[list[str], list[int]]:
    """Words, and the place of each sentence's first; one empty sentence where there are no words."""
    words, starts = [], []
    fresh = True
    for t in tokens:
        if t in ENDS:
            fresh = True
        else:
            if fresh or len(words) - starts[-1] >= longest:
                starts.append(len(words))
                fresh = False
            words.append(t)
    return words, starts


@dataclass
class Model:
    bias: float
    weights: np.ndarray

    def __getstate__(self) -> tuple:
        """Few weights aren't nought: only those go to the tasks."""
        at = np.flatnonzero(self.weights).astype(np.int32)
        return self.bias, len(self.weights), at, self.weights[at]

    def __setstate__(self, state: tuple) -> None:
        self.bias, n, at, found = state
        self.weights = np.zeros(n, found.dtype)
        self.weights[at] = found

    def word_weights(self) -> dict:
        weights = self.weights

        class Known(dict):
            def __missing__(self, word: str) -> float:
                if len(self) > 250_000:
                    self.clear()
                self[word] = got = float(weights[features(word)].sum())
                return got

        return Known()

    def logits(self, text: str, known: dict) -> tuple[np.ndarray, list[int]]:
        words, starts = sentences(TOKEN.findall(text.lower()))
        if not words:
            return np.array([self.bias]), [0]
        w = np.fromiter(map(known.__getitem__, words), np.float64, len(words))
        return self.bias + np.add.reduceat(w, starts), starts


def noisy_or(z: np.ndarray) -> float:
    return float(-np.expm1(-np.logaddexp(0, z).sum()))


def above_background(z: np.ndarray, bias: float) -> float:
    """Noisy-or of what the sentences say beyond one without any weighted word, so that length alone adds nothing."""
    return float(-np.expm1(-(np.logaddexp(0, z) - np.logaddexp(0, bias)).sum()))


def fit(rows: list[tuple[str, int, float]], epochs: int = 200, rate: float = 0.15, l1: float = 1e-4) -> Model:
    """rows: text, label, weight. Without rows of both labels the model calls nothing toxic."""
    ids: dict[str, int] = {}
    word_of, sent_at, doc_at, seen = (array("q") for _ in range(4))
    at = n_sent = 0
    for d, (text, _, _) in enumerate(rows):
        words, starts = sentences(TOKEN.findall(text.lower()))
        doc_at.append(n_sent)
        sent_at.extend([at + s for s in starts] or [at])
        n_sent += len(starts) or 1
        words = words or [""]
        got = [ids.setdefault(w, len(ids)) for w in words]
        word_of.extend(got)
        at += len(got)
        seen.extend([0] * (len(ids) - len(seen)))
        for w in set(got):
            seen[w] += 1
    y = np.array([r[1] for r in rows], np.float64)
    if not len(y) or y.min() == y.max():
        return Model(-20.0, np.zeros(SIZE, np.float32))
    flat, per_word = array("q"), array("q")
    for w in ids:
        own = features(w) if w else []
        flat.extend(own)
        per_word.append(len(own))
    vi, vf = np.repeat(np.arange(len(ids)), np.array(per_word)), np.array(flat)
    n = np.array(seen)[vi]
    common = np.bincount(vf, n, SIZE) >= LEAST_DOCS
    vi, vf = vi[common[vf]], vf[common[vf]]
    used, vf = np.unique(vf, return_inverse=True)
    word_of, sent_at, doc_at = np.array(word_of), np.array(sent_at), np.array(doc_at)
    per_sent = np.diff(np.append(sent_at, len(word_of)))
    sent_doc = np.repeat(np.arange(len(rows)), np.diff(np.append(doc_at, n_sent)))
    weight = np.array([r[2] for r in rows])
    weight = weight / weight.sum()
    theta, bias = np.zeros(len(used)), -6.0
    m, v, mb, vb = np.zeros(len(used)), np.zeros(len(used)), 0.0, 0.0
    for epoch in range(1, epochs + 1):
        u = np.bincount(vi, theta[vf], len(ids))
        z = bias + np.add.reduceat(u[word_of], sent_at)
        s = np.add.reduceat(np.logaddexp(0, z), doc_at)
        p = -np.expm1(-s)
        d_s = weight * np.where(y > 0, -np.exp(-s) / np.maximum(p, 1e-9), 1.0)
        d_z = d_s[sent_doc] / (1 + np.exp(-z))
        d_u = np.bincount(word_of, np.repeat(d_z, per_sent), len(ids))
        g, gb = np.bincount(vf, d_u[vi], len(used)) + l1, d_z.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        c, e = 1 - 0.9**epoch, 1 - 0.999**epoch
        theta = np.maximum(0.0, theta - rate * (m / c) / (np.sqrt(v / e) + 1e-6))
        bias -= rate * (mb / c) / (np.sqrt(vb / e) + 1e-6)
    weights = np.zeros(SIZE, np.float32)
    weights[used] = theta
    return Model(float(bias), weights)


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def _sampled(docs: DataFrame, labels: DataFrame, column: str, per_class: int, most_chars: int, values: Sequence[int]) -> tuple[DataFrame | None, dict[int, int]]:
    """(doc_id, label, text) of labelled_sample's documents, None without any, and the labelled documents of each value."""
    votes = labels.filter(F.col(column).isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).groupBy("doc_id", F.col(column).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    voted = votes.groupBy("doc_id").agg(F.max_by("label", F.struct("n", "label")).alias("label")).filter(F.col("label").isin(*values)).withColumn("label", F.col("label").cast("int"))
    there = docs.filter(F.char_length(F.coalesce("text", F.lit(""))) <= most_chars).select("doc_id").distinct()
    own = materialize(voted.join(there, "doc_id"), "labelled")
    counts = {r["label"]: r["count"] for r in own.groupBy("label").count().collect()}  # a row a value
    ids = None
    for label in sorted(counts):
        part = own.filter(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        ids = part if ids is None else ids.unionByName(part)
    if ids is None:
        return None, counts
    # at most so many ids as values * per_class, and a row for each
    found = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").filter(F.char_length(F.coalesce("text", F.lit(""))) <= most_chars)
    return found.groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text")), counts


def _weighted(rows: Iterable[tuple[int, str | None]], counts: dict[int, int]) -> list[tuple[str, int, float]]:
    """(text, label, weight) of (label, text)."""
    rows = list(rows)
    got: dict[int, int] = {}
    for label, _ in rows:
        got[label] = got.get(label, 0) + 1
    return [(text or "", label, counts[label] / got[label]) for label, text in rows]


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, per_class: int = PER_CLASS, most_chars: int = MOST_CHARS, values: Sequence[int] = (0, 1)) -> list[tuple[str, int, float]]:
    """(text, label, weight) of at most ``per_class`` labelled documents of each of the values outside the held-out fifth.

    Documents are taken in the order of a hash of their id; the weight of a
    class makes up for what the bound leaves out. Of labels given several times
    the most frequent counts, of equally frequent ones the largest; one that
    isn't among the values teaches nothing. Documents over ``most_chars`` aren't
    taken, and labels without a document don't count. Of rows that repeat a
    doc_id the one of least text hash teaches.
    """
    sample, counts = _sampled(docs, labels, column, per_class, most_chars, values)
    return [] if sample is None else _weighted(((r["label"], r["text"]) for r in sample.orderBy("doc_id").collect()), counts)


def fitted(docs: DataFrame, labels: DataFrame, column: str, learn: Callable[[list[tuple[str, int, float]]], Any], per_class: int = PER_CLASS, most_chars: int = MOST_CHARS, values: Sequence[int] = (0, 1)) -> Any:
    """``learn`` of the labelled_sample, in a task: the driver gets its result, plain values and arrays, and never the texts."""
    sample, counts = _sampled(docs, labels, column, per_class, most_chars, values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [x for b in batches for x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(learn(_weighted(rows, counts)))], pa.binary())], names=["model"])

    # one task for so many rows as values * per_class at most
    got = [] if sample is None else sample.coalesce(1).sortWithinPartitions("doc_id").select("label", "text").mapInArrow(run, "model binary").collect()
    return pickle.loads(got[0]["model"]) if got else learn([])


def taught(docs: DataFrame, labels: DataFrame, column: str, per_class: int = PER_CLASS) -> Model:
    """The model that fit makes of the labelled_sample."""
    model = Model(0.0, np.zeros(0, np.float32))
    model.__setstate__(fitted(docs, labels, column, lambda rows: fit(rows).__getstate__(), per_class))
    return model


def score_documents(docs: DataFrame, model: Model, sentence_at: float = 0.5) -> DataFrame:
    """doc_id, score, predicted, offending array<struct<start,upto,score>> of every row.

    ``offending`` are the sentences of at least ``sentence_at`` in texts that are
    called toxic, as spans of code points of the lower-cased text. Null and
    empty texts are one sentence without words. Repeated rows are scored each;
    other columns are not read.
    """

    def make():
        known = model.word_weights()
        kind = pa.list_(pa.struct([("start", pa.int64()), ("upto", pa.int64()), ("score", pa.float64())]))

        def spans(text: str) -> list[dict]:
            low = text.lower()
            z, starts = model.logits(text, known)
            words = [(m.start(), m.end()) for m in TOKEN.finditer(low) if m[0] not in ENDS]
            if not words:
                return []
            ends = [*starts[1:], len(words)]
            p = 1 / (1 + np.exp(-z))
            return [{"start": words[a][0], "upto": words[b - 1][1], "score": float(q)} for a, b, q in zip(starts, ends, p, strict=True) if q >= sentence_at]

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [v.as_py() or "" for v in batch.column(1)]
            scores = [above_background(model.logits(t, known)[0], model.bias) for t in texts]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores), pa.array([int(s >= 0.5) for s in scores], pa.int32()), pa.array([spans(t) if s >= 0.5 else [] for t, s in zip(texts, scores, strict=True)], kind)], names=["doc_id", "score", "predicted", "offending"])

        return one

    return docs.select("doc_id", "text").mapInArrow(per_batch(make), f"doc_id {dict(docs.dtypes)['doc_id']}, score double, predicted int, offending array<struct<start:bigint,upto:bigint,score:double>>")


def judge_toxicity(docs: DataFrame, labels: DataFrame, column: str = "toxic", per_class: int = PER_CLASS) -> DataFrame:
    """doc_id, held_out, score, predicted, offending of every row of docs; labels only teach.

    Rows that repeat a doc_id are scored each by its own text; a null doc_id is
    not held out. Null, empty and wordless texts score 0. Without labels of both
    kinds nothing is called toxic; an empty table gives no rows.
    """
    scored = score_documents(docs, taught(docs, labels, column, per_class))
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", "predicted", "offending")


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that aren't called toxic, with their columns.

    Each row goes or stays by its own text, in the pass that reads it, whatever
    other rows have its doc_id. Null and empty texts stay.
    """
    model = taught(docs, labels, "toxic")
    place = docs.columns.index("text")

    def make():
        known = model.word_weights()

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            return batch.filter(pa.array([above_background(model.logits(v.as_py() or "", known)[0], model.bias) < 0.5 for v in batch.column(place)], pa.bool_()))

        return one

    return docs.mapInArrow(per_batch(make), docs.schema)
