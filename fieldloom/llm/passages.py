"""Passages of ``words`` words or more that stand in several rows, word for word.

Windows of ``words`` words share anchors as windows of bytes do in repeats: in
each window the least hash of its ``gram``-word strings, so equal windows have
equal anchors at the same place. Stretches whose anchor stands in one row only
share nothing; stretches whose bytes stand in another row share whole. Of the
rest one stretch of each kind gives its windows, which are counted. Bytes and
windows are told by their anchor's hash and another 64-bit hash of another kind.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import BUCKETS, attach, materialize, per_batch
from fieldloom.llm.repeats import ROW, Prefix, by_anchor, mixed

WORDS, GRAM, CHUNK = 51, 16, 1 << 18
IS_SPACE = np.isin(np.arange(256), [32, *range(9, 14)])


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word ``[^\\x20\\x09-\\x0D]+``."""
    edge = np.flatnonzero(np.diff((~IS_SPACE[data]).view(np.int8), prepend=0, append=0))
    return edge[::2], edge[1::2]


def word_stretches(data: np.ndarray, start: np.ndarray, end: np.ndarray, prefix: Prefix, words: int = WORDS, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """As ``stretches``, with words for bytes."""
    if len(start) < words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    s = prefix.sums(data[start[0] : end[-1]])
    a = start - start[0]
    word = mixed((s[end - start[0]] - s[a]) * prefix.down[a])
    return by_anchor(prefix.grams(word, gram), words, gram)


def _found(texts: DataFrame, words: int, gram: int, chunk: int) -> DataFrame:
    """(did, h, lo, hi, at, key, f, k1, f1) of every stretch, in words; k1 and f1 are 1 at a row's first of the key and of the bytes, else 0."""

    def make():
        import xxhash

        prefix = Prefix()

        def one(batch: pa.RecordBatch):
            for b in range(0, batch.num_rows, 1000):
                part = batch.slice(b, 1000)
                which, found = [], [[] for _ in range(7)]
                for i, value in enumerate(part.column(2)):
                    raw = value.as_py().encode()
                    data = np.frombuffer(raw, np.uint8)
                    start, end = word_bounds(data)
                    if len(start) < words:
                        continue
                    own: list[list] = [[], [], [], []]
                    for c in range(0, len(start) - words + 1, chunk):
                        lo, hi, at, key = word_stretches(data, start[c : c + chunk + words - 1], end[c : c + chunk + words - 1], prefix, words, gram)
                        for column, v in zip(own, (lo + c, hi + c, at + c, key), strict=True):
                            column.append(v)
                    lo, hi, at, key = (np.concatenate(c) for c in own)
                    f = np.array([xxhash.xxh3_64_intdigest(raw[x:y]) for x, y in zip(start[lo].tolist(), end[hi + words - 1].tolist(), strict=True)], np.uint64)
                    k1, f1 = np.zeros(len(lo), np.int32), np.zeros(len(lo), np.int32)
                    k1[np.unique(key, return_index=True)[1]] = 1
                    order = np.lexsort((f, key))
                    new = np.ones(len(lo), bool)
                    new[1:] = (np.diff(key[order]) != 0) | (np.diff(f[order]) != 0)
                    f1[order[new]] = 1
                    which.append(np.full(len(lo), i))
                    for column, v in zip(found, (lo.astype(np.int32), hi.astype(np.int32), at.astype(np.int32), key.view(np.int64), f.view(np.int64), k1, f1), strict=True):
                        column.append(v)
                if which:
                    take = pa.array(np.concatenate(which))
                    yield pa.RecordBatch.from_arrays([part.column(0).take(take), part.column(1).take(take), *(pa.array(np.concatenate(c)) for c in found)], names=[*ROW, "lo", "hi", "at", "key", "f", "k1", "f1"])

        return one

    return texts.mapInArrow(per_batch(make), "did long, h long, lo int, hi int, at int, key long, f long, k1 int, f1 int")


def _windows(held: DataFrame, words: int) -> DataFrame:
    """(key, f, d, w, did, h, docs): each window of the stretches left open, d words before the anchor, with the hash of its words."""

    def make():
        import xxhash

        def one(batch: pa.RecordBatch):
            for b in range(0, batch.num_rows, 200):
                part = batch.slice(b, 200)
                which, out = [], [[], [], [], [], []]
                for i, (value, open_) in enumerate(zip(part.column(2), part.column(3).to_pylist(), strict=True)):
                    raw = value.as_py().encode()
                    start, end = word_bounds(np.frombuffer(raw, np.uint8))
                    for x in open_:
                        to = x["hi"] + words
                        told = [raw[p:q] for p, q in zip(start[x["lo"] : to].tolist(), end[x["lo"] : to].tolist(), strict=True)]
                        for j in range(x["hi"] - x["lo"] + 1):
                            which.append(i)
                            for column, v in zip(out, (x["key"], x["f"], x["at"] - x["lo"] - j, xxhash.xxh3_64_intdigest(b" ".join(told[j : j + words])) - (1 << 63), x["docs"]), strict=True):
                                column.append(v)
                if which:
                    take = pa.array(which)
                    key, f, d, w, docs = (pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()), strict=True))
                    yield pa.RecordBatch.from_arrays([key, f, d, w, part.column(0).take(take), part.column(1).take(take), docs], names=["key", "f", "d", "w", *ROW, "docs"])

        return one

    return held.select(*ROW, "text", "open").mapInArrow(per_batch(make), "key long, f long, d int, w long, did long, h long, docs long")


def shared_passages(keyed: DataFrame, words: int = WORDS, gram: int = GRAM, chunk: int = CHUNK) -> DataFrame:
    """(did, h, n_shared_words) of the rows of keyed (did, h, text) that share a passage: their words in windows of ``words`` words that another row holds too.

    White space between words doesn't matter. A window that stands twice in one
    row and in no other doesn't count; rows that repeat a text share it, with
    the same id, another or none. Rows that share nothing are left out.
    """
    texts = keyed.filter(F.octet_length("text") >= 2 * words - 1).select(*ROW, "text")
    found = materialize(_found(texts, words, gram, chunk), "word-anchors")
    keys = found.groupBy("key").agg(F.sum("k1").alias("docs"), F.count(F.lit(1)).alias("n"), F.min("f").alias("f0"), F.max("f").alias("f9")).filter("docs > 1").select("key", "n", (F.col("f0") == F.col("f9")).alias("alike"))
    again = materialize(attach(found, materialize(keys, "shared-keys"), ["key"], "n", how="inner").drop("n", "k1"), "shared-rows")
    several = again.filter("not alike")
    kinds = materialize(several.groupBy("key", "f").agg(F.sum("f1").alias("docs"), F.count(F.lit(1)).alias("n"), F.min(F.struct(*ROW, "lo", "hi", "at")).alias("head")), "word-kinds")
    same = attach(several.select(*ROW, "lo", "hi", "key", "f"), kinds.filter("docs > 1").select("key", "f", "n"), ["key", "f"], "n", how="inner")
    heads = kinds.select("key", "f", "docs", "head.*").groupBy(*ROW).agg(F.collect_list(F.struct("key", "f", "docs", "lo", "hi", "at")).alias("open"))
    heads = materialize(heads, "word-heads")
    slot = F.pmod(F.col("h"), F.lit(BUCKETS)).cast("int")
    slots = F.broadcast(heads.select(slot.alias("slot")).distinct())  # at most BUCKETS rows
    held = texts.withColumn("slot", slot).join(slots, "slot", "left_semi").drop("slot").join(heads, ROW)
    windows = materialize(_windows(held, words), "word-windows")
    me = F.struct(*ROW)
    told = windows.groupBy("key", "w").agg(F.count(F.lit(1)).alias("n"), F.min(me).alias("r0"), F.max(me).alias("r9"), F.max("docs").alias("most")).filter("r0 != r9 or most > 1").select("key", "w", "n")
    met = attach(windows.filter("docs = 1").select("key", "f", "d", "w"), materialize(told, "shared-windows"), ["key", "w"], "n", how="inner")
    places = met.groupBy("key", "f").agg(F.collect_set("d").alias("ds")).join(kinds.select("key", "f", "n"), ["key", "f"])
    parts = attach(several.select(*ROW, "at", "key", "f"), materialize(places, "shared-places"), ["key", "f"], "n", how="inner").select(*ROW, "at", F.explode("ds").alias("d")).select(*ROW, (F.col("at") - F.col("d")).alias("lo"))
    runs = again.filter("alike").select(*ROW, "lo", "hi").unionByName(same.select(*ROW, "lo", "hi")).unionByName(parts.select(*ROW, "lo", F.col("lo").alias("hi")))
    nought = F.struct(F.lit(0).cast("long").alias("upto"), F.lit(0).cast("long").alias("n"))

    def add(so, x):
        stop = (x["hi"] + words).cast("long")
        return F.struct(F.greatest(so["upto"], stop).alias("upto"), (so["n"] + F.greatest(F.lit(0), stop - F.greatest(so["upto"], x["lo"].cast("long")))).alias("n"))

    return runs.groupBy(*ROW).agg(F.array_sort(F.collect_set(F.struct("lo", "hi"))).alias("runs")).select(*ROW, F.aggregate("runs", nought, add, lambda so: so["n"]).alias("n_shared_words"))
