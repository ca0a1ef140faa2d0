"""Repeated passages: every byte under a ``size``-byte string that also starts elsewhere.

A suffix sort of the places that matter, compared by prefix polynomial hashes.

1. Anchors. In each window of ``size`` bytes the least hash of its ``gram``-byte
   strings is the window's anchor; equal windows have equal anchors at the same
   place. Consecutive windows share anchors (a stretch), about one in a hundred
   bytes. An anchor that occurs once has no repeated window; stretches whose
   bytes equal another's (128-bit hash of another kind) repeat whole.
2. Suffix sort. Of the other stretches the suffixes that start at the anchor are
   sorted, forwards and backwards, by a mergesort whose comparisons find the
   common extension by binary search over prefix hashes. Every neighbour's
   extension and order is then verified byte by byte; a group with a hash
   collision is sorted by its bytes instead.
3. A window that starts d bytes before its anchor repeats if another suffix has
   d bytes in common backwards and ``size - d`` forwards: for each d both sorted
   orders fall into classes at the neighbours whose extension is shorter, and
   windows in one pair of classes are equal.

An anchor with more than ``most`` different stretches is cut by d into parts.
All windows of a part hold the same core bytes, whose hash is the part's key, so
parts meet only where they can be equal; parts still crowded are cut again, down
to single windows. No group above ``most`` comes to one task, and counts use
partial aggregation.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import BUCKETS, attach, materialize, per_batch, text_or_empty

SIZE, GRAM, CHUNK, MOST, FAN, SEED = 400, 200, 1 << 22, 4096, 8, 77
ROW = ["did", "h"]
PLACE = np.uint64((1 << 24) - 1)
PIECE = "key long, did long, h long, lo int, hi int, at int, single boolean, crowded boolean, slice binary"
PART = "key long, f1 long, f2 long, did long, h long, lo int, hi int, at int, single boolean, slice binary"


def mixed(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(31)
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    return h


class Prefix:
    """Prefix polynomial hashes modulo 2**64 over randomly coded bytes."""

    def __init__(self):
        rnd = np.random.default_rng(SEED)
        self.code = rnd.integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = int(rnd.integers(0, 1 << 62)) * 4 + 1 | 5
        self.inverse = pow(self.base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            for name, b in (("up", self.base), ("down", self.inverse)):
                p = np.full(n, np.uint64(b))
                p[0] = 1
                setattr(self, name, np.multiply.accumulate(p))

    def sums(self, data: np.ndarray) -> np.ndarray:
        """Hashes of all prefixes."""
        return self._sums(self.code[data])

    def _sums(self, codes: np.ndarray) -> np.ndarray:
        n = len(codes)
        self._powers(n + 1)
        s = np.zeros(n + 1, np.uint64)
        np.cumsum(codes * self.up[:n], out=s[1:])
        return s

    def grams(self, codes: np.ndarray, length: int) -> np.ndarray:
        """A mixed hash of the ``length`` codes at each place."""
        s = self._sums(codes)
        return mixed((s[length:] - s[:-length]) * self.down[: len(codes) - length + 1])

    def strings(self, data: np.ndarray, length: int) -> np.ndarray:
        """A mixed hash of the string of ``length`` at each place."""
        return self.grams(self.code[data], length)


def stretches(data: np.ndarray, prefix: Prefix, size: int = SIZE, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First and last window start of each stretch that shares an anchor, the anchor's place and its hash."""
    n = len(data)
    if n < size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return by_anchor(prefix.strings(data, gram), size, gram)


def by_anchor(g: np.ndarray, size: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The stretches of the windows of ``size`` over the hashes g of the ``gram``s at each place."""
    width = size - gram + 1
    n_win = len(g) - width + 1
    packed = (g & ~PLACE) | np.arange(len(g), dtype=np.uint64)
    grid = np.full(-(-len(g) // width) * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    grid[: len(g)] = packed
    grid = grid.reshape(-1, width)
    left = np.minimum.accumulate(grid, axis=1).ravel()
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    owner = (np.minimum(right[:n_win], left[width - 1 : width - 1 + n_win]) & PLACE).astype(np.int64)
    first = np.concatenate([[0], np.flatnonzero(owner[1:] != owner[:-1]) + 1])
    return first, np.append(first[1:], n_win) - 1, owner[first], g[owner[first]]


def _keyed(docs: DataFrame) -> DataFrame:
    text = text_or_empty()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).select("doc_id", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("did"), F.xxhash64("text").alias("h"), "text")


def anchors(keyed: DataFrame, size: int = SIZE, gram: int = GRAM, chunk: int = CHUNK) -> DataFrame:
    """(did, h, lo, hi, at, key, f1, f2) of every stretch; very long texts go in chunks, each window in one."""

    def make():
        import xxhash

        prefix = Prefix()

        def one(batch: pa.RecordBatch):
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                which, found, fs = [], [[], [], [], []], []
                for i, value in enumerate(part.column(2)):
                    raw = value.as_py().encode()
                    data = np.frombuffer(raw, np.uint8)
                    for c in range(0, max(1, len(raw) - size + 1), chunk):
                        lo, hi, place, g = stretches(data[c : c + chunk + size - 1], prefix, size, gram)
                        lo, hi, place = lo + c, hi + c, place + c
                        which.append(np.full(len(lo), i))
                        for column, v in zip(found, (lo, hi, place, g), strict=True):
                            column.append(v)
                        fs += [xxhash.xxh3_128_digest(raw[a : b + size]) for a, b in zip(lo.tolist(), hi.tolist(), strict=True)]
                if not fs:
                    continue
                f = np.frombuffer(b"".join(fs), np.int64).reshape(-1, 2)
                take = pa.array(np.concatenate(which))
                places = [pa.array(np.concatenate(c).astype(np.int32)) for c in found[:3]]
                yield pa.RecordBatch.from_arrays([part.column(0).take(take), part.column(1).take(take), *places, pa.array(np.concatenate(found[3]).view(np.int64)), pa.array(f[:, 0]), pa.array(f[:, 1])], names=["did", "h", "lo", "hi", "at", "key", "f1", "f2"])

        return one

    return keyed.filter(F.octet_length("text") >= size).select("did", "h", "text").mapInArrow(per_batch(make), "did long, h long, lo int, hi int, at int, key long, f1 long, f2 long")


def _settle(rows: DataFrame, most: int, more: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Of rows (key, f1, f2, did, h, lo, hi, at, single, *more): those whose bytes recur, and one of each kind of the rest.

    The first is (did, h, lo, hi); the second has a row for each distinct (f1, f2)
    of the keys with several, ``single`` where no other row has its bytes, and
    ``crowded`` where its key has over ``most`` kinds.
    """
    f = F.struct("f1", "f2")
    keys = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min(f).alias("f0"), F.max(f).alias("f9")).filter("n > 1").select("key", "n", (F.col("f0") == F.col("f9")).alias("alike"))
    again = materialize(attach(rows, materialize(keys, "repeated-keys"), ["key"], "n", how="inner").drop("n"), "repeated-rows")
    mixed = again.filter("not alike")
    kinds = materialize(mixed.groupBy("key", "f1", "f2").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*ROW, "lo", "hi", "at", "single", *more)).alias("head")), "kinds")
    same = attach(mixed.select(*ROW, "lo", "hi", "key", "f1", "f2"), kinds.filter("n > 1").select("key", "f1", "f2", "n"), ["key", "f1", "f2"], "n", how="inner")
    whole = again.filter("alike").select(*ROW, "lo", "hi").unionByName(same.select(*ROW, "lo", "hi"))
    crowds = kinds.groupBy("key").agg(F.count(F.lit(1)).alias("kinds"))
    rest = attach(kinds, crowds, ["key"], "kinds", how="inner").withColumn("alone", F.col("n") == 1)
    return whole, rest.select("key", *(f"head.{c}" for c in (*ROW, "lo", "hi", "at")), (F.col("alone") & F.col("head.single")).alias("single"), (F.col("kinds") > most).alias("crowded"), *(f"head.{c}" for c in more))


def _slices(held: DataFrame, size: int) -> DataFrame:
    """The bytes of the stretches left open, from the texts: PIECE."""

    def make():
        def one(batch: pa.RecordBatch):
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                which, rows, cut = [], [], []
                for i, (value, open_) in enumerate(zip(part.column(2), part.column(3).to_pylist(), strict=True)):
                    raw = value.as_py().encode()
                    for x in open_:
                        which.append(i)
                        rows.append(x)
                        cut.append(raw[x["lo"] : x["hi"] + size])
                if rows:
                    take = pa.array(which)
                    of = lambda c, t: pa.array([x[c] for x in rows], t)
                    yield pa.RecordBatch.from_arrays([of("key", pa.int64()), part.column(0).take(take), part.column(1).take(take), *(of(c, pa.int32()) for c in ("lo", "hi", "at")), *(of(c, pa.bool_()) for c in ("single", "crowded")), pa.array(cut, pa.binary())], names=["key", "did", "h", "lo", "hi", "at", "single", "crowded", "slice"])

        return one

    return held.filter(F.size("open") > 0).select("did", "h", "text", "open").mapInArrow(per_batch(make), PIECE)


def _split(crowd: DataFrame, part: int, size: int) -> DataFrame:
    """Crowded pieces cut into parts of ``part`` window starts, keyed by the bytes that all windows of the part hold."""

    def make():
        import xxhash

        def one(batch: pa.RecordBatch):
            out: list[list] = [[] for _ in range(10)]
            for x in batch.to_pylist():
                at, lo, hi, raw = x["at"], x["lo"], x["hi"], x["slice"]
                for k in range((at - hi) // part, (at - lo) // part + 1):
                    d0, d1 = k * part, k * part + part - 1  # windows start d0 to d1 bytes before the anchor
                    a, b = max(lo, at - d1), min(hi, at - d0)
                    core = raw[max(0, at - d0 - lo) : at - d1 + size - lo]
                    own = raw[a - lo : b + size - lo]
                    f = np.frombuffer(xxhash.xxh3_128_digest(own), np.int64)
                    key = xxhash.xxh3_64_intdigest(core, seed=(x["key"] + k * 0x9E3779B97F4A7C15) % (1 << 64)) - (1 << 63)
                    for column, v in zip(out, (key, int(f[0]), int(f[1]), x["did"], x["h"], a, b, at, x["single"], own), strict=True):
                        column.append(v)
            types = [pa.int64()] * 5 + [pa.int32()] * 3 + [pa.bool_(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=["key", "f1", "f2", "did", "h", "lo", "hi", "at", "single", "slice"])

        return one

    return crowd.select("key", *ROW, "lo", "hi", "at", "single", "slice").mapInArrow(per_batch(make), PART)


def _by_bytes(data: np.ndarray, at: np.ndarray, limit: np.ndarray, members: np.ndarray) -> tuple[list[int], list[int]]:
    """Order and neighbours' extensions of one group, without hashes."""
    text = {int(i): data[at[i] : at[i] + limit[i]].tobytes() for i in members}
    order = sorted(text, key=text.__getitem__)
    ext = [-1]
    for a, b in zip(order, order[1:], strict=False):
        x, y = text[a], text[b]
        n = min(len(x), len(y))
        ext.append(next((k for k in range(n) if x[k] != y[k]), n))
    return order, ext


def sort_suffixes(prefix: Prefix, data: np.ndarray, at: np.ndarray, limit: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes data[at : at + limit] in each group, and each one's common extension with the one before it.

    group is sorted; the first of a group has the extension -1. A bottom-up
    mergesort places each suffix in the sibling run by binary search; two
    suffixes are compared after their common extension, found by binary search
    over prefix hashes. All groups and runs go through a step together.
    """
    m = len(at)
    s = prefix.sums(data)
    down = prefix.down
    bits = int(limit.max(initial=1)).bit_length()

    def extension(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        lo, hi = np.zeros(len(i), np.int64), np.minimum(limit[i], limit[j])
        ai, aj = at[i], at[j]
        si, sj, di, dj = s[ai], s[aj], down[ai], down[aj]
        for _ in range(bits):
            mid = (lo + hi + 1) >> 1
            same = (s[ai + mid] - si) * di == (s[aj + mid] - sj) * dj
            lo = np.where(same, mid, lo)
            hi = np.where(same, hi, mid - 1)
            hi = np.maximum(lo, hi)
        return lo

    def before(i: np.ndarray, j: np.ndarray, l: np.ndarray) -> np.ndarray:  # noqa: E741
        """-1, 0, 1 as suffix i comes before, equals or follows j, of common extension l."""
        end_i, end_j = l >= limit[i], l >= limit[j]
        bi = data[np.minimum(at[i] + l, len(data) - 1)].astype(np.int64)
        bj = data[np.minimum(at[j] + l, len(data) - 1)].astype(np.int64)
        return np.where(end_i & end_j, 0, np.where(end_i, -1, np.where(end_j, 1, np.sign(bi - bj))))

    first = np.flatnonzero(np.diff(group, prepend=group[0] - 1 if m else 0))
    sizes = np.diff(np.append(first, m))
    start, stop = np.repeat(first, sizes), np.repeat(first + sizes, sizes)
    order = np.arange(m)
    run = 1
    while run < sizes.max(initial=0):
        p = np.flatnonzero(stop - start > run)
        rel = p - start[p]
        k = rel // run
        lo = np.minimum(start[p] + (k ^ 1) * run, stop[p])
        hi = np.minimum(lo + run, stop[p])
        base, left, x = lo.copy(), k % 2 == 0, order[p]
        while (live := np.flatnonzero(lo < hi)).size:
            mid = (lo[live] + hi[live]) >> 1
            y = order[mid]
            c = before(y, x[live], extension(y, x[live]))
            goes = (c < 0) | ((c == 0) & ~left[live])
            lo[live] = np.where(goes, mid + 1, lo[live])
            hi[live] = np.where(goes, hi[live], mid)
        order = order.copy()
        order[start[p] + (k >> 1) * 2 * run + (rel - k * run) + (lo - base)] = x
        run *= 2
    ext = np.full(m, -1, np.int64)
    inner = np.flatnonzero(np.arange(m) != start)
    a, b = order[inner - 1], order[inner]
    l = extension(a, b)  # noqa: E741
    ext[inner] = l
    # neighbours are verified by their bytes, and so is their order
    reach = np.cumsum(l) - l
    step = np.arange(int(l.sum())) - np.repeat(reach, l)
    wrong = data[np.repeat(at[a], l) + step] != data[np.repeat(at[b], l) + step]
    bad = before(a, b, l) > 0
    if wrong.any():
        bad[np.unique(np.repeat(np.arange(len(l)), l)[wrong])] = True
    for g in np.unique(start[inner[bad]]):
        own = np.arange(g, stop[g])
        order[own], ext[own] = _by_bytes(data, at, limit, own)
    return order, ext


def repeated_starts(prefix: Prefix, data: np.ndarray, begin: np.ndarray, lo: np.ndarray, hi: np.ndarray, at: np.ndarray, group: np.ndarray, size: int) -> list[tuple[int, int, int]]:
    """(piece, first, last): runs of window starts of the pieces, each of bytes lo to hi + size at ``begin``, that repeat in their group."""
    m = len(lo)
    place, forth, back = begin + at - lo, hi + size - at, at - lo
    orders = [sort_suffixes(prefix, data, place, forth, group), sort_suffixes(prefix, np.ascontiguousarray(data[::-1]), len(data) - place, back, group)]
    least, most = at - hi, at - lo
    hit = np.zeros((m, int(most.max()) + 2), bool)

    def classes(which: int, need: int) -> np.ndarray:
        order, ext = orders[which]
        out = np.empty(m, np.int64)
        out[order] = np.cumsum(ext < need)
        return out

    for d in range(int(least.min()), int(most.max()) + 1):
        own = np.flatnonzero((least <= d) & (d <= most))
        if len(own) > 1:
            pair = (classes(0, size - d) * (m + 1) + classes(1, d))[own]
            _, back_to, n = np.unique(pair, return_inverse=True, return_counts=True)
            hit[own, d] = n[back_to] > 1
    edge = np.diff(hit.astype(np.int8), axis=1, prepend=0)
    rows, first = np.nonzero(edge == 1)
    last = np.nonzero(edge == -1)[1] - 1
    return list(zip(rows.tolist(), (at[rows] - last).tolist(), (at[rows] - first).tolist(), strict=True))


def _sorted(pieces: DataFrame, size: int) -> DataFrame:
    """(did, h, lo, hi): runs of repeated window starts of pieces that no other piece equals. Keys come whole to a task, at most ``most`` pieces each."""

    def run(batches):
        prefix, held = Prefix(), None

        def solve(t: pa.RecordBatch) -> pa.RecordBatch | None:
            ints = {c: t.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("key", "lo", "hi", "at")}
            n = ints["hi"] - ints["lo"] + size
            data = np.frombuffer(b"".join(t.column("slice").to_pylist()), np.uint8)
            got = repeated_starts(prefix, data, np.cumsum(n) - n, ints["lo"], ints["hi"], ints["at"], ints["key"], size)
            single = t.column("single").to_pylist()
            got = [x for x in got if single[x[0]]]
            if not got:
                return None
            take = pa.array([x[0] for x in got])
            return pa.RecordBatch.from_arrays([t.column("did").take(take), t.column("h").take(take), pa.array([x[1] for x in got], pa.int32()), pa.array([x[2] for x in got], pa.int32())], names=["did", "h", "lo", "hi"])

        for batch in batches:
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            key = batch.column("key").to_numpy(zero_copy_only=False)
            at = int(np.searchsorted(key, key[-1])) if len(key) else 0  # the last key waits for the next batch
            held = batch.slice(at)
            if at and (out := solve(batch.slice(0, at))) is not None:
                yield out
        if held is not None and held.num_rows and (out := solve(held)) is not None:
            yield out

    one = pieces.filter("not crowded").select("key", *ROW, "lo", "hi", "at", "single", "slice")
    return one.repartition("key").sortWithinPartitions("key").mapInArrow(run, "did long, h long, lo int, hi int")


def _cut(size: int):
    def make():
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = [[], [], [], [], []]
            for value, whole, more in zip(batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                raw = value.as_py().encode()
                edge = np.zeros(len(raw) + 1, np.int32)
                for x in (whole or []) + (more or []):
                    edge[x["lo"]] += 1
                    edge[x["hi"] + size] -= 1
                gone = np.cumsum(edge)[:-1] > 0
                kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                for c, v in zip(out, (len(raw), int(gone.sum()), int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore")), strict=True):
                    c.append(v)
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(4), batch.column(5), *(pa.array(c, pa.int64()) for c in out[:3]), pa.array(out[3], pa.string()), pa.array(out[4], pa.string())], names=["doc_id", *ROW, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"])

        return one

    return per_batch(make)


def remove_repeats(docs: DataFrame, size: int = SIZE, gram: int = GRAM, most: int = MOST, chunk: int = CHUNK, words: int | None = None) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept_text of every row.

    Null text is empty; texts under ``size`` bytes stay whole. Rows that repeat
    a text, with the same id, another or none, repeat each other, so all their
    bytes under ``size``-byte strings go. kept_text leaves out bytes of
    characters that were cut through; kept_sha256 is of the remaining bytes
    themselves. An empty table gives no rows. Other columns are not read.
    With ``words``, n_shared_words says how many words of a row stand in passages
    of that many words that another row holds too, of however few bytes; nothing
    is removed for it.
    """
    keyed = _keyed(docs)
    found = materialize(anchors(keyed, size, gram, chunk), "anchors").withColumn("single", F.lit(True))
    whole, rest = _settle(found, most)
    judged = whole.select(*ROW, "lo", "hi", F.lit(True).alias("is_whole"), *(F.lit(None).cast(t).alias(c) for c, t in (("at", "int"), ("key", "long"), ("single", "boolean"), ("crowded", "boolean")))).unionByName(rest.withColumn("is_whole", F.lit(False)))
    gather = lambda c, *names: F.collect_list(F.when(c, F.struct(*names)))
    of_doc = materialize(judged.groupBy(*ROW).agg(gather(F.col("is_whole"), "lo", "hi").alias("whole"), gather(~F.col("is_whole"), "key", "lo", "hi", "at", "single", "crowded").alias("open")), "stretches-of-texts")
    slot = F.pmod(F.col("h"), F.lit(BUCKETS)).cast("int")
    slots = F.broadcast(of_doc.select(slot.alias("slot")).distinct())  # at most BUCKETS rows
    slotted = keyed.withColumn("slot", slot)
    held = materialize(slotted.join(slots, "slot", "left_semi").drop("slot").join(of_doc, ROW, "left").withColumn("open", F.coalesce("open", F.array().cast(dict(of_doc.dtypes)["open"]))), "texts-with-stretches")
    pieces = materialize(_slices(held, size), "pieces")
    solved = _sorted(pieces, size)
    crowd, part = pieces.filter("crowded"), size - gram + 1
    while crowd.limit(1).count():
        part = -(-part // FAN)
        whole, rest = _settle(materialize(_split(crowd, part, size), "parts"), most, ("slice",))
        rest = materialize(rest if part > 1 else rest.withColumn("crowded", F.lit(False)), "parts-left")
        solved = solved.unionByName(whole).unionByName(_sorted(rest, size))
        crowd = rest.filter("crowded")
    runs = solved.groupBy(*ROW).agg(F.collect_list(F.struct("lo", "hi")).alias("more"))
    cut = held.join(runs, ROW, "left").select("doc_id", "text", "whole", "more", *ROW).mapInArrow(_cut(size), "doc_id long, did long, h long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string")
    rest = slotted.join(slots, "slot", "left_anti").select("doc_id", *ROW, F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), F.sha2("text", 256).alias("kept_sha256"), F.col("text").alias("kept_text"))
    out = cut.unionByName(rest)
    if words:
        from fieldloom.llm.passages import shared_passages

        out = out.join(shared_passages(keyed, words), ROW, "left").withColumn("n_shared_words", F.coalesce("n_shared_words", F.lit(0).cast("long")))
    return out.drop(*ROW)
