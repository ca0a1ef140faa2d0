"""Near duplicates: minima of universal hashes, banding, verification, components.

Rows of one shingle set are a class, a node of the graph of links.
Classes get ``bands * rows`` minima; those that agree on all rows of a
band share a bucket. Pairs come from buckets without ever listing all pairs of
a bucket: in each round its first members, the heads, are paired with all later
members of other components and then leave it, one head at first and GROWTH times
as many each round; a bucket is done when its remaining members are in one
component. So every pair of a bucket is either tested or inside one component,
whatever the bucket's size. Members whose own shingles, that no other candidate
has, rule out any link leave before (see _linkable). Pairs are first held
against sketches, in blocks (see _likely), and links are confirmed on the full
sets.

The defaults miss a pair of similarity 0.85 with probability below 1e-10 and of
0.8 below 1e-7.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldloom.llm.common import LAST_ID, attach, keep_one, materialize, only, per_batch, row_key
from fieldloom.llm.components import connected_components

BANDS, ROWS, HEADS, GROWTH, SEED = 32, 4, 1, 32, 20_250
BINS, MEMBER_BLOCK, HEAD_BLOCK = 512, 256, 64
KEY = ["key_hi", "key_lo", "n_shingles"]
CHUNK = 1 << 15


def shingler(k: int):
    """text -> sorted distinct 64-bit hashes of its k-word shingles, of all its words if they are fewer; none without words."""
    import xxhash

    class Words(dict):
        def __missing__(self, word: bytes) -> int:
            if len(self) > 250_000:
                self.clear()
            self[word] = got = xxhash.xxh3_64_intdigest(word)
            return got

    words = Words()
    odd = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]

    def mix(x: np.ndarray) -> np.ndarray:
        x = (x ^ (x >> np.uint64(30))) * odd[1]
        x = (x ^ (x >> np.uint64(27))) * odd[0]
        return x ^ (x >> np.uint64(31))

    def shingles(text: str | None) -> np.ndarray:
        found = (text or "").encode().lower().split()  # of bytes: A-Z and ASCII white space alone
        n = len(found)
        if not n:
            return np.zeros(0, np.uint64)
        h = np.fromiter(map(words.__getitem__, found), np.uint64, n)
        m = min(k, n)
        out = np.full(n - m + 1, np.uint64(m))
        for j in range(m):
            out = mix(out * odd[2] + h[j : n - m + 1 + j])
        return np.unique(out)

    return shingles


def sketch(s: np.ndarray) -> bytes:
    """A byte of the least hash in each of BINS ranges, 0 where a range has none."""
    out = np.zeros(BINS, np.uint8)
    slot = (s >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)
    first = np.flatnonzero(np.diff(slot, prepend=-1))
    out[slot[first]] = (s[first] >> np.uint64(20)) % np.uint64(255) + np.uint64(1)
    return out.tobytes()


def signatures(docs: DataFrame, k: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, h, b, n_shingles, key_hi, key_lo, bands, low) of every row; low is the sketch that pairs are first held against."""

    def make():
        import xxhash

        shingles = shingler(k)
        rnd = np.random.default_rng(SEED)
        a = (rnd.integers(0, 1 << 63, bands * rows, np.uint64) << np.uint64(1) | np.uint64(1))[:, None]
        b = rnd.integers(0, 1 << 63, bands * rows, np.uint64)[:, None]

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            ns, his, los, keys, lows = [], [], [], [], []
            for value in batch.column(3):
                s = shingles(value.as_py())
                ns.append(len(s))
                digest = xxhash.xxh3_128_digest(s.tobytes())
                his.append(int.from_bytes(digest[:8], "big", signed=True))
                los.append(int.from_bytes(digest[8:], "big", signed=True))
                if len(s):
                    least = np.min([(a * s[i : i + CHUNK] + b).min(axis=1) for i in range(0, len(s), CHUNK)], axis=0)
                    keys.append([xxhash.xxh3_64_intdigest(x.tobytes(), seed=i) - (1 << 63) for i, x in enumerate(least.reshape(bands, rows))])
                    lows.append(sketch(s))
                else:
                    keys.append(None)
                    lows.append(None)
            return pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(ns, pa.int64()), pa.array(his, pa.int64()), pa.array(los, pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(lows, pa.binary())], names=["doc_id", "h", "b", "n_shingles", "key_hi", "key_lo", "bands", "low"])

        return one

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *row_key()[1:], "text").mapInArrow(per_batch(make), "doc_id long, h long, b long, n_shingles long, key_hi long, key_lo long, bands array<long>, low binary")


def shingle_sets(docs: DataFrame, k: int) -> DataFrame:
    """(key_hi, key_lo, n_shingles, shingles) of every row."""

    def make():
        import xxhash

        shingles = shingler(k)

        def one(batch: pa.RecordBatch):
            for at in range(0, batch.num_rows, 500):
                sets = [shingles(v.as_py()) for v in batch.slice(at, 500).column(0)]
                key = np.frombuffer(b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in sets), ">i8").astype(np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(key[:, 0]), pa.array(key[:, 1]), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=[*KEY, "shingles"])

        return one

    return docs.select("text").mapInArrow(per_batch(make), "key_hi long, key_lo long, n_shingles long, shingles array<long>")


def _named(df: DataFrame, side: str) -> DataFrame:
    return df.select(*(F.col(c).alias(side if c == "doc" else f"{c}_{side}") for c in df.columns))


def _likely(live: DataFrame, front: DataFrame, reps: DataFrame, share: int) -> DataFrame:
    """Distinct pairs (a, b) of a head and a later member of another component that the sketches don't rule out.

    Members and heads meet in blocks. Of ranges that either set fills, the share
    that agrees is a sample without replacement from the union; a pair is ruled
    out six standard deviations below the similarity asked for. A pair is looked
    at only in the first bucket that its members share.
    """
    own = reps.select(F.col("node").alias("doc"), F.col("n_shingles").alias("n"), "low", "bands")
    cut = live.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / MEMBER_BLOCK).alias("cuts"))
    rows = live.join(cut, "bucket").join(own, "doc")
    members = rows.groupBy("bucket", F.pmod(F.xxhash64("doc"), "cuts").alias("cut")).agg(F.collect_list(F.struct("doc", "own", "comp", "n", "low", "bands")).alias("members"))
    heads = front.select("bucket", "nth", F.col("head.own").alias("own"), F.col("head.doc").alias("doc"), F.col("ca").alias("comp")).join(own, "doc")
    heads = heads.groupBy("bucket", F.floor((F.col("nth") - 1) / HEAD_BLOCK).alias("part")).agg(F.collect_list(F.struct("doc", "own", "comp", "n", "low", "bands")).alias("heads"))

    def columns(value) -> list[np.ndarray]:
        x = value.values
        n = len(x)
        ints = [x.field(k).to_numpy(zero_copy_only=False) for k in ("doc", "own", "comp", "n")]
        return [*ints, np.frombuffer(b"".join(x.field("low").to_pylist()), np.uint8).reshape(n, -1), x.field("bands").flatten().to_numpy(zero_copy_only=False).reshape(n, -1)]

    def run(batches):
        for batch in batches:
            left, right = [], []
            for bucket, ms, hs in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                doc, own_, comp, n, low, bands = columns(ms)
                hdoc, hown, hcomp, hn, hlow, hbands = columns(hs)
                for j in range(len(hdoc)):
                    after = (own_ > hown[j]) | (own_ == hown[j]) & (doc > hdoc[j])
                    at = np.flatnonzero(after & (comp != hcomp[j]) & (100 * np.minimum(n, hn[j]) >= share * np.maximum(n, hn[j])))
                    if len(at):
                        common = bands[at] == hbands[j]
                        at = at[bands[at, common.argmax(axis=1)] == bucket]
                    if len(at):
                        filled = ((low[at] | hlow[j]) != 0).sum(axis=1)
                        alike = ((low[at] == hlow[j]) & (hlow[j] != 0)).sum(axis=1)
                        s = share / 100
                        of = np.minimum(1.0, filled / ((n[at] + hn[j]) / (1 + s)))
                        slack = 6 * np.sqrt(s * (1 - s) / filled * (1 - of)) + 2 / filled
                        at = at[alike >= filled * (s - slack)]
                        left += [np.minimum(doc[at], hdoc[j])]
                        right += [np.maximum(doc[at], hdoc[j])]
            if left:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(left)), pa.array(np.concatenate(right))], names=["a", "b"])

    return members.join(heads, "bucket").select("bucket", "members", "heads").mapInArrow(run, "a long, b long").distinct()


def _links(pairs: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """Those of pairs (a, b) whose sets have 100 * intersection >= share * union."""
    both = pairs.join(_named(sets, "b"), "b").join(_named(sets, "a"), "a")
    common = F.size(F.array_intersect("shingles_a", "shingles_b"))
    return both.filter(F.lit(100) * common >= F.lit(share) * (F.size("shingles_a") + F.size("shingles_b") - common)).select("a", "b")


def _linkable(members: DataFrame, reps: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """(bucket, doc, own): the members that can have a link in their bucket.

    A shingle that no other candidate has is in no intersection. So with u of
    them, a set of n meets one of m in at most n - u, and a link needs
    ``(100 + share) * (n - u) >= share * (n + m)``, where m is at least the
    smallest set of the bucket and share per cent of n. ``own`` is the share of u
    in thousandths: members with little of their own are heads first.
    """
    lone = sets.select("doc", F.explode("shingles").alias("shingle")).groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("doc").alias("doc")).filter("n = 1").groupBy("doc").agg(F.count(F.lit(1)).alias("u"))
    facts = reps.select(F.col("node").alias("doc"), F.col("n_shingles").alias("n")).join(lone, "doc", "left").select("doc", "n", F.coalesce("u", F.lit(0)).alias("u"))
    told = members.join(facts, "doc")
    least = told.groupBy("bucket").agg(F.min("n").alias("m"))
    m = F.greatest(F.col("m"), F.ceil(F.lit(share) * F.col("n") / 100))
    return told.join(least, "bucket").filter(F.lit(100 + share) * (F.col("n") - F.col("u")) >= F.lit(share) * (F.col("n") + m)).select("bucket", "doc", F.floor(F.lit(1000) * F.col("u") / F.col("n")).alias("own"))


def near_classes(docs: DataFrame, k: int = 5, share: int = 80, bands: int = BANDS, rows: int = ROWS, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """(doc_id, h, b, *KEY) of every row, and (*KEY, component_id, component, group_size) of the sets in components of several rows.

    A node of the graph is a distinct set, not an id, so rows that repeat an id
    with other texts stay apart; component is a node and component_id the least
    doc_id of its rows.
    """
    own = materialize(signatures(docs, k, bands, rows), "signatures")
    reps = own.filter("n_shingles > 0").groupBy(*KEY).agg(F.min("doc_id").alias("doc_id"), F.min(F.xxhash64(F.coalesce("doc_id", F.lit(LAST_ID)), "h")).alias("row"), F.count(F.lit(1)).alias("group_size"), F.first("bands").alias("bands"), F.first("low").alias("low"))
    # ids of nodes are fixed by the write
    reps = materialize(reps.withColumn("node", F.monotonically_increasing_id()), "representatives")
    entries = reps.select(F.explode("bands").alias("bucket"), F.col("node").alias("doc"))
    multi = entries.groupBy("bucket").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).filter("least < most").select("bucket")
    members = materialize(entries.join(multi, "bucket"), "members")
    wanted = reps.join(members.select(F.col("doc").alias("node")).distinct(), "node").select("node", *KEY, "row")
    # one row of a wanted set gives it
    did, h, _ = row_key()
    near = only(docs.select("text", F.xxhash64(did, h).alias("row")), wanted.select("row").distinct(), "row")
    sets = shingle_sets(near, k).join(wanted.drop("row"), KEY)
    sets = materialize(sets.groupBy(F.col("node").alias("doc")).agg(F.first("shingles").alias("shingles")), "shingle-sets")
    members = materialize(_linkable(members, reps, sets, share), "linkable")
    tested = labels = None
    first = heads
    while True:
        at = members.withColumn("comp", F.col("doc")) if labels is None else members.join(labels, F.col("doc") == F.col("node"), "left").select("bucket", "doc", "own", F.coalesce("component", "doc").alias("comp"))
        open_ = at.groupBy("bucket").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).filter("c0 < c1").select("bucket")
        live = materialize(at.join(open_, "bucket"), "buckets")
        order = Window.partitionBy("bucket").orderBy("own", "doc")
        front = live.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= first).select("bucket", "nth", F.struct("own", "doc").alias("head"), F.col("comp").alias("ca"))
        front = materialize(front, "heads")
        pairs = _likely(live, front, reps, share)
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = materialize(pairs, "pairs")
        members = live.join(front.groupBy("bucket").agg(F.max("head").alias("last")), "bucket").filter("struct(own, doc) > last").select("bucket", "doc", "own")
        first *= GROWTH
        if pairs.limit(1).count():
            tested = pairs if tested is None else tested.unionByName(pairs)
            more = materialize(_links(pairs, sets, share), "links")
            if more.limit(1).count():
                # stars of the components so far stand for all earlier links
                links = more if labels is None else more.unionByName(labels.select(F.col("node").alias("a"), F.col("component").alias("b")))
                labels = connected_components(links)
        if not members.limit(1).count():
            break
    if labels is None:
        labels = connected_components(reps.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0))
    roots = labels.select(F.col("component").alias("node"), "component").distinct()
    moved = reps.select("node", *KEY, "doc_id", "group_size").join(labels.select("node", "component").unionByName(roots), "node")
    moved = materialize(moved, "linked-sets")
    least = moved.groupBy("component").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("n_sets"))
    ends = attach(moved.select("component", *KEY, "group_size"), materialize(least, "components"), ["component"], "n_sets", how="inner").select(*KEY, "component_id", "component", "group_size")
    alone = reps.filter("group_size > 1").join(moved.select("node"), "node", "left_anti").select(*KEY, F.col("doc_id").alias("component_id"), F.col("node").alias("component"), "group_size")
    return own.select("doc_id", "h", "b", *KEY), materialize(ends.unionByName(alone), "near-classes")


def near_duplicates(docs: DataFrame, k: int = 5, share: int = 80, bands: int = BANDS, rows: int = ROWS, heads: int = HEADS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row.

    Words are lower-cased in A-Z; a text of fewer than k words is one shingle,
    and one without words, or null, has none and links with nothing. Two sets
    link at ``100 * intersection >= share * union``; component_id is the smallest
    id reachable over links (null only where no row of the component has one)
    and rows of that id are kept. Rows that repeat a doc_id are judged each by
    its own text. An empty table gives no rows. Other columns are not read.
    """
    own, classes = near_classes(docs, k, share, bands, rows, heads)
    out = attach(own.select("doc_id", *KEY), classes.drop("component"), KEY).withColumn("told", F.col("group_size").isNotNull())
    comp = F.when(F.col("told"), F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", comp.alias("component_id"), F.col("doc_id").eqNullSafe(comp).alias("kept"))


def drop_near_duplicates(docs: DataFrame, k: int = 5, share: int = 80) -> DataFrame:
    """docs with one row of each component: that of the least doc_id, nulls last; of several of that id one stays.

    Rows go one by one, by their own texts; those without words stay. An empty
    table stays empty.
    """
    own, classes = near_classes(docs, k, share)
    rows = own.select(F.coalesce("doc_id", F.lit(LAST_ID)).alias("did"), "h", "b", *KEY)
    return keep_one(docs, attach(rows, classes, KEY, how="inner").select("did", "h", "b", "component"), ["component"])
