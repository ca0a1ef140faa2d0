"""Best-fit packing of token pieces into sequences, merged up a tree.

Leaves tokenise their documents and pack the pieces best-fit decreasing; bins
within ``slack`` tokens of full are emitted. The others move up as items of
their fill, ``fan_in`` nodes at a time, and are packed again, until one node is
left. After best fit at most one bin of a node is half full or less, and bins
over half full never share a sequence, so a node hands on at most ``carry``
bins, the emptiest, and emits the rest as they are: what meets in a node is
bounded by ``fan_in * carry`` rows at any input size.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import materialize
from fieldloom.llm.vocab import document_ids

CAPACITY, END_ID, SLACK, FAN_IN, CARRY, BLOCK = 1024, 2, 8, 8, 8192, 1 << 18
MEMBER = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("offset", pa.int64())]
BINS = "level int, node int, bin int, fill int, done boolean, members array<struct<doc_id:bigint,piece:int,start:bigint,length:bigint,ids_crc32:bigint,offset:bigint>>"


def best_fit(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of item indices, by best fit over decreasing sizes (ties by position)."""
    order = np.argsort(-sizes, kind="stable").tolist()
    size = sizes.tolist()
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms = 0  # bit r: some bin has room r
    for i in order:
        s = size[i]
        fit = open_rooms >> s
        if fit:
            room = s + (fit & -fit).bit_length() - 1
            k = by_room[room].pop()
            if not by_room[room]:
                open_rooms ^= 1 << room
            bins[k].append(i)
            room -= s
        else:
            k, room = len(bins), capacity - s
            bins.append([i])
        if room:
            by_room[room].append(k)
            open_rooms |= 1 << room
    return bins


def _binned(values: pa.StructArray, spans: np.ndarray, bins: list[list[int]], level: int, node: int, first: int, capacity: int, slack: int, carry: int, last: bool) -> pa.RecordBatch:
    """Bins as rows. spans: from and to of each item's members in values."""
    items = np.fromiter((i for b in bins for i in b), np.int64)
    per_bin = np.fromiter((len(b) for b in bins), np.int64, len(bins))
    lengths = values.field("length").to_numpy(zero_copy_only=False)
    n = spans[items, 1] - spans[items, 0]
    ends = np.cumsum(n)
    take = np.arange(ends[-1] if len(ends) else 0) + np.repeat(spans[items, 0] - (ends - n), n)
    got = lengths[take]
    bin_ends = ends[np.cumsum(per_bin) - 1] if len(bins) else np.zeros(0, np.int64)
    offsets = np.concatenate([[0], bin_ends])
    before = np.cumsum(got) - got
    heads = before[offsets[:-1]] if len(bins) else before
    inside = before - np.repeat(heads, np.diff(offsets))
    fill = np.add.reduceat(got, offsets[:-1]) if len(bins) else np.zeros(0, np.int64)
    done = np.full(len(bins), True) if last else fill >= capacity - slack
    waiting = np.flatnonzero(~done)
    if len(waiting) > carry:
        done[waiting[np.argsort(fill[waiting], kind="stable")[carry:]]] = True
    picked = values.take(pa.array(take))
    members = pa.StructArray.from_arrays([*(picked.field(k) for k in range(5)), pa.array(inside, pa.int64())], names=[k for k, _ in MEMBER])
    m = len(bins)
    return pa.RecordBatch.from_arrays([pa.array(np.full(m, level, np.int32)), pa.array(np.full(m, node, np.int32)), pa.array(np.arange(first, first + m, dtype=np.int32)), pa.array(fill.astype(np.int32)), pa.array(done), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), members)], names=["level", "node", "bin", "fill", "done", "members"])


def _leaves(capacity: int, slack: int, carry: int, end_id: int, json_path: str | None, ranks_path: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, first = TaskContext.get().partitionId(), 0
        encode = document_ids(json_path, ranks_path)
        rows: list[list] = [[], [], [], [], []]

        def flush() -> pa.RecordBatch:
            values = pa.StructArray.from_arrays([*(pa.array(c, t) for c, (_, t) in zip(rows, MEMBER, strict=False)), pa.nulls(len(rows[0]), pa.int64())], names=[k for k, _ in MEMBER])
            at = np.arange(len(rows[0]))
            return _binned(values, np.stack([at, at + 1], 1), best_fit(np.array(rows[3], np.int64), capacity), 0, node, first, capacity, slack, carry, False)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(encode(text.as_py() or ""), np.uint32(end_id)).astype("<u4")
                start, head = 0, len(ids) % capacity or capacity
                for piece, stop in enumerate(range(head, len(ids) + 1, capacity)):
                    for c, v in zip(rows, (doc_id, piece, start, stop - start, zlib.crc32(ids[start:stop].tobytes())), strict=True):
                        c.append(v)
                    start = stop
                if len(rows[0]) >= BLOCK:
                    out = flush()
                    first += out.num_rows
                    rows = [[], [], [], [], []]
                    yield out
        if rows[0]:
            yield flush()

    return run


def _merge(level: int, capacity: int, slack: int, carry: int, last: bool):
    def run(table: pa.Table) -> pa.Table:
        t = table.sort_by([("node", "ascending"), ("bin", "ascending")]).combine_chunks()
        lists = t.column("members").chunk(0)
        ends = lists.offsets.to_numpy()
        spans = np.stack([ends[:-1], ends[1:]], 1)
        fill = t.column("fill").to_numpy()
        node = t.column("parent")[0].as_py()
        return pa.Table.from_batches([_binned(lists.values, spans, best_fit(fill.astype(np.int64), capacity), level, node, 0, capacity, slack, carry, last)])

    return run


def pack(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, slack: int = SLACK, fan_in: int = FAN_IN, carry: int = CARRY, json_path: str | None = None, ranks_path: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece.

    A document is its ids and ``end_id``; null or empty text is ``end_id`` alone.
    Longer ones are cut so that all pieces but the first are full. Rows that
    repeat a doc_id are packed each; other columns are not read.
    """
    leaf = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_leaves(capacity, slack, carry, end_id, json_path, ranks_path), BINS)
    levels = [materialize(leaf, "bins-0")]
    nodes = (levels[0].agg(F.max("node")).first()[0] or 0) + 1
    while nodes > 1 or len(levels) == 1:
        nodes = -(-nodes // fan_in)
        up = levels[-1].filter("not done").withColumn("parent", F.floor(F.col("node") / fan_in).cast("int"))
        merged = up.groupBy("parent").applyInArrow(_merge(len(levels), capacity, slack, carry, nodes == 1), BINS)
        levels.append(materialize(merged, f"bins-{len(levels)}"))
    out = levels[0]
    for more in levels[1:]:
        out = out.unionByName(more)
    sequence = F.shiftleft(F.col("level").cast("long"), 56) + F.shiftleft(F.col("node").cast("long"), 32) + F.col("bin")
    return out.filter("done").select(sequence.alias("sequence_id"), F.explode("members").alias("m")).select("m.doc_id", "m.piece", "m.start", "m.length", "m.ids_crc32", "sequence_id", "m.offset")
