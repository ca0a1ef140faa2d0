"""Every query against every document of a corpus, in tiles of a bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Rows of a tile's two sides: its similarities take 16 MB.
QUERY_ROWS, CORPUS_ROWS = 1024, 2048
#: Documents that a task reads, and queries that it has at least where there are more tasks than cores.
TASK_DOCS, TASK_QUERIES = 131_072, 256

Block = dict[str, np.ndarray]


def _packed(df: DataFrame, columns: list[str], rows: int, side: str, parts: int) -> DataFrame:
    """``rows`` rows of df as one, the values of each column end to end as bytes. The sort gives a task that runs again the same blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                values = [(c.flatten() if pa.types.is_list(c.type) else c).to_numpy(zero_copy_only=False) for c in batch.slice(at, rows).columns]
                yield pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(v).tobytes()]) for v in values], names=[f"{side}_{c}" for c in columns])

    return df.select(*columns).sortWithinPartitions("i").mapInArrow(run, ", ".join(f"{side}_{c} binary" for c in columns)).repartition(parts)


def _kinds(df: DataFrame, columns: list[str]) -> dict[str, tuple[str, bool]]:
    """The numpy type of each column, and whether it has arrays."""
    of = {"bigint": "i8", "double": "f8", "float": "f4"}
    types = {c: dict(df.dtypes)[c] for c in columns}
    return {c: (of[t.removeprefix("array<").removesuffix(">")], t.startswith("array")) for c, t in types.items()}


def scan(queries: DataFrame, corpus: DataFrame, begin: Callable[[Block], dict], step: Callable[[dict, Block], None], end: Callable[[dict], pa.RecordBatch], schema: str, n_queries: int | None = None) -> DataFrame:
    """What ``end`` gives of each block of queries after ``step`` has met it with the documents of a task.

    Both sides have i (long, unique), v (array) and other columns of longs,
    doubles or arrays of these of one length. ``begin`` makes the state of a
    block of queries, ``step`` takes a block of documents, ids in order. A task
    keeps a block of each side and hands on a block's state, not a tile's, so
    shuffles grow with the queries and with the tasks that share the corpus
    (TASK_DOCS), not with the pairs. Neither side is broadcast. ``n_queries``
    saves their count where they are costly.
    """
    cores = queries.sparkSession.sparkContext.defaultParallelism
    q_kinds, c_kinds = _kinds(queries, queries.columns), _kinds(corpus, corpus.columns)
    n_q, n_c = queries.count() if n_queries is None else n_queries, corpus.count()
    q = _packed(queries, queries.columns, QUERY_ROWS, "q", max(1, min(2 * cores, -(-n_q // TASK_QUERIES))))
    c = _packed(corpus, corpus.columns, CORPUS_ROWS, "c", max(1, -(-n_c // TASK_DOCS)))

    def block(batch: pa.RecordBatch, at: int, kinds: dict[str, tuple[str, bool]], side: str) -> Block:
        of = {name: np.frombuffer(batch.column(batch.schema.get_field_index(f"{side}_{name}"))[at].as_buffer(), kind) for name, (kind, _) in kinds.items()}
        of = {name: x.reshape(len(of["i"]), -1) if kinds[name][1] else x for name, x in of.items()}
        return of | {"v": of["v"].astype(np.float64)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("q_i"))
            for at in range(batch.num_rows):
                if now is None or ids[at].as_py() != now:  # the task's documents come one after the other for each block of queries
                    if now is not None:
                        yield end(state)
                    now, state = ids[at].as_py(), begin(block(batch, at, q_kinds, "q"))
                step(state, block(batch, at, c_kinds, "c"))
        if now is not None:
            yield end(state)

    # with the hint no side is broadcast, which would hand the rows over in another order
    return q.hint("shuffle_replicate_nl").crossJoin(c).mapInArrow(run, schema)


def products(queries: Block, docs: Block, part: slice = slice(None)) -> np.ndarray:
    """Inner products of a tile; a query's own is -inf."""
    raw = queries["v"][:, part] @ docs["v"][:, part].T
    at = np.minimum(np.searchsorted(docs["i"], queries["i"]), len(docs["i"]) - 1)
    own = np.flatnonzero(docs["i"][at] == queries["i"])
    raw[own, at[own]] = -np.inf
    return raw


class Best:
    """The k best documents of each of n queries: by product, rounded, then id."""

    def __init__(self, n: int, k: int, digits: int) -> None:
        self.k, self.digits, self.floor = k, digits, np.full(n, -np.inf)
        self.row, self.sim, self.doc = np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64)

    def add(self, raw: np.ndarray, ids: np.ndarray) -> None:
        least = self.floor
        if raw.shape[1] > self.k:
            fresh = np.flatnonzero(np.isneginf(least))
            if len(fresh):
                least = least.copy()
                least[fresh] = np.partition(raw[fresh], raw.shape[1] - self.k, axis=1)[:, raw.shape[1] - self.k]
        # what is rounded up to the least has less than it by under a unit of the last digit
        r, c = np.nonzero((raw >= (least - 10.0**-self.digits)[:, None]) & (raw > -np.inf))
        row, sim, doc = np.concatenate([self.row, r]), np.concatenate([self.sim, np.round(raw[r, c], self.digits)]), np.concatenate([self.doc, ids[c]])
        order = np.lexsort((doc, -sim, row))
        row, sim, doc = row[order], sim[order], doc[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        keep = place < self.k
        self.row, self.sim, self.doc = row[keep], sim[keep], doc[keep]
        last = place[keep] == self.k - 1
        self.floor[self.row[last]] = self.sim[last]


def before(raw: np.ndarray, ids: np.ndarray, sim: np.ndarray, doc: np.ndarray, digits: int) -> np.ndarray:
    """How many documents of a tile come before each of a query's own (sim, doc), by rounded product and then id; none before one of sim inf."""
    r, c = np.nonzero(raw >= (sim.min(axis=1) - 10.0**-digits)[:, None])
    value, of = np.round(raw[r, c], digits), ids[c]
    out = np.zeros(sim.shape, np.int64)
    for j in range(sim.shape[1]):
        goal = sim[r, j]
        out[:, j] = np.bincount(r[(value > goal) | ((value == goal) & (of < doc[r, j]))], minlength=len(sim))
    return out
