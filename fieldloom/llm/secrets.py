"""Secrets in texts: three plain patterns, and a token-efficiency test.

Random strings split into many short tokens under a byte-level BPE vocabulary,
while words, names and numbers people write do not. A candidate is a run of
``SHORTEST`` key characters or more; known digests (hex of the usual lengths,
UUIDs) and identifiers (words and numbers joined by separators, capitalised
words joined) are excluded, and of the rest a run with few characters a token is
reported, of letters alone too. Runs under ``LONG`` characters must mix cases or
hold digits beside letters, and are held to a stricter ratio.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame

from fieldloom.llm.common import per_batch
from fieldloom.llm.vocab import tiktoken_bpe

KINDS = ("assign", "access", "hex", "random")
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
SHORTEST, LONG = 16, 20
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
DIGEST = re.compile(r"[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{56}|[0-9a-fA-F]{64}|[0-9a-fA-F]{96}|[0-9a-fA-F]{128}|[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
IDENTIFIER = re.compile(r"(?:[A-Z]?[a-z]{1,15}|[A-Z]{1,15}|[0-9]+)(?:[+/_=-]+(?:[A-Z]?[a-z]{1,15}|[A-Z]{1,15}|[0-9]+))+[+/_=-]*|(?:[A-Z][a-z]{2,12}|[a-z]{3,12})(?:[A-Z][a-z]{2,12})+[0-9]{0,4}")
MIXED = re.compile(r"(?=.*[a-z])(?=.+[A-Z])|(?=.*[0-9])(?=.*[A-Za-z])")
#: Characters a token under which a run is random: of LONG characters or more, and of fewer.
LEAST_CHARS_A_TOKEN, LEAST_OF_SHORT = 1.9, 1.75


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind's place in KINDS) of the plain patterns, ends exclusive, in order."""
    found = []
    low = text.lower() if text.isascii() else text.encode().lower().decode()
    if any(w in low for w in WORDS):
        found += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], s[2]))


def random_spans(text: str, bpe, taken: list[tuple[int, int, int]], least: float = LEAST_CHARS_A_TOKEN) -> list[tuple[int, int, int]]:
    """Candidates outside the spans taken whose characters a token are below ``least``."""
    out = []
    for m in CANDIDATE.finditer(text):
        run = m[0]
        if run.isdigit() or not any(map(str.isalnum, run)) or DIGEST.fullmatch(run) or IDENTIFIER.fullmatch(run):
            continue
        if any(s < m.end() and m.start() < e for s, e, _ in taken):
            continue
        short = len(run) < LONG
        if short and not MIXED.match(run):
            continue
        if len(run) < (least - LEAST_CHARS_A_TOKEN + LEAST_OF_SHORT if short else least) * len(bpe.encode_ordinary(run)):
            out.append((m.start(), m.end(), 3))
    return out


def scan_secrets(docs: DataFrame, least: float = LEAST_CHARS_A_TOKEN, ranks_path: str | None = None) -> DataFrame:
    """doc_id, spans array<struct<kind,start,end>> of every row; code points, by start, then kind as listed.

    Null and empty texts have no spans. Repeated rows are scanned each; other
    columns are not read.
    """

    def make():
        bpe = tiktoken_bpe(ranks_path)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for value in batch.column(1):
                text = value.as_py() or ""
                base = base_spans(text)
                rows.append([{"kind": KINDS[k], "start": s, "end": e} for s, e, k in sorted(base + random_spans(text, bpe, base, least), key=lambda x: (x[0], x[2]))])
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], names=["doc_id", "spans"])

        return one

    return docs.select("doc_id", "text").mapInArrow(per_batch(make), f"doc_id {dict(docs.dtypes)['doc_id']}, spans array<struct<kind:string,start:bigint,end:bigint>>")
