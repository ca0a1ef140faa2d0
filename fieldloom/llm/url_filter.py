"""URL rules as one bit-parallel wildcard automaton.

All glob rules are packed into the bits of a few 64-bit words. Bit k of a rule
means that its first k symbols are read; a byte moves all rules at once:
``(state & step[byte]) << 1 | state & loop[byte]``, with the carry between words.
``*`` is any run of bytes but ``/``, ``**`` any run, ``?`` one byte but ``/``.
The canonical form of a URL is a dot, its host and its path, so ``*.org/**``
fits the host org and its subdomains, whatever the path.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fieldloom.llm.common import per_batch


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    @property
    def glob(self) -> str:
        return f"*.{self.host}{self.path}**"


BASE = (Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"), Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"))
#: Globs over the canonical form that decide where no base rule fits; the first that matches holds, else allow.
EXTRA = (
    ("allow", "*.gov/**"), ("allow", "*.edu/**"), ("allow", "*.wikipedia.org/wiki/**"),
    ("block", "*spam**"), ("block", "*.cheap-*/**"), ("block", "*.free-*-download*/**"), ("block", "*.ad?.*/**"), ("block", "*.adserver.**"), ("block", "*.doubleclick.**"), ("block", "*.track*.*/**"),
    ("block", "**/ads/**"), ("block", "**/adclick**"), ("block", "**/banner/**"), ("block", "**/popup/**"), ("block", "**/wp-login.php"), ("block", "**/wp-admin/**"), ("block", "**/cgi-bin/**"), ("block", "**/cart/**"), ("block", "**/checkout/**"), ("block", "**/login/**"), ("block", "**/signup/**"),
    ("block", "**casino**"), ("block", "**poker**"), ("block", "**porn**"), ("block", "**xxx**"), ("block", "**viagra**"), ("block", "**payday-loan**"), ("block", "**torrent**"), ("block", "**warez**"),
    ("block", "**.exe"), ("block", "**.zip"), ("block", "**.iso"), ("block", "**.css"), ("block", "**.js"), ("block", "**.png"), ("block", "**.jpg"), ("block", "**.gif"),
)
#: Bits of a tile: rules beyond it go to the next, so the state of a batch is rows by TILE bits at any number of rules.
TILE, MOST_RULES = 4096, 1_000_000
SLASH = ord("/")


class Automaton:
    """Multiword Shift-And over any number of globs."""

    def __init__(self, globs: list[str]):
        parsed = [self._parse(g) for g in globs]
        size = sum(len(p) + 1 for p, _ in parsed)
        self.words = (size + 63) // 64 or 1
        self.step, self.loop = np.zeros((256, self.words), np.uint64), np.zeros((256, self.words), np.uint64)
        self.start, self.final = np.zeros(self.words, np.uint64), []
        at = 0
        no_slash = [c for c in range(256) if c != SLASH]
        for symbols, loops in parsed:
            self._set(self.start, at)
            for k, s in enumerate(symbols):
                for c in no_slash if s is None else [s]:
                    self._set(self.step[c], at + k)
            for k, deep in loops.items():
                for c in range(256) if deep else no_slash:
                    self._set(self.loop[c], at + k)
            at += len(symbols) + 1
            self.final.append(at - 1)

    @staticmethod
    def _set(words: np.ndarray, bit: int) -> None:
        words[bit // 64] |= np.uint64(1 << bit % 64)

    @staticmethod
    def _parse(glob: str) -> tuple[list[int | None], dict[int, bool]]:
        symbols: list[int | None] = []
        loops: dict[int, bool] = {}
        raw, i = glob.encode(), 0
        while i < len(raw):
            if raw[i : i + 1] == b"*":
                deep = raw[i : i + 2] == b"**"
                loops[len(symbols)] = loops.get(len(symbols), False) or deep
                i += 1 + deep
            else:
                symbols.append(None if raw[i : i + 1] == b"?" else raw[i])
                i += 1
        return symbols, loops

    def match(self, texts: list[bytes]) -> np.ndarray:
        """Boolean matrix: text by glob."""
        n = len(texts)
        order = sorted(range(n), key=lambda i: -len(texts[i]))
        lengths = np.array([len(texts[i]) for i in order], np.int64)
        starts = np.zeros(n, np.int64)
        np.cumsum(lengths[:-1], out=starts[1:])
        flat = np.frombuffer(b"".join(texts[i] for i in order), np.uint8)
        state = np.tile(self.start, (n, 1))
        one, top = np.uint64(1), np.uint64(63)
        live = n
        for j in range(int(lengths[0]) if n else 0):
            while live and lengths[live - 1] <= j:
                live -= 1
            byte = flat[starts[:live] + j]
            moved = state[:live] & self.step[byte]
            shifted = moved << one
            shifted[:, 1:] |= moved[:, :-1] >> top
            state[:live] = shifted | (state[:live] & self.loop[byte])
        out = np.zeros((n, len(self.final)), bool)
        for k, bit in enumerate(self.final):
            out[order, k] = (state[:, bit // 64] >> np.uint64(bit % 64)) & one != 0
        return out


def match_all(globs: list[str], tile: int = TILE) -> list[tuple[int, Automaton]]:
    """Automata of at most about ``tile`` bits each, with the place of each one's first glob."""
    out, at, bits = [], 0, 0
    for i, g in enumerate(globs):
        n = len(g.encode()) + 1
        if i > at and bits + n > tile:
            out.append((at, Automaton(globs[at:i])))
            at, bits = i, 0
        bits += n
    return [*out, (at, Automaton(globs[at:]))] if globs else out


def first_match(automata: list[tuple[int, Automaton]], texts: list[bytes], none: int) -> np.ndarray:
    """The place of the first glob that matches each text, else ``none``; a text that has one skips later tiles."""
    found = np.full(len(texts), none)
    left = np.arange(len(texts))
    for at, auto in automata:
        hit = auto.match([texts[i] for i in left])
        some = hit.any(axis=1)
        found[left[some]] = at + hit[some].argmax(axis=1)
        left = left[~some]
        if not len(left):
            break
    return found


def rules_of(table: DataFrame, most: int = MOST_RULES) -> tuple[tuple[str, str], ...]:
    """(verdict, glob) rules from a table (place, verdict, glob), in the order of place; more than ``most`` are an error."""
    rows = table.orderBy("place", "glob").select("verdict", "glob").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rules")
    return tuple((r["verdict"], r["glob"]) for r in rows if r["glob"])


def split_url(url: str | None) -> tuple[str, str]:
    """Host, with A-Z lower-cased, and path; both empty for null or without ``://``."""
    _, sep, rest = (url or "").partition("://")
    if not sep:
        return "", ""
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    host, rest = rest[:end], rest[end:]
    if not host.isascii():
        host = host.encode().lower().decode()
    path = rest[: min((i for i in map(rest.find, "?#") if i >= 0), default=len(rest))]
    return host.lower() if host.isascii() else host, path


def judge_urls(pages: DataFrame, rules: tuple[Rule, ...] = BASE, extra: tuple[tuple[str, str], ...] = EXTRA, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict, glob of every row.

    The longest base rule that fits gives the verdict (of two of one length the
    earlier); otherwise the first extra glob that matches does, and else the
    verdict is allow. ``glob`` names the extra glob that decided. A rule for an
    empty host fits nothing. Null and empty urls, and those without ``://``, have
    no host and no path and are allowed by default. Repeated rows are judged
    each; an empty table gives no rows; other columns are not read.
    """
    ranked = sorted((r for r in rules if r.host), key=lambda r: -len(r.name))

    def make():
        automata = match_all([r.glob for r in ranked] + [g for _, g in extra])
        names, verdicts = [*(r.name for r in ranked), None], [*(r.verdict for r in ranked), *(v for v, _ in extra), "allow"]
        globs = [*(g for _, g in extra), None]
        m = len(ranked)

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            parts = [split_url(u) for u in batch.column(1).to_pylist()]
            first = first_match(automata, [f".{h}{p}".encode() if h else b"" for h, p in parts], len(verdicts) - 1)
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array([h for h, _ in parts], pa.string()), pa.array([p for _, p in parts], pa.string()), pa.array([names[min(k, m)] for k in first], pa.string()), pa.array([verdicts[k] for k in first], pa.string()), pa.array([globs[k - m] if k >= m else None for k in first], pa.string())], names=[id_col, "host", "path", "rule", "verdict", "glob"])

        return one

    kind = dict(pages.dtypes)[id_col]
    return pages.select(id_col, url_col).mapInArrow(per_batch(make), f"`{id_col}` {kind}, host string, path string, rule string, verdict string, glob string")
