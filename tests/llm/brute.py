"""Plain Python versions of the operators, for small tables."""

import hashlib
import re
import zlib
from collections import Counter

SPACES = re.compile(r"[\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def exact(rows):
    plain = {d: SPACES.sub(" ", t or "") for d, t in rows}
    least, n = {}, Counter(plain.values())
    for d in sorted(plain):
        least.setdefault(plain[d], d)
    return {d: (least[p], n[p], least[p] == d, sha(p)) for d, p in plain.items()}


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    n = Counter(grams)
    covered = {j for i, g in enumerate(grams) if n[g] > 1 for j in range(i, i + 3)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


def url(u):
    if u is None or "://" not in u:
        return "", ""
    rest = u.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def rule(host, path):
    fit = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[1:] if fit else (None, None)


def pieces(ids, capacity=1024):
    n = len(ids)
    head = n % capacity or capacity
    cuts = [0, *range(head, n + 1, capacity)]
    return [(i, a, b - a, zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids[a:b]))) for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]


def conversation(turns):
    """turns: (role, text) in order."""
    loss = "".join(t for r, t in turns if r == "assistant")
    return len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss)


def secrets(text):
    text = text or ""
    found = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        if len(m[2]) >= 6:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    kinds = ("assign", "access", "hex")
    return [f"{kinds[k]}:{s}:{e}" for s, k, e in sorted(found)]


def shingles(text, k=3):
    words = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORD.findall(words)
    if not words:
        return frozenset()
    return frozenset([tuple(words)]) if len(words) < k else frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def near(rows, k=3, share=85):
    sets = {d: shingles(t, k) for d, t in rows}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by = {}
    for d, s in sets.items():
        for g in s:
            by.setdefault(g, []).append(d)
    pairs = Counter((a, b) for ds in by.values() for i, a in enumerate(ds) for b in ds[i + 1 :])
    for (a, b), n in pairs.items():
        if 100 * n >= share * (len(sets[a]) + len(sets[b]) - n):
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return {d: (len(sets[d]), find(d), find(d) == d) for d in sets}


def repeats(rows, size=400):
    data = {d: (t or "").encode() for d, t in rows}
    n = Counter(b[i : i + size] for b in data.values() for i in range(len(b) - size + 1))
    out = {}
    for d, b in data.items():
        gone = bytearray(len(b))
        for i in range(len(b) - size + 1):
            if n[b[i : i + size]] > 1:
                gone[i : i + size] = b"\1" * size
        left = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[d] = (len(b), sum(gone), spans, hashlib.sha256(left).hexdigest())
    return out
