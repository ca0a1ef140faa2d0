import hashlib
import random

import numpy as np

from fieldloom.operators.dedupe import semantic_dedupe


def vector(text):
    v = np.zeros(512)
    for t in text.lower().split():
        v[int(hashlib.md5(t.encode()).hexdigest()[:8], 16) % 512] += 1
    return (v / (np.sqrt((v * v).sum()) + 1e-9)).astype(np.float32)


def greedy(rows, least=0.9, cap=4):
    by = {}
    for n, family, text in rows:
        by.setdefault(family, []).append((n, vector(text)))
    out = []
    for own in by.values():
        if len(own) > cap:
            kept = []
            for n, v in own:
                if len(kept) < cap and all(v @ w < least for _, w in kept):
                    kept.append((n, v))
            own = kept
        out += own
    kept = []
    for n, v in sorted(out, key=lambda x: x[0]):
        if all(v @ w < least for _, w in kept):
            kept.append((n, v))
    return {n for n, _ in kept}


def test_semantic_dedupe(spark):
    rnd = random.Random(4)
    bases = [" ".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") * 3 for _ in range(12)) for _ in range(12)]
    rows = []
    for n in range(120):
        words = rnd.choice(bases).split()
        for _ in range(rnd.randrange(3)):
            words[rnd.randrange(12)] = f"x{rnd.randrange(6)}"
        rows.append((n, f"f{rnd.randrange(25)}", " ".join(words)))
    rows.append((120, "f0", ""))
    got = semantic_dedupe(spark.createDataFrame(rows, "n long, family string, text string").repartition(3), "n", "text", "family")
    assert {r.n for r in got.collect()} == greedy(rows)
