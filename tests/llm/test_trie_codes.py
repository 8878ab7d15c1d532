"""Product codes against the definition with Python's integers, and the walk of the trie."""

import hashlib
import math
from fractions import Fraction

import numpy as np

from rostrum.llm import trie_codes


def plain(rows, parts=4, entries=256, rounds=4):
    """rows: (vec_id, vector, label) with usable vectors only."""
    x = [[math.floor(Fraction(v) * 1024) for v in vector] for _, vector, _ in rows]
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, x[i]))
    d = len(x[0]) // parts
    part = [[v[k * d: (k + 1) * d] for v in x] for k in range(parts)]
    books = [[part[k][i] for i in order[:entries]] for k in range(parts)]

    def near(p, book):
        return min((sum((a - b) ** 2 for a, b in zip(p, e)), i) for i, e in enumerate(book))
    for _ in range(rounds):
        for k in range(parts):
            members = {}
            for p in part[k]:
                members.setdefault(near(p, books[k])[1], []).append(p)
            books[k] = [[sum(c) // len(c) for c in zip(*members[i])] if i in members else e for i, e in enumerate(books[k])]
    found = [[near(part[k][i], books[k]) for k in range(parts)] for i in range(len(rows))]
    errors = [sum(f[0] for f in own) for own in found]
    by_label = {}
    for (_, _, label), e in zip(rows, errors):
        by_label[label] = by_label.get(label, 0) + e
    digest = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    return sorted(((i, "".join(f"{f[1]:02x}" for f in own), e, by_label[label], digest) for (i, _, label), own, e in zip(rows, found, errors)), key=repr)


def result(spark, rows, **more):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, label int, position int, part string")
    return sorted((tuple(r) for r in trie_codes.trie_codes(df, **more).collect()), key=repr)


def test_against_definition(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(v) for v in rng.normal(size=8) * (0.01 if i % 3 else 1)], [None, 1, 2][i % 3]) for i in range(90)]
    rows += rows[:9] + [(100 + i, rows[4][1], 1) for i in range(30)] + [(None, rows[5][1], None), (None, [0.0] * 8, 2), (7, [-1e-20] * 8, 2)]
    rows += [(200 + i, [float(v) for v in rng.integers(-2, 3, 8) / 1024], 3) for i in range(60)]  # many ties and shared prefixes
    odd = [(-1, None, 1), (-2, [None] * 8, 1), (-3, [float("nan")] * 8, 1), (-4, [float("inf")] + [0.0] * 7, 1)]
    for entries in (256, 16, 3):
        assert result(spark, rows + odd, entries=entries) == plain(rows, entries=entries)
    assert result(spark, rows + odd, parts=2, entries=5, rounds=1) == plain(rows, parts=2, entries=5, rounds=1)
    got = result(spark, [*rows, (500, [1.0] * 7, 1), (501, [], 1), (502, [1e300] * 8, 1)])
    assert [r for r in got if r[0] in (500, 501, 502)] == [(i, None, None, next(r[3] for r in got if r[0] == 1), got[0][4]) for i in (500, 501, 502)]
    assert result(spark, odd) == []


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(v) for v in rng.normal(size=4) * 10.0**5], 0) for i in range(40)] + [(50, [1e6, -1e6, 1.0, 0.5], 0)]
    assert result(spark, rows, entries=4) == plain(rows, entries=4)


def test_walk_of_the_trie():
    rng = np.random.default_rng(3)
    for n, low in ((1, 3), (700, 2), (1500, 4), (600, 1)):
        parts, _ = trie_codes._sorted_parts(rng.integers(0, low, (n, 6)))
        book = rng.integers(0, 4, (17, 6))
        far = ((parts[:, None, :] - book[None]) ** 2).sum(axis=2)
        leaves, trie_codes.LEAVES = trie_codes.LEAVES, 64
        try:
            got = list(trie_codes.walk(parts, book))
        finally:
            trie_codes.LEAVES = leaves
        assert np.concatenate([g[1] for g in got]).tolist() == far.argmin(axis=1).tolist()
        assert np.concatenate([g[2] for g in got]).tolist() == far.min(axis=1).tolist()
        repeated = np.repeat(parts, 3, axis=0)  # batches of one position may hold equal parts
        assert np.concatenate([g[1] for g in trie_codes.walk(repeated, book)]).tolist() == np.repeat(far.argmin(axis=1), 3).tolist()
