"""Source divergence against a plain computation over every term and pair."""

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from rostrum.llm import divergence


def plain(rows, least=3, top=200):
    docs = [(a or "", b or "", [w for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))])
            for a, b, t in rows]
    found, counts, groups = Counter(), defaultdict(Counter), defaultdict(set)
    for lang, source, words in docs:
        found.update({(lang, w) for w in words})
        counts[lang, source].update(words)
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = sorted(w for (a, w), n in found.items() if a == lang and n >= least)
        n = {s: sum(counts[lang, s][w] for w in kept) for s in sources}
        p = {(s, w): 1 + 10**9 * (counts[lang, s][w] + 1) // (n[s] + len(kept)) for s in sources for w in kept}
        q = {w: 1 + 10**9 * (sum(counts[lang, s][w] for s in sources) + 1) // (sum(n.values()) + len(kept)) for w in kept}
        for s in sources:
            pairs = [(sum((p[s, w] - p[t, w]) ** 2 // p[t, w] for w in kept), t) for t in sources if t != s]
            terms = [((p[s, w] - q[w]) ** 2 // q[w], w) for w in kept if counts[lang, s][w] and p[s, w] > q[w]]
            for part, items, limit in (("pair", pairs, None), ("term", terms, top)):
                items = sorted(items, key=lambda x: (-x[0], x[1].encode()))[:limit]
                out += [(lang, s, part, w, v, k + 1) for k, (v, w) in enumerate(items)]
    return sorted(out)


def table(spark, rows):
    more = [(a, b, t, 1, "x", "y") for a, b, t in rows]  # columns named like those that the operator makes
    return spark.createDataFrame(more, "lang string, source string, text string, idx int, term string, value string")


def result(df, **more):
    return sorted(tuple(r) for r in divergence.source_divergence(df, **more).collect())


def test_against_plain_computation(spark):
    rng = np.random.default_rng(3)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)] + ["Éclair", "straße", "日本", "\U00010400x"]
    rows = []
    for i in range(260):
        lang, source = ["en", "de", "\x1f", ""][int(rng.integers(4))], ["hot", "hot", "s1", "s2", "s 3", "\x1fs"][int(rng.integers(6))]
        own = words[: 40 + 10 * len(source)]
        rows.append((lang, source, " ".join(rng.choice(own, int(rng.integers(0, 60)))) + "  A-b_c9D "))
    rows += rows[:20] + [(None, None, None), ("en", None, ""), ("en", "numbers", "12 34 ... 5"), (None, "hot", "wa wb"), ("xx", "lone", "seldom words"),
                         ("xx", "other", "never twice"), ("en", "s1", "long " * 50_000), ("en", "s1", "Z" * 200_000)]
    want = plain(rows)
    assert result(table(spark, rows)) == want
    assert {r[2] for r in want} == {"pair", "term"} and ("xx", "lone", "pair", "other", 0, 1) in want
    assert result(table(spark, rows), min_documents=2, top=5) == plain(rows, 2, 5)


def test_nothing_kept_and_empty_table(spark):
    rows = [("en", "a", "x y"), ("en", "b", "z"), ("en", "b", None)]
    assert result(table(spark, rows)) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]
    assert result(table(spark, rows).limit(0)) == []


def test_shared_terms_do_not_depend_on_batches():
    rng = np.random.default_rng(5)
    rows = sorted((int(i), s) for i in range(60) for s in "abcdefg" if rng.random() < 0.6)
    p0 = {s: int(rng.integers(1, 50)) for s in "abcdefg"}
    whole = pa.RecordBatch.from_pydict({
        "idx": pa.array([i for i, _ in rows], pa.int32()), "lang": ["en" if i % 2 else "de" for i, _ in rows], "source": [s for _, s in rows],
        "p": pa.array([int(v) for v in rng.integers(50, 10**9, len(rows))]), "p0": pa.array([p0[s] for _, s in rows])})

    def total(batches):
        out = Counter()
        for b in divergence._shared(batches):
            for r in b.to_pylist():
                out[r["lang"], r["source"], r["other"]] += r["value"]
        return out
    want = total(iter([whole]))
    step, divergence.STEP = divergence.STEP, 10
    try:
        for size in (1, 3, 50):
            assert total(whole.slice(a, size) for a in range(0, len(rows), size)) == want
    finally:
        divergence.STEP = step
    assert len(want) == 84
