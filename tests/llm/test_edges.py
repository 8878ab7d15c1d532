"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names in every operator, and small brute-force checks."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rostrum.llm import covertree, importance, jaccard, licenses, packing, preference, quality_rules, toxicity
from rostrum.llm.components import components
from rostrum.llm.fixed import kth_largest

CLEAN = "alpha beta gamma delta epsilon zeta eta theta iota kappa " * 8


@pytest.fixture(scope="module")
def odd(spark):
    """Rows with nulls, an empty, a blank and a long text, repeats, and columns named like those that operators add."""
    rows = [(1, CLEAN, "h"), (2, CLEAN, "h"), (2, CLEAN, "h"), (3, None, None), (4, "", "h"), (5, " \n\t", "h"), (6, "a b", "h"), (7, "A  B", "g"),
            (None, CLEAN, "h"), (None, "own words here only", None), (8, "x" * 300_000, "g"), (9, "w%d " * 20_000 % tuple(range(20_000)), "g")]
    return spark.createDataFrame([r + (1, "n", "k") for r in rows], "doc_id long, text string, source string, n long, node string, kept string")


def test_jaccard(spark, odd):
    rows = jaccard.jaccard_components(odd).collect()
    assert len(rows) == odd.count()
    by_id = {r.doc_id: (r.n_shingles, r.component_id) for r in rows if r.doc_id is not None}
    assert by_id[1][1] == by_id[2][1] == 1 and by_id[6] == (1, 6) and by_id[7] == (1, 6)
    assert by_id[3] == (0, 3) and by_id[4] == (0, 4) and by_id[5] == (0, 5) and by_id[8] == (1, 8)
    assert sorted((r.n_shingles, r.component_id) for r in rows if r.doc_id is None) == [(2, None), (by_id[1][0], 1)] or \
        {r.component_id for r in rows if r.doc_id is None} == {1, None}
    assert jaccard.jaccard_components(odd.limit(0)).count() == 0


def test_jaccard_links_by_all_pairs(spark):
    """Chains and groups around the threshold, with one passage that all share."""
    rng = np.random.default_rng(2)
    base = [f"v{i}" for i in range(400)]
    texts = []
    for g in range(12):
        own = [f"g{g}w{i}" for i in range(60)] + base[: int(rng.integers(0, 60))]
        for _ in range(12):
            t = list(own)
            for k in rng.integers(0, len(t), int(rng.integers(0, 3))):
                t[k] = f"r{rng.integers(10**6)}"
            texts.append(" ".join(t))
    texts += texts[:5]
    sets = [{tuple(t.split()[i: i + 3]) for i in range(len(t.split()) - 2)} for t in texts]
    comp = list(range(len(texts)))

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i
    for i, j in itertools.combinations(range(len(texts)), 2):
        both = len(sets[i] & sets[j])
        if 100 * both >= 90 * len(sets[i] | sets[j]):
            a, b = sorted((find(i), find(j)))
            comp[b] = a
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(docs).collect()}
    assert got == {i: find(i) for i in range(len(texts))}
    assert 5 < len(set(got.values())) < len(texts)


def test_bitmaps_bound_the_overlap():
    rng = np.random.default_rng(4)
    for _ in range(200):
        pool = rng.integers(0, 2**63, 300).astype(np.uint64)
        a, b = (np.unique(rng.choice(pool, rng.integers(1, 200))) for _ in range(2))
        maps = jaccard.fold([jaccard.bitmap(a), jaccard.bitmap(b)])
        most = min(len(a) - int(np.bitwise_count(maps[0] & ~maps[1]).sum()), len(b) - int(np.bitwise_count(maps[1] & ~maps[0]).sum()))
        assert most >= len(np.intersect1d(a, b))


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7), (None, 3)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_rules(spark, odd):
    rows = quality_rules.quality_rules(odd).collect()
    assert len(rows) == odd.count()
    assert {(r.n_words, r.base_failed, r.kept) for r in rows if r.doc_id in (3, 4, 5)} == {(0, True, False)}
    nine = next(r for r in rows if r.doc_id == 9)
    assert nine.kept and nine.n_words == 20_000
    line = "this very line stands in all documents of the host here"
    docs = [(i, (line + "\n") + " ".join(f"q{i}x{k}" for k in range(60)), "h") for i in range(40)]
    docs += [(100 + i, "\n".join([line, f"u{i} v{i} w{i}"]) + " " + "\n".join([line] * 8), "h") for i in range(3)] + [(200, line + " " + line, "other")]
    got = {r.doc_id: r for r in quality_rules.quality_rules(spark.createDataFrame(docs, "doc_id long, text string, source string")).collect()}
    assert all(got[i].kept and got[i].n_left == 60 for i in range(40))
    assert all(not got[100 + i].kept for i in range(3)) and got[200].n_left == got[200].n_words
    assert quality_rules.quality_rules(odd.limit(0)).count() == 0


def test_rules_count_documents_that_share_several_lines(spark):
    """A block of lines that all documents hold, and copies, which count once."""
    for shared in (2, 5, 30):
        block = [f"Shared  line {k} of the navigation block" for k in range(shared)]
        own = [[f"own{i}x{k} and more" for k in range(2)] for i in range(21)]
        docs = [(i, "\n".join([*block, *own[i]]), "h") for i in range(21)]
        docs += [(100 + i, "\n".join(b.upper() for b in [*block[:1], "one page in many copies"]), "g") for i in range(60)]
        docs += [(200 + i, "\n".join([*block, *own[i]]), "i") for i in range(20)]
        got = {r.doc_id: r for r in quality_rules.quality_rules(spark.createDataFrame(docs, "doc_id long, text string, source string")).collect()}
        assert {got[i].n_left for i in range(21)} == {6}
        assert all(got[i].n_left == got[i].n_words for i in got if i >= 100)


def test_rules_return_the_text_without_common_lines(spark):
    docs = [(i, f"Own {i}\n\n  HOME  page \n x{i}\tÉ \nhome page", "h") for i in range(21)] + [(100, "Home page\nb", "g"), (101, None, "h"), (102, "home page", "h")]
    got = {r.doc_id: r for r in quality_rules.quality_rules(spark.createDataFrame(docs, "doc_id long, text string, source string")).collect()}
    assert all(got[i].cleaned == f"Own {i}\n\n x{i}\tÉ " and got[i].n_left == 4 for i in range(21))
    assert got[100].cleaned == "Home page\nb" and got[101].cleaned is None and got[102].cleaned == "" and got[102].n_left == 0


def test_packing_of_odd_rows(spark, odd):
    rows = packing.pack(odd, __import__("public_tokenizers").path("word_bpe_49k.json")).collect()
    assert sum(r.length for r in rows if r.doc_id == 3) == 1 and sum(r.length for r in rows if r.doc_id == 4) == 1


def test_toxicity_on_unseen_spellings(spark, odd):
    rng = np.random.default_rng(0)
    plain = [f"{a}{b}" for a in ("ta", "ro", "mi", "ne", "lu") for b in ("ska", "ton", "ver", "lim", "do")]
    bad = ["grumblox", "grumbler", "grumblet", "snarfled"]

    def text(toxic):
        w = list(rng.choice(plain, 40))
        if toxic:
            w[int(rng.integers(40))] = str(rng.choice(bad))
        return " ".join(w)
    y = [i % 2 for i in range(400)]
    model = toxicity.train([text(v).encode() for v in y], y)
    docs = spark.createDataFrame([(0, text(0)), (1, text(0) + " grumblex"), (2, None), (3, ""), (4, text(0) * 50 + " snarfler " + text(0) * 50)], "doc_id long, text string")
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert [got[i].predicted for i in range(5)] == [0, 1, 0, 0, 1]
    assert got[2].score == got[3].score and all(0 <= r.score <= 1 for r in got.values())
    labels = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    rows = toxicity.toxicity(odd, labels).collect()
    assert len(rows) == odd.count() and {r.predicted for r in rows} == {0}
    assert {r.doc_id: r.held_out for r in rows}[None] is False


def test_sampling(spark, odd):
    values = [float(v) for v in np.random.default_rng(1).normal(size=500)] + [0.0, -0.0, 1e300, -1e300, 5.0, 5.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for k in (1, 2, 3, 250, len(values)):
        assert kth_largest(df, "v", k) == sorted(values, reverse=True)[k - 1]
    assert kth_largest(df, "v", len(values) + 1) is None
    docs = spark.createDataFrame([(i, ("good clear words here " if i % 4 else "|| %% !! ") * 30) for i in range(200)] + [(None, None), (300, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(bool(i % 4))) for i in range(200)], "doc_id long, quality int")
    rows = importance.importance_sample(docs, labels, share=0.7).collect()
    assert len(rows) == 202 and sum(r.kept for r in rows) == math.ceil(0.7 * 202)
    assert all(r.doc_id % 4 for r in rows if r.kept and r.doc_id is not None and r.doc_id < 200)
    clash = docs.select("*", F.lit(1).alias("key"), F.lit("x").alias("log_weight"), F.lit(2).alias("row"))
    whole = importance.importance_sample(clash, labels, share=0.7, whole_rows=True)
    assert whole.columns == clash.columns and whole.count() == math.ceil(0.7 * 202)
    clean, poor = docs.filter("doc_id % 4 <> 0"), docs.filter("doc_id % 4 = 0 and doc_id < 200")
    assert all(r.kept for r in importance.importance_sample(clean, labels).collect())
    few = clean.limit(30).union(poor)
    assert {r.doc_id for r in importance.importance_sample(few, labels).collect() if r.kept} == {r.doc_id for r in clean.limit(30).collect()}
    nothing = importance.importance_sample(odd.limit(0), labels)
    assert nothing.count() == 0


def test_preference_pairs(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "one"), (1, 2, "user", "more <|im_end|>"), (1, 3, "assistant", "two"), (2, 0, None, None), (2, 0, None, None),
             (3, 0, "assistant", "only"), (None, 5, "user", "x")]
    convs = preference.conversations(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    got = {r.conv_id: r for r in preference.preference(preference.stale_answers(convs)).collect()}
    one = got[1]
    assert one.n_prompt_turns == 3 and "more < |im_end|>" in one.prompt
    assert [one.chosen_completion[s.start: s.end] for s in one.chosen_mask] == ["two<|im_end|>\n"]
    assert [one.rejected_completion[s.start: s.end] for s in one.rejected_mask] == ["one<|im_end|>\n"]
    assert not got[2].usable and not got[None].usable and got[3].rejected_completion == "<|im_start|>assistant\n<|im_end|>\n"
    none = spark.createDataFrame([(None, None)], "chosen array<struct<role:string,text:string>>, rejected array<struct<role:string,text:string>>")
    assert preference.preference(none).first().prompt == "" and preference.conversations(spark.createDataFrame(turns[:1], "conv_id long, turn long, role string, text string").limit(0)).count() == 0


def test_vectors_by_all_pairs(spark):
    rng = np.random.default_rng(8)
    x = [list(map(float, v)) for v in rng.normal(size=(150, 8))]
    x += [[float(a + 0.1 * b) for a, b in zip(x[i % 5], rng.normal(size=8))] for i in range(60)] + [x[3]] * 4 + [[2 * a for a in x[3]]]
    x += [None, [0.0] * 8, [float("nan")] * 8, [None] * 8, [float("inf")] + [0.0] * 7, [], [1.0, 2.0], [2.0, 4.0], [1e-200] * 8, [1e200] * 8]
    df = spark.createDataFrame([(i, v, 0) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    units = [np.array(v) / np.abs(v).max() if v and None not in v and np.isfinite(np.array(v)).all() and np.any(v) else None for v in x]
    links = {i: set() for i in range(len(x))}
    for i, j in itertools.combinations(range(len(x)), 2):
        a, b = units[i], units[j]
        if a is not None and b is not None and len(a) == len(b) and a @ b / math.sqrt((a @ a) * (b @ b)) >= 0.95:
            links[i].add(j)
            links[j].add(i)
    component = list(range(len(x)))
    for _ in x:
        component = [min([component[i], *(component[j] for j in links[i])]) for i in range(len(x))]
    for block in (8192, 40):
        got = {r.vec_id: r for r in covertree.near_duplicates(df, block=block).collect()}
        assert {i: got[i].n_links for i in got} == {i: len(s) for i, s in links.items()}
        assert [got[i].component_id for i in range(len(x))] == component
        assert all(got[i].kept == (component[i] == i) for i in got)
    assert covertree.near_duplicates(df.limit(0)).count() == 0


def test_licenses(spark, odd):
    texts = ["text here\nReleased under the MIT License.\nmore", "Licensed under CC BY 4.0.", "licensed under cc by-nc 4.0", "no notice, a driver's license only",
             "This work is licensed under the GNU General Public License, version 2.", "w " * 500 + "All rights reserved. " + "v " * 500,
             "Permission is hereby granted, free of charge, to any person obtaining a copy of these software and associated documentation files, "
             "to deal in the Software without restriction", "Released under the BSD License.", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: ([n.license for n in r.notices], r.restricted) for r in licenses.license_scan(docs).collect()}
    assert got == {0: (["MIT"], False), 1: (["CC-BY-4.0"], False), 2: (["CC-BY-NC-4.0"], True), 3: ([], False), 4: (["GPL-2.0"], True), 5: (["reserved"], True),
                   6: (["MIT-text"], False), 7: ([], False), 8: ([], False), 9: ([], False)}
    own = sorted((r.doc_id is None, r.doc_id or 0) for r in odd.collect())
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in licenses.license_scan(odd).collect()) == own
    assert licenses.license_scan(odd.limit(0)).count() == 0


def test_wrapped_and_long_license_notices():
    scanner = licenses.Scanner()
    wrapped = {"MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"),\n"
                           "to deal in the Software without\nrestriction",
               "BSD": "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following\nconditions are met:",
               "GPL-2.0": "This work is licensed under the GNU\nGeneral Public License,\nversion 2.", "Apache-2.0": "Licensed under the Apache License,\nVersion 2.0.",
               "reserved": "All\nrights\nreserved."}
    for name, text in wrapped.items():
        for prefix in ("", "# ", " * ", "// ", ";; ", "-- ", "> > "):
            marked = "".join(prefix + line + "\n" for line in text.split("\n"))
            for before, after in (("", ""), ("import os\n\n", "\nint main()"), ("word and copyright law " * 9, " in the software, of the public " * 9)):
                assert [n[0] for n in scanner.scan((before + marked + after).encode())[1]] == [name], (name, prefix, before)
    # a long stretch of notices: each counts once, wherever a window ends
    for lead in range(0, 60, 7):
        names = [n for k in range(40) for n in wrapped] + ["GPL-3.0"]
        texts = [wrapped.get(n, licenses.TEMPLATES[n]) for n in names]
        assert [n[0] for n in scanner.scan(("license " * lead + "\n".join(texts)).encode())[1]] == names
    # words around a confirmed notice do not make another one
    assert [n[0] for n in scanner.scan(b"all Released under the MIT License. rights reserved")[1]] == ["MIT"]


def test_compression_ranks_templates():
    """Two templates fit a place equally well by words; the one that saves more bytes is taken, whatever its name."""
    common = "this material may be used by any person under the terms of the open sharing licence as published in the year by the foundation of"
    near, far = f"{common} northern counterrevolutionaries", f"{common} northern xq"
    text = f"notice. {common} southern counterrevolutionaries."
    for a, b in (("a", "b"), ("b", "a")):
        scanner = licenses.Scanner({a: near, b: far})
        assert [n[0] for n in scanner.scan(text.encode())[1]] == [a]
        ranks = scanner.ranked(licenses.words(text.encode()))
        assert [r[1] for r in ranks] == [a, b] and ranks[0][0] > ranks[1][0]
        scanner.ranked = lambda block: [(9, name) for name in ("a", "b")]  # without compression the name would decide
        scanner.judged.cache_clear()
        blind = [n[0] for n in scanner.scan(text.encode())[1]]
        assert blind == ["a"]


def test_exact_notices_by_brute_force():
    """Every place of a template's words in a text of notices, parts of notices and other words is found, and no other."""
    import random
    rng = random.Random(3)
    scanner = licenses.Scanner()
    names = sorted(licenses.TEMPLATES)
    for _ in range(150):
        parts = []
        for _ in range(rng.randrange(1, 12)):
            own = licenses.TEMPLATES[rng.choice(names)].split()
            cut = rng.randrange(1, len(own))
            parts.append(rng.choice([" ".join(own), "\n * ".join(own), " ".join(own[:cut]) + " zebra", "copyright of words", "plain words " * rng.randrange(1, 90)]))
        text = ". zebra ".join(parts).encode()
        found, want, at = licenses.words(text), [], 0
        while at < len(found):  # notices hold no other notice, so the longest at each place counts
            hits = [n for n in names if found[at: at + len(scanner.words[n])] == scanner.words[n]]
            name = max(hits, key=lambda n: len(scanner.words[n]), default=None)
            want += [name] if name else []
            at += len(scanner.words[name]) if name else 1
        assert [n for n, c, _ in scanner.scan(text)[1] if c == 0] == want, text


def test_license_headers_by_version():
    scanner = licenses.Scanner()
    header = ("This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU {}General Public License as published by\n"
              "the Free Software Foundation, either version {} of the License, or\n(at your option) any later version.\n")
    for kind, version, name in (("", "3", "GPL-3.0-header"), ("", "2", "GPL-2.0-header"), ("Lesser ", "3", "LGPL-3.0"), ("Affero ", "3", "AGPL-3.0"), ("Lesser ", "2.1", "LGPL-2.1")):
        marked = "".join(f"// {line}\n" for line in header.format(kind, version).split("\n"))
        assert [n[0] for n in scanner.scan(marked.encode())[1]] == [name]


def test_block_of_near_copies():
    """One block of 8,192 near copies: every pair is a link, none is kept in memory."""
    import tracemalloc
    rng = np.random.default_rng(9)
    x = rng.normal(size=16) + 0.01 * rng.normal(size=(8192, 16))
    x /= np.linalg.norm(x, axis=1)[:, None]
    owners = covertree.levels(x, [1.0, 0.5, 0.25, 0.125])
    side = covertree.Tree(x, owners), np.arange(8192), np.ones(8192, np.int64)
    tracemalloc.start()
    out = list(covertree._tile(side, side, True, 0.95))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300 << 20
    assert set(out[0].column("n").to_pylist()) == {8191} and set(out[0].column("mate").to_pylist()) == {None, 0}


def test_dual_traversal_by_all_pairs():
    rng = np.random.default_rng(10)
    for spread in (0.0, 0.05, 0.3, 5.0):
        centres = rng.normal(size=(30, 8))
        x = centres[rng.integers(0, 30, 900)] + spread * rng.normal(size=(900, 8))
        x /= np.linalg.norm(x, axis=1)[:, None]
        a, b = (covertree.Tree(p, covertree.levels(p, [1.0, 0.5, 0.25, 0.125])) for p in (x[:500], x[500:]))
        got = {(int(i), int(j)) for p, q in covertree.pairs(a, b, 0.95, chunk=64) for i, j in zip(p, q)}
        g = x[:500] @ x[500:].T
        assert got >= {(int(i), int(j)) for i, j in zip(*np.nonzero(g >= 0.95 + 1e-12))} and got <= {(int(i), int(j)) for i, j in zip(*np.nonzero(g >= 0.95 - 1e-12))}
