"""Topic model on tables: special functions, exact masses, learnt priors, and the map of topics."""

import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from rostrum.operators import topic_tables as T, topics as TM
from rostrum.operators.topics import index_vocabulary, relevance
from rostrum.session import shared_root


def test_special_functions():
    x = np.array([0.01, 0.5, 1.0, 2.0, 7.3, 1000.0])
    assert T.digamma(np.array(1.0)) == pytest.approx(-0.5772156649015329, abs=1e-10) and T.trigamma(np.array(1.0)) == pytest.approx(math.pi ** 2 / 6, abs=1e-10)
    assert np.allclose(T.digamma(x + 1) - T.digamma(x), 1 / x, rtol=1e-9) and np.allclose(T.trigamma(x) - T.trigamma(x + 1), 1 / x ** 2, rtol=1e-9)
    h = 1e-5
    assert np.allclose([(math.lgamma(v + h) - math.lgamma(v - h)) / (2 * h) for v in x[1:]], T.digamma(x[1:]), rtol=1e-5, atol=1e-5)


def groups(spark, n=60):
    rng = np.random.default_rng(4)
    rows = [(d, f"{'ab'[d % 2]}{w}", int(c)) for d in range(n) for w, c in enumerate(rng.integers(0, 6, 12)) if c]
    return spark.createDataFrame(rows, "doc_id long, term string, tf long")


def test_disjoint_groups_and_priors(spark):
    bag = groups(spark)
    index = index_vocabulary(bag.groupBy("term").agg(F.sum("tf").alias("freq")))
    model = T.fit_topic_tables(bag, index, k=2, steps=12, alpha=3.0, eta=3.0, per_group=150)
    mass = {(r.topic, r.g): r.w for r in T.word_weights(model).groupBy("topic", F.substring("term", 1, 1).alias("g")).agg(F.sum("weight").alias("w")).collect()}
    assert sorted(max(("a", "b"), key=lambda g: mass[t, g]) for t in (0, 1)) == ["a", "b"] and all(max(mass[t, "a"], mass[t, "b"]) > 0.95 for t in (0, 1))
    assert max(model.alpha) < 1.0  # both priors left their start far behind
    assert model.words.agg(F.max("eta")).first()[0] < 1.5
    top = T.document_topics(model).groupBy("doc_id").agg(F.max("prob").alias("p"), F.sum("prob").alias("s")).collect()
    assert len(top) == 60 and all(r.p > 0.95 and abs(r.s - 1) < 1e-9 for r in top)
    lengths = bag.groupBy("doc_id").agg(F.sum("tf").alias("n"))
    terms = relevance(T.word_weights(model), bag.groupBy("term").agg(F.sum("tf").alias("freq")), T.document_topics(model), lengths).collect()
    assert len(terms) == 2 * model.words.count() and sum({r.topic: r.prevalence for r in terms}.values()) == pytest.approx(1)
    words = {r.term: sum(r.lam) - 2 * r.eta for r in model.words.collect()}
    freq = {r.term: r.n for r in bag.groupBy("term").agg(F.sum("tf").alias("n")).collect()}
    assert words == pytest.approx(freq, rel=1e-9)
    sizes = {r.doc_id: r.n for r in bag.groupBy("doc_id").agg(F.sum("tf").alias("n")).collect()}
    assert {r.doc_id: sum(r.gamma) - sum(model.alpha) for r in model.docs.collect()} == pytest.approx(sizes, rel=1e-9)


def test_empty_bag(spark):
    bag = groups(spark, 2).limit(0)
    index = spark.createDataFrame([(0, "a"), (1, "b")], "idx long, term string")
    model = T.fit_topic_tables(bag, index, k=3, steps=2)
    assert model.words.count() == 2 and model.docs.count() == 0


def test_topic_distances_and_map(spark):
    rng = np.random.default_rng(1)
    p = rng.random((5, 9)) * (rng.random((5, 9)) < 0.6) + np.eye(5, 9)
    p /= p.sum(1, keepdims=True)
    rows = [(t, f"w{w}", float(p[t, w])) for t in range(5) for w in range(9)]
    got = {(r.a, r.b): r.distance for r in T.topic_distances(spark.createDataFrame(rows, "topic int, term string, weight double")).collect()}

    def part(a, m):
        return sum(x * math.log(x / y) for x, y in zip(a, m) if x > 0)
    want = {(a, b): (part(p[a], (p[a] + p[b]) / 2) + part(p[b], (p[a] + p[b]) / 2)) / 2 for a in range(5) for b in range(a + 1, 5)}
    assert got == pytest.approx(want, rel=1e-9)
    points = rng.normal(size=(6, 2))
    flat = [(a, b, float(np.linalg.norm(points[a] - points[b]))) for a in range(6) for b in range(a + 1, 6)]
    at = {r.topic: np.array([r.x, r.y]) for r in T.topic_map(spark.createDataFrame(flat, "a int, b int, distance double")).collect()}
    assert all(np.linalg.norm(at[a] - at[b]) == pytest.approx(d, rel=1e-9) for a, b, d in flat)  # a plane is kept as it is
    with pytest.raises(ValueError):
        T.topic_map(spark.createDataFrame(flat, "a int, b int, distance double"), limit=5)
    assert T.topic_map(spark.createDataFrame([], "a int, b int, distance double")).count() == 0


def test_blocks_and_groups_change_nothing(spark, monkeypatch):
    rng = np.random.default_rng(8)
    sizes, words, alpha = rng.integers(1, 30, 50), rng.random((40, 3)) + 0.01, np.full(3, 0.2)
    rows, tf = rng.integers(0, 40, sizes.sum()), rng.integers(1, 5, sizes.sum()).astype(float)
    gamma, counts = T.estimate_blocks(rows, sizes, tf, words, alpha)
    monkeypatch.setattr(T, "BLOCK", 40)
    small, again = T.estimate_blocks(rows, sizes, tf, words, alpha)
    assert np.allclose(gamma, small, rtol=1e-9) and np.allclose(counts, again, rtol=1e-9) and counts.sum() == pytest.approx(tf.sum())
    assert [len(x) for x in T.estimate_blocks(rows[:0], sizes[:0], tf[:0], words[:0], alpha)] == [0, 0]


def test_scratch_tables_of_steps_are_removed(spark):
    root = os.path.join(shared_root(spark).removeprefix("file:"), "rostrum")
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    bag = groups(spark)
    T.fit_topic_tables(bag, index_vocabulary(bag.groupBy("term").agg(F.sum("tf").alias("freq"))), k=2, steps=3, per_group=150)
    assert len([f for f in set(os.listdir(root)) - before if f.startswith(("topic-", "word-"))]) == 2  # the words, and the last step with the documents


def test_trained_model_holds_no_matrix_on_the_driver(spark):
    rows = [(i // 2, ["alma", "körte", "alma"] if i % 2 else ["busz", "vonat"]) for i in range(60)] + [(90, []), (None, ["alma"]), (91, None), (92, ["x"])]
    docs = spark.createDataFrame(rows, "doc_id bigint, toks array<string>")
    index = index_vocabulary(docs.select(F.explode("toks").alias("term")).filter("term <> 'x'").groupBy("term").agg(F.count("*").alias("freq")))
    vectors = TM.index_vectors(docs, index)
    assert vectors.count() == 64 and vectors.filter("size(features) = 0").count() == 2 and vectors.filter("features is null").count() == 1
    model = TM.fit_lda(vectors, k=2, size=4, chunk=20, per_group=9)  # several chunks of several groups
    assert model.words.count() == 4 and len(model.sums) == 2 == len(model.alpha)
    d = TM.topic_distribution(model, vectors, min_prob=0, per_group=9).groupBy("doc_id").agg(F.count("*").alias("n"), F.sum("prob").alias("s")).collect()
    got = {r.doc_id: (r.n, round(r.s, 9)) for r in d}
    assert got == {**{i: (4, 2.0) for i in range(30)}, 90: (2, 0.0), 92: (2, 0.0), None: (2, 1.0)}  # one distribution per row, also of a repeated id
    words = TM.topic_words(model, index).collect()
    assert len(words) == 8 and all(sum(r.weight for r in words if r.topic == t) == pytest.approx(1) for t in (0, 1))
    top = TM.topic_top_words(model, index, 1).collect()
    assert {(r.topic, r["rank"]) for r in top} == {(0, 1), (1, 1)} and all(r.weight == max(w.weight for w in words if w.topic == r.topic) for r in top)
    empty = TM.fit_lda(vectors.limit(0), k=2, size=4)
    assert empty.words.count() == 4 and TM.topic_distribution(empty, vectors.limit(0)).count() == 0


def test_documents_of_one_size_share_a_block(spark, monkeypatch):
    """A round is two products of matrices with little padding; the numbers are those of one document after the other."""
    rng = np.random.default_rng(3)
    sizes, words, alpha = rng.integers(1, 120, 400), rng.random((300, 4)) + 0.01, np.array([0.1, 0.5, 0.2, 0.3])
    rows, tf, seen, run = rng.integers(0, 300, sizes.sum()), rng.integers(1, 5, sizes.sum()).astype(float), [], T.estimate
    monkeypatch.setattr(T, "estimate", lambda held, tf, *a, **b: (seen.append((held.shape, tf.shape)), run(held, tf, *a, **b))[1])
    gamma, counts = T.estimate_blocks(rows, sizes, tf, words, alpha)
    assert sum(t[0] for _, t in seen) == 400 and len(seen) < 40 and all(h == (*t, 4) and t[0] * t[1] <= T.BLOCK for h, t in seen)
    assert sum(a * b for _, (a, b) in seen) < 1.3 * sizes.sum()
    want = np.zeros(words.shape)
    for d, a in enumerate(np.cumsum(sizes) - sizes):
        own, n, g = rows[a:a + sizes[d]], tf[a:a + sizes[d]], np.ones(4)
        for step in range(1, 61):
            p = np.exp(T.digamma(g)) * words[own]
            new = alpha + (p * (n / p.sum(axis=1))[:, None]).sum(axis=0)
            moved, g = np.abs(new - g).mean(), new
            if step % 3 == 0 and moved < 1e-4:
                break
        assert np.allclose(gamma[d], g, rtol=1e-9)
        p = np.exp(T.digamma(g)) * words[own]
        np.add.at(want, own, p * (n / p.sum(axis=1))[:, None])
    assert np.allclose(counts, want, rtol=1e-9)
    again, none = T.estimate_blocks(rows, sizes, tf, words, alpha, counted=False)
    assert np.array_equal(again, gamma) and none.shape == (0, 4)


def test_links_hold_each_word_of_a_group_once(spark):
    docs = spark.createDataFrame([(g, c, [(i, 1.0) for i in held]) for g, c, held in ((0, 0, [1, 2]), (0, 0, [2, 5]), (1, 0, [2]), (2, 1, [1, 5]))],
                                 "grp int, chunk int, held array<struct<idx:int,tf:double>>").coalesce(1)
    links = T.word_links(docs, "chunk").rows
    assert sorted((r.chunk, r.grp, r.idx) for r in links.collect()) == [(0, 0, 1), (0, 0, 2), (0, 0, 5), (0, 1, 2), (1, 2, 1), (1, 2, 5)]
