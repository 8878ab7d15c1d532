"""Topic model with learnt priors whose topics × words stay in tables, and a map of its topics.

Variational Bayes in full passes. Documents are stored once in groups of bounded size. In each step a group meets the rows of the words that its documents
hold, estimates its documents in numpy and returns one summed row per word, so that what is shuffled grows with distinct words per group and not
with tokens. Groups are as large as a task's memory allows, as a large group repeats fewer words; inside, documents are estimated in small blocks. A step's
tables and shuffle files go when the next step has its own. Priors move by a Newton step on their likelihood: the document prior has one number per topic, the word prior one per word, which
is a column of the word table. To the driver come sums per topic only.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rostrum.session import Saved, remove_scratch, save_table

SMALL = 1e-30
BLOCK = 20_000  # entries that are estimated at once
PIECE = 5_000  # entries whose expected counts are summed at once, which a core's cache holds


class TopicTables(NamedTuple):
    """words (idx, term, eta, lam: one number per topic), docs (document, gamma likewise), sums of lam per topic, document prior."""
    words: DataFrame
    docs: DataFrame
    sums: list[float]
    alpha: list[float]


def digamma(x: np.ndarray) -> np.ndarray:
    """Derivative of log Γ for positive numbers: six steps of the recurrence, as one fraction, then the asymptotic series."""
    x = np.asarray(x, float)
    z = x + 6
    r, y = 1 / (z * z), x * (x + 5)
    series = np.log(z) - 0.5 * (z * r) - r * (1 / 12 - r * (1 / 120 - r * (1 / 252 - r * (1 / 240 - r * (1 / 132)))))
    return series - (2 * x + 5) * ((3 * y + 20) * y + 24) / (y * (y + 4) * (y + 6))


def trigamma(x: np.ndarray) -> np.ndarray:
    """Second derivative of log Γ for positive numbers."""
    x = np.asarray(x, float)
    z = x + 6
    r = 1 / (z * z)
    series = 1 / z + r / 2 + r / z * (1 / 6 - r * (1 / 30 - r * (1 / 42 - r * (1 / 30 - r * 5 / 66))))
    return series + sum(1 / (x + i) ** 2 for i in range(6))


def _lists(column: pa.ChunkedArray, k: int) -> np.ndarray:
    """Lists of ``k`` numbers each as a matrix."""
    values = column.combine_chunks()
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), k)


def _matrix(values: np.ndarray) -> pa.ListArray:
    n, k = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * k + 1, k, dtype=np.int32)), pa.array(values.ravel()))


def _weights(log: np.ndarray) -> np.ndarray:
    """exp per row up to a factor; the factor cancels, and no row becomes all zero."""
    return np.maximum(np.exp(log - log.max(axis=1, keepdims=True)), SMALL)


def estimate(held: np.ndarray, tf: np.ndarray, alpha: np.ndarray, rounds: int = 60, close: float = 1e-4, check: int = 3) -> np.ndarray:
    """gamma per document; ``held`` has exp E log p up to a factor per document, entry and topic, ``tf`` is zero where a document has no further entry.

    A document rests when its own gamma moves by less than ``close`` on average.
    """
    gamma, live = np.ones((len(tf), len(alpha))), np.arange(len(tf))
    own = gamma
    for n in range(1, rounds + 1):
        theta = _weights(digamma(own))
        new = alpha + theta * np.matmul(_share(held, tf, theta)[:, None], held)[:, 0]
        moved, own = np.abs(new - own).mean(axis=1), new
        if n % check == 0 or n == rounds:
            gamma[live], stay = own, moved >= close
            if not stay.any():
                break
            if not stay.all():
                live, own, held, tf = live[stay], own[stay], held[stay], tf[stay]
    return gamma


def _share(held: np.ndarray, tf: np.ndarray, theta: np.ndarray) -> np.ndarray:
    return tf / np.matmul(held, theta[:, :, None])[:, :, 0]


def _cuts(sizes: np.ndarray) -> list[int]:
    """Borders of blocks of documents sorted by size: at most ``BLOCK`` entries, each document as long as the longest, which is little longer than the shortest."""
    cuts, n = [0], len(sizes)
    while cuts[-1] < n:
        a = cuts[-1]
        z = min(np.searchsorted(sizes, sizes[a] * 5 // 4 + 4, "right"), a + max(1, BLOCK // max(1, sizes[a])))
        fit = np.arange(1, z - a + 1) * sizes[a:z] <= BLOCK
        cuts.append(a + max(1, int(fit.sum())))
    return cuts


def estimate_blocks(rows: np.ndarray, sizes: np.ndarray, tf: np.ndarray, words: np.ndarray, alpha: np.ndarray,
                    close: float = 1e-4, counted: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(gamma per document, expected counts per word and topic) of documents that lie one after the other, block by block.

    ``rows`` are places in ``words``, which holds exp E log p up to a factor. Documents of about one size share a block, so that a round is
    two products of matrices. Without ``counted`` the counts are left out.
    """
    k, starts, order = len(alpha), np.cumsum(sizes) - sizes, np.argsort(sizes, kind="stable")
    gamma, theta, share = np.empty((len(sizes), k)), np.empty((len(sizes), k)), np.empty(len(rows) * counted)
    cuts = _cuts(sizes[order])
    for a, z in zip(cuts, cuts[1:]):
        docs = order[a:z]
        place = np.arange(sizes[docs[-1]])
        some = place < sizes[docs][:, None]
        at = np.where(some, starts[docs][:, None] + place, starts[docs[-1]])
        held, own = words[rows[at]], np.where(some, tf[at], 0.0)
        gamma[docs] = estimate(held, own, alpha, close=close)
        if counted:
            theta[docs] = _weights(digamma(gamma[docs]))
            share[at[some]] = _share(held, own, theta[docs])[some]
    counts = np.zeros((len(words) * counted, k))
    by, of = np.argsort(rows[:len(share)], kind="stable"), np.repeat(np.arange(len(sizes)), sizes)
    for a in range(0, len(share), PIECE):
        at = by[a:a + PIECE]
        own = rows[at]
        firsts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        counts[own[firsts]] += np.add.reduceat(theta[of[at]] * share[at][:, None], firsts)
    return gamma, counts * words[:len(counts)]


def estimate_groups(docs: DataFrame, links: DataFrame, words: DataFrame, doc: str, alpha: list[float], sums: list[float],
                    gammas: bool = True, counts: bool = True, close: float = 1e-4) -> DataFrame:
    """(kind, doc, idx, v): 0 gamma of each document, 1 counts of each word of a group, 2 per group the sum of E log of its documents with their number."""
    k, kind_of = len(alpha), docs.schema[doc].dataType.simpleString()
    prior, total = np.array(alpha), digamma(np.array(sums))

    def kernel(left: pa.Table, right: pa.Table) -> pa.Table:
        idx = right.column("idx").to_numpy()
        order = np.argsort(idx)
        b = _weights(digamma(_lists(right.column("lam"), k)[order]) - total)
        held = left.column("held").combine_chunks()
        entries = held.flatten()
        rows = np.searchsorted(idx[order], entries.field("idx").to_numpy(zero_copy_only=False))
        gamma, found = estimate_blocks(rows, np.diff(held.offsets.to_numpy()), entries.field("tf").to_numpy(zero_copy_only=False).astype(float), b, prior, close, counts)
        logs = digamma(gamma).sum(axis=0) - digamma(gamma.sum(axis=1)).sum()
        n, ids = len(gamma), left.column("doc").combine_chunks()
        gamma, ids, idx = gamma[:n * gammas], ids[:n * gammas], idx[order][:len(found)]
        return pa.table({
            "doc": pa.concat_arrays([ids, pa.nulls(len(idx) + 1, ids.type)]), "idx": pa.concat_arrays([pa.nulls(len(ids), pa.int64()), pa.array(idx), pa.array([n])]),
            "v": _matrix(np.concatenate([gamma, found, logs[None]])), "kind": pa.array([0] * len(ids) + [1] * len(idx) + [2], pa.int32())})

    needed = links.join(words.select("idx", "lam"), "idx")
    left = docs.select("grp", F.col(doc).alias("doc"), "held")
    return left.groupBy("grp").cogroup(needed.groupBy("grp")).applyInArrow(kernel, f"doc {kind_of}, idx long, v array<double>, kind int")


def sum_lists(k: int, column: str) -> Column:
    return F.array(*[F.sum(F.col(column)[i]) for i in range(k)])


def newton(prior: np.ndarray, mean_log: np.ndarray, n: int) -> np.ndarray:
    """A Newton step of a Dirichlet prior given the mean expected logs of ``n`` draws, at most tenfold per entry in either direction."""
    grad = n * (digamma(prior.sum()) - digamma(prior) + mean_log)
    q = -n * trigamma(prior)
    b = (grad / q).sum() / (1 / (n * trigamma(prior.sum())) + (1 / q).sum())
    return np.clip(prior - (grad - b) / q, prior / 10, prior * 10)


def _newton_words(words: DataFrame, sums: list[float]) -> Saved:
    """The words with the same step for their prior as ``next``; only two sums over all words come to the driver."""
    k, total = len(sums), digamma(np.array(sums))
    whole = words.agg(F.sum("eta")).first()[0]

    def kernel(batches):
        of_whole = digamma(np.array(whole))
        for batch in batches:
            t = pa.Table.from_batches([batch])
            if t.num_rows:
                eta = t.column("eta").to_numpy()
                mean_log = (digamma(_lists(t.column("lam"), k)) - total).mean(axis=1)
                grad = k * (of_whole - digamma(eta) + mean_log)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(grad), pa.array(-k * trigamma(eta))], names=[*batch.schema.names, "grad", "q"])

    parts = words.select("idx", "term", "eta", "lam")
    parts = save_table(parts.mapInArrow(kernel, "idx long, term string, eta double, lam array<double>, grad double, q double"), "word-prior")
    up, down = parts.rows.agg(F.sum(F.col("grad") / F.col("q")), F.sum(1 / F.col("q"))).first()
    b = up / (1 / (k * float(trigamma(np.array(whole)))) + down)
    step = F.col("eta") - (F.col("grad") - b) / F.col("q")
    return Saved(parts.rows.select("idx", "term", "eta", "lam", F.greatest(F.col("eta") / 10, F.least(F.col("eta") * 10, step)).alias("next")), parts.path)


def fit_topic_tables(bag: DataFrame, index: DataFrame, k: int = 24, steps: int = 20, doc: str = "doc_id", alpha: float | None = None,
                     eta: float | None = None, learn: bool = True, seed: int = 7, per_group: int = 1_000_000) -> TopicTables:
    """Train on a bag (document, term, tf) over an indexed vocabulary (idx, term) of any size.

    Both priors start at ``1/k`` or at the given number and are learnt unless ``learn`` is false. Start values depend on the words and ``seed``, not
    on the order of rows. Documents without a word of the vocabulary, and null terms, take no part; an empty bag gives a word table of start
    values and no documents. A group holds about ``per_group`` entries, and at least one document.
    """
    spark, entries = bag.sparkSession, F.sort_array(F.collect_list(F.struct(F.col("idx").cast("int").alias("idx"), F.col("tf").cast("double").alias("tf"))))
    whole = save_table(bag.filter(F.col("tf") > 0).join(index.hint("shuffle_hash"), "term").groupBy(doc).agg(entries.alias("held")), "topic-bag")
    n = whole.rows.agg(F.sum(F.size("held"))).first()[0] or 0
    group = F.pmod(F.xxhash64(doc), F.lit(max(1, math.ceil(n / per_group)))).alias("grp")
    docs = whole.rows.select(group, doc, "held")
    links = word_links(docs)
    start = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda t: 0.5 + F.pmod(F.xxhash64("term", t, F.lit(seed)), F.lit(1 << 20)) / (1 << 20))
    words = index.select(F.col("idx").cast("long").alias("idx"), "term", F.lit(float(eta or 1 / k)).alias("eta"), start.alias("lam"))
    words = save_table(words.withColumn("next", F.col("eta")), "topic-words")
    prior = [float(alpha or 1 / k)] * k
    sums = topic_sums(words.rows, k)
    used, gammas = prior, docs.select(doc, F.lit(None).cast("array<double>").alias("gamma"))
    for step in range(steps if n else 0):
        used, last, old = prior, step + 1 == steps, [words.path]
        found = save_table(estimate_groups(docs, links.rows, words.rows, doc, prior, sums, gammas=last), "topic-step", "kind")
        counts = found.rows.filter("kind = 1").groupBy("idx").agg(sum_lists(k, "v").alias("v"))
        held = F.coalesce("v", F.array_repeat(F.lit(0.0), k))
        new = words.rows.join(counts, "idx", "left").select("idx", "term", F.col("next").alias("eta"), F.transform(held, lambda x: x + F.col("next")).alias("lam"))
        words = save_table(new.withColumn("next", F.col("eta")), "topic-words")
        sums = topic_sums(words.rows, k)
        if last:
            gammas = found.rows.filter("kind = 0").select(F.col("doc").alias(doc), F.col("v").alias("gamma"))
        else:
            if learn:
                prior = newton(np.array(prior), *mean_logs(found.rows, k)).tolist()
                old.append(words.path)
                words = _newton_words(words.rows, sums)
            old.append(found.path)
        remove_scratch(spark, *old)
    if n and steps:
        remove_scratch(spark, whole.path, links.path)
    return TopicTables(words.rows.select("idx", "term", "eta", "lam"), gammas, sums, used)


def word_links(docs: DataFrame, *by: str) -> Saved:
    """(grp, idx): the words of each group, each once. A group lies in one value of ``by``."""
    def words(batches):
        for batch in batches:
            held, grp = batch.column("held"), batch.column("grp").to_numpy().astype(np.int64)
            idx = held.flatten().field("idx").to_numpy(zero_copy_only=False)
            pair = np.unique(np.repeat(grp, np.diff(held.offsets.to_numpy())) << 32 | idx)
            own, first = np.unique(grp, return_index=True)
            at = pa.array(first[np.searchsorted(own, pair >> 32)])
            yield pa.RecordBatch.from_arrays([*[batch.column(c).take(at) for c in (*by, "grp")], pa.array(pair & 0xFFFFFFFF)], names=[*by, "grp", "idx"])

    rows = docs.select(*by, "grp", "held")
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in (*by, "grp"))
    return save_table(rows.mapInArrow(words, f"{schema}, idx bigint").distinct(), "topic-links", *by)


def mean_logs(found: DataFrame, k: int) -> tuple[np.ndarray, int]:
    """(mean of E log of the documents' topics, number of documents)."""
    logs = found.filter("kind = 2").agg(sum_lists(k, "v").alias("v"), F.sum("idx").alias("n")).first()
    return np.array(logs["v"]) / logs["n"] if logs["n"] else np.zeros(k), logs["n"] or 0


def topic_sums(words: DataFrame, k: int) -> list[float]:
    return [x or 0.0 for x in words.agg(sum_lists(k, "lam").alias("v")).first()["v"]]


def word_weights(model: TopicTables) -> DataFrame:
    """(topic, term, weight) for all words of all topics; the weights of a topic sum to one."""
    total = F.array(*[F.lit(s) for s in model.sums])
    return model.words.select("term", F.posexplode("lam").alias("topic", "_l")).select("topic", "term", (F.col("_l") / total[F.col("topic")]).alias("weight"))


def document_topics(model: TopicTables, doc: str = "doc_id", min_prob: float = 0.0) -> DataFrame:
    """(doc, topic, prob) of the trained documents."""
    total = F.aggregate("gamma", F.lit(0.0), lambda a, x: a + x)
    rows = model.docs.select(doc, F.posexplode(F.transform("gamma", lambda g: g / total)).alias("topic", "prob"))
    return rows.filter(F.col("prob") >= min_prob)


def topic_distances(weights: DataFrame, topic: str = "topic", term: str = "term", weight: str = "weight") -> DataFrame:
    """Jensen–Shannon divergence (natural logarithm) of every pair of topics a < b, given one row of positive weight per topic and term, each topic's sum one.

    Terms that only one topic of a pair has add half their weight times log 2, so only common terms are paired. Rows multiply by half the number of
    topics of a term and are combined before the shuffle; zero and null weights count as absent.
    """
    w = weights.filter(F.col(weight) > 0).select(F.col(topic).alias("t"), F.col(term).alias("term"), F.col(weight).alias("p"))
    held = w.groupBy("term").agg(F.sort_array(F.collect_list(F.struct("t", "p"))).alias("h"))
    rest = _later_pairs(held)
    p, q = F.col("a.p"), F.col("b.p")
    mean = (p + q) / 2
    gain = p * F.log(p / mean) + q * F.log(q / mean) - (p + q) * math.log(2)
    common = rest.groupBy(F.col("a.t").alias("a"), F.col("b.t").alias("b")).agg(F.sum(gain).alias("g"))
    pairs = _later_pairs(w.agg(F.sort_array(F.collect_set("t")).alias("h")))  # as many entries as topics
    return pairs.join(common, ["a", "b"], "left").select("a", "b", (math.log(2) + F.coalesce("g", F.lit(0.0)) / 2).alias("distance"))


def _later_pairs(lists: DataFrame, column: str = "h") -> DataFrame:
    """(a, b): every entry of a list with each later one."""
    each = lists.select(F.posexplode(column).alias("i", "a"), column)
    return each.select("a", F.explode(F.slice(column, F.col("i") + 2, F.size(column))).alias("b"))


def topic_map(distances: DataFrame, limit: int = 1000) -> DataFrame:
    """(topic, x, y): the two main principal coordinates of the topics, the largest coordinate of each axis positive.

    The matrix has one number per pair of topics and is solved on the driver; more than ``limit`` topics are an error.
    """
    spark, kind = distances.sparkSession, distances.schema["a"].dataType.simpleString()
    rows = distances.limit(limit * (limit - 1) // 2 + 1).collect()
    topics = sorted({t for r in rows for t in (r["a"], r["b"])})
    if len(rows) > limit * (limit - 1) // 2:
        raise ValueError(f"more than {limit} topics")
    at = {t: i for i, t in enumerate(topics)}
    squared = np.zeros((len(topics), len(topics)))
    for r in rows:
        squared[at[r["a"]], at[r["b"]]] = squared[at[r["b"]], at[r["a"]]] = r["distance"] ** 2
    axes = np.zeros((len(topics), 2))
    if topics:
        centred = -0.5 * (squared - squared.mean(0) - squared.mean(1)[:, None] + squared.mean())
        values, vectors = np.linalg.eigh(centred)
        for j, i in enumerate(np.argsort(-values)[:2]):
            axis = vectors[:, i] * math.sqrt(max(values[i], 0.0))
            axes[:, j] = axis * (1 if axis[np.argmax(np.abs(axis))] >= 0 else -1)
    return spark.createDataFrame([(t, float(x), float(y)) for t, (x, y) in zip(topics, axes)], f"topic {kind}, x double, y double")
