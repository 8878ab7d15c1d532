"""Topic model: vectors, training, topics of documents and words of topics.

Topics × words stay in a table from the first step to the last; the driver holds sums per topic and the document prior.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from rostrum.operators import aggregates as A
from rostrum.operators.ordered import top_topics_per_doc
from rostrum.operators.rows import unnest
from rostrum.operators.topic_tables import estimate_groups, mean_logs, newton, sum_lists, topic_sums, word_links
from rostrum.session import cut_lineage, remove_scratch, save_table


class TopicModel(NamedTuple):
    """words (idx, lam: one number per topic), sums of lam per topic, document prior."""
    words: DataFrame
    sums: list[float]
    alpha: list[float]


def vocabulary_list(vocab: DataFrame, term: str = "term", freq: str = "freq", limit: int = 500_000) -> list[str]:
    """Vocabulary in its order as a list of at most ``limit`` words; a larger one stays a table (``index_vocabulary``)."""
    words = [r[0] for r in vocab.orderBy(F.col(freq).desc(), term).select(term).limit(limit + 1).toLocalIterator()]
    if len(words) > limit:
        raise ValueError(f"vocabulary has more than {limit} words; raise the minimum count")
    return words


def vectorize(docs: DataFrame, vocab: list[str], tokens: str = "toks", out: str = "features") -> DataFrame:
    """Sparse word counts over the vocabulary; other words are ignored."""
    model = CountVectorizerModel.from_vocabulary(vocab, inputCol=tokens, outputCol=out)
    return model.transform(docs).drop(tokens)


def index_vocabulary(vocab: DataFrame, term: str = "term", freq: str = "freq") -> DataFrame:
    """(idx, term) of a vocabulary of any size, most frequent words first.

    Words are sorted by range; the index is the place in the partition plus the sizes of the partitions before.
    """
    ordered = cut_lineage(vocab.orderBy(F.col(freq).desc(), term).select(term, F.monotonically_increasing_id().alias("_id")))
    part = F.shiftright("_id", 33)
    sizes = ordered.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))  # one row per partition of the sort
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    place = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return ordered.join(F.broadcast(before), part == F.col("_part")).select((F.col("_before") + place).alias("idx"), term)


def term_vectors(docs: DataFrame, index: DataFrame, doc: str = "doc_id", tokens: str = "toks") -> DataFrame:
    """Sparse word counts over an indexed vocabulary of any size as rows → (doc, idx, term, tf)."""
    return A.bag_of_words(docs, doc, tokens).join(index, "term").select(doc, "idx", "term", "tf")


def index_vectors(docs: DataFrame, index: DataFrame, doc: str = "doc_id", tokens: str = "toks", out: str = "features") -> DataFrame:
    """``vectorize`` over an indexed vocabulary of any size → (doc, out: array of (idx, tf)), one row per row of ``docs``; null without tokens.

    Words are counted in pieces of many rows, and each piece looks up its different words once: what is shuffled with a word is the piece and not the row.
    """
    spark, kind_of = docs.sparkSession, docs.schema[doc].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        for nr, piece in enumerate(p for b in batches for p in A.pieces(b, "toks")):
            toks, ids = piece.column("toks"), piece.column("doc")
            row, code, n, words = A.count_in_rows(toks)
            held = _packed(row, code, n, toks)
            rows, terms = len(toks), len(words)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(rows + terms, first + nr)), pa.concat_arrays([ids, pa.nulls(terms, ids.type)]), pa.concat_arrays([held, pa.nulls(terms, held.type)]),
                pa.array(np.r_[np.zeros(rows, np.int32), np.arange(terms, dtype=np.int32)]), pa.concat_arrays([pa.nulls(rows, words.type), words]),
                pa.array(np.repeat([0, 1], [rows, terms]), pa.int32())], names=["piece", "doc", "held", "code", "term", "kind"])

    def look_up(left: pa.Table, right: pa.Table) -> pa.Table:
        held, code = left.column("held").combine_chunks(), right.column("code").to_numpy()
        entries = np.frombuffer(b"".join(v for v in held.to_pylist() if v), np.int32).reshape(-1, 2)
        place = np.full(1 + max(entries[:, 0].max(initial=0), code.max(initial=0)), -1, np.int64)
        place[code] = right.column("idx").to_numpy()
        row = np.repeat(np.arange(len(held)), pc.fill_null(pc.binary_length(held), 0).to_numpy(zero_copy_only=False) // 8)
        idx = place[entries[:, 0]]
        kept = np.lexsort((idx, row))
        kept = kept[idx[kept] >= 0]
        ends = np.cumsum(np.bincount(row[kept], minlength=len(held)), dtype=np.int32)
        found = pa.StructArray.from_arrays([pa.array(idx[kept], pa.int32()), pa.array(entries[kept, 1], pa.float64())], names=["idx", "tf"])
        return pa.table({doc: left.column("doc"), out: pa.ListArray.from_arrays(pa.array(np.r_[np.int32(0), ends]), found, mask=held.is_null())})

    counted = docs.select(F.col(doc).alias("doc"), F.col(tokens).alias("toks")).mapInArrow(count, f"piece bigint, doc {kind_of}, held binary, code int, term string, kind int")
    counted = save_table(counted, "topic-rows", "kind")
    known = counted.rows.filter("kind = 1").join(index.hint("shuffle_hash"), "term").select(F.col("piece").alias("of"), "code", F.col("idx").cast("long").alias("idx"))
    rows = counted.rows.filter("kind = 0").select("piece", "doc", "held").groupBy("piece").cogroup(known.groupBy("of"))
    rows = save_table(rows.applyInArrow(look_up, f"`{doc}` {kind_of}, `{out}` array<struct<idx:int,tf:double>>"), "topic-vectors").rows
    remove_scratch(spark, counted.path)
    return rows


def _packed(row: np.ndarray, code: np.ndarray, n: np.ndarray, like: pa.ListArray) -> pa.Array:
    """Pairs of 32-bit numbers in the order of their rows as one binary value per row, which Spark moves faster than lists; null where ``like`` is."""
    ends = np.cumsum(np.bincount(row, minlength=len(like)) * 8).astype(np.int32)
    values = np.stack([code, n], axis=1).astype(np.int32)
    valid = pa.array(~like.is_null().to_numpy(zero_copy_only=False))
    return pa.Array.from_buffers(pa.binary(), len(like), [valid.buffers()[1], pa.py_buffer(np.r_[np.int32(0), ends]), pa.py_buffer(values)])


def _entries(vectors: DataFrame, features: str) -> Column:
    """The (idx, tf) of a sparse vector or of an array of them."""
    if isinstance(vectors.schema[features].dataType, T.ArrayType):
        return F.col(features)
    v = F.unwrap_udt(features)
    return F.zip_with(v["indices"], v["values"], lambda i, x: F.struct(i.alias("idx"), x.alias("tf")))


def vector_terms(vectors: DataFrame, vocab: list[str], doc: str = "doc_id", features: str = "features") -> DataFrame:
    """Sparse vectors back as (doc, term, tf) rows."""
    v = F.unwrap_udt(features)
    rows = unnest(vectors, doc, e=F.arrays_zip(v["indices"].alias("idx"), v["values"].alias("tf")))
    rows = rows.select(doc, "e.idx", F.col("e.tf").cast("long").alias("tf"))
    return rows.join(vocabulary_table(vectors.sparkSession, vocab), "idx").select(doc, "term", "tf")


def vector_lengths(vectors: DataFrame, doc: str = "doc_id", features: str = "features") -> DataFrame:
    """Vocabulary words per document → (doc, n)."""
    return vectors.select(doc, F.aggregate(_entries(vectors, features), F.lit(0.0), lambda a, e: a + e["tf"]).alias("n"))


def vocabulary_table(spark: SparkSession, vocab: list[str]) -> DataFrame:
    return spark.createDataFrame(list(enumerate(vocab)), "idx int, term string")


def fit_lda(vectors: DataFrame, k: int = 24, passes: int = 1, chunk: int = 50_000, seed: int = 7, features: str = "features",
            min_steps: int = 10, offset: float = 1.0, decay: float = 0.51, size: int | None = None, per_group: int = 400_000) -> TopicModel:
    """Online variational training in mini-batches of about ``chunk`` documents, document prior learnt.

    Step n moves the model by the share (offset + n)^-decay, so that few steps suffice. Documents are dealt to chunks once and each step reads one
    chunk, in groups of about ``per_group`` entries (see ``topic_tables``). ``size`` is the number of words; without it that of the vectors.
    """
    spark, held = vectors.sparkSession, _entries(vectors, features)
    if size is None:
        size = vectors.agg(F.max(F.unwrap_udt(features)["size"])).first()[0] or 0
    n, filled, entries = vectors.agg(F.count("*"), F.count_if(F.size(held) > 0), F.coalesce(F.sum(F.size(held)), F.lit(0))).first()
    steps, chunks = max(min_steps, passes * math.ceil(n / chunk)), max(1, math.ceil(n / chunk))
    groups = max(1, math.ceil(entries / chunks / per_group))
    start = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda t: 0.9 + F.pmod(F.xxhash64(F.lit(seed), "id", t), F.lit(1 << 20)) / (5 << 20))
    words = save_table(spark.range(size).select(F.col("id").alias("idx"), start.alias("lam")), "topic-words")
    sums, alpha = topic_sums(words.rows, k), np.full(k, 1 / k)
    if not filled:
        return TopicModel(words.rows, sums, alpha.tolist())
    place = F.floor(F.rand(seed) * chunks * groups).cast("int")  # copies of a text must not meet in one group
    dealt = vectors.select(held.alias("held"), place.alias("grp")).filter(F.size("held") > 0).repartition("grp")
    docs = save_table(dealt.withColumn("chunk", (F.col("grp") / groups).cast("int")), "topic-docs", "chunk")
    links = word_links(docs.rows, "chunk")
    for step in range(steps):
        own = F.col("chunk") == step % chunks
        found = save_table(estimate_groups(docs.rows.filter(own), links.rows.filter(own), words.rows, "grp", alpha.tolist(), sums, gammas=False, close=1e-3), "topic-step", "kind")
        logs, batch = mean_logs(found.rows, k)
        rate, old = (offset + step + 1) ** -decay, words
        if batch:
            counts = found.rows.filter("kind = 1").groupBy("idx").agg(sum_lists(k, "v").alias("v"))
            target = F.transform(F.coalesce("v", F.array_repeat(F.lit(0.0), k)), lambda x: rate * (1 / k + x * (filled / batch)))
            new = words.rows.join(counts, "idx", "left").select("idx", F.zip_with("lam", target, lambda a, b: (1 - rate) * a + b).alias("lam"))
            words = save_table(new, "topic-words")
            sums = topic_sums(words.rows, k)
            alpha = alpha + rate * (newton(alpha, logs, batch) - alpha)
            remove_scratch(spark, old.path)
        remove_scratch(spark, found.path)
    remove_scratch(spark, docs.path, links.path)
    return TopicModel(words.rows, sums, alpha.tolist())


def topic_distribution(model: TopicModel, vectors: DataFrame, doc: str = "doc_id", min_prob: float = 0.01, features: str = "features",
                       per_group: int = 1_000_000) -> DataFrame:
    """Topics of each document → (doc, topic, prob); entries below ``min_prob`` are dropped. A document without known words has only zeros."""
    k, held = len(model.alpha), _entries(vectors, features)
    rows = vectors.select(doc, held.alias("held"))
    groups = max(1, math.ceil((rows.agg(F.sum(F.size("held"))).first()[0] or 0) / per_group))
    docs = save_table(rows.filter(F.size("held") > 0).select(F.floor(F.rand(7) * groups).cast("int").alias("grp"), doc, "held"), "topic-docs").rows
    found = estimate_groups(docs, word_links(docs).rows, model.words, doc, model.alpha, model.sums, counts=False, close=1e-3).filter("kind = 0")
    total = F.aggregate("v", F.lit(0.0), lambda a, x: a + x)
    shares = found.select(F.col("doc").alias(doc), total.alias("_s"), "v")
    none = rows.filter(F.size("held") == 0).select(doc, F.lit(1.0), F.array_repeat(F.lit(0.0), k))
    each = shares.union(none).select(doc, "_s", F.posexplode_outer("v").alias("topic", "prob"))
    return each.select(doc, "topic", (F.col("prob") / F.col("_s")).alias("prob")).filter(F.col("prob") >= min_prob)


def topic_words(model: TopicModel, vocab: Sequence[str] | DataFrame, n: int | None = None) -> DataFrame:
    """(topic, rank, term, weight) for the ``n`` heaviest words of each topic, or for all; ``vocab`` is a list or (idx, term)."""
    total = F.array(*[F.lit(s) for s in model.sums])
    rows = model.words.select("idx", F.posexplode("lam").alias("topic", "_l")).select("topic", "idx", (F.col("_l") / total[F.col("topic")]).alias("weight"))
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("topic").orderBy(F.desc("weight"), "idx")))
    names = vocab if isinstance(vocab, DataFrame) else vocabulary_table(model.words.sparkSession, list(vocab))
    return (rows if n is None else rows.filter(F.col("rank") <= n)).join(names, "idx").select("topic", "rank", "term", "weight")


def topic_top_words(model: TopicModel, vocab: Sequence[str] | DataFrame, n: int = 40) -> DataFrame:
    return topic_words(model, vocab, n)


def topic_relevance(model: TopicModel, vocab: Sequence[str] | DataFrame, counts: DataFrame, distribution: DataFrame, lengths: DataFrame,
                    lam: float = 0.6, doc: str = "doc_id") -> DataFrame:
    return relevance(topic_words(model, vocab), counts, distribution, lengths, lam, doc)


def relevance(weights: DataFrame, counts: DataFrame, distribution: DataFrame, lengths: DataFrame, lam: float = 0.6, doc: str = "doc_id") -> DataFrame:
    """Prevalence of each topic and relevance of each word: λ·log p(w|t) + (1−λ)·log p(w|t)/p(w), for (topic, term, weight) of any model.

    ``counts`` is (term, freq) over the vocabulary, ``lengths`` (doc, n) its words per document.
    """
    share = cut_lineage(distribution.join(lengths, doc).groupBy("topic").agg(F.sum(F.col("prob") * F.col("n")).alias("_s")))  # read twice
    total = share.agg(F.sum("_s")).scalar()
    tokens = counts.agg(F.sum("freq")).scalar()
    marginal = counts.select("term", (F.col("freq") / tokens).alias("_p"))
    rows = weights.join(marginal, "term").join(
        share.select("topic", (F.col("_s") / total).alias("prevalence")), "topic", "left")
    score = lam * F.log("weight") + (1 - lam) * F.log(F.col("weight") / F.col("_p"))
    return rows.select("topic", "prevalence", "term", "weight", score.alias("relevance"))


def topic_edges(distribution: DataFrame, k: int, n: int = 3, doc: str = "doc_id") -> DataFrame:
    """Topic graph edges from the leading topics of each document (at most ``n`` per group)."""
    top = top_topics_per_doc(distribution, n, doc).groupBy(doc).agg(F.collect_list("topic").alias("topics"))
    return A.topic_cooccurrence(top, k)
