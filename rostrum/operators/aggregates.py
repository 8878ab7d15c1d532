"""Counts, facets and histograms. All group-bys combine on the map side, so hot values shuffle one row per task."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from rostrum.functions.text import pad_topic
from rostrum.operators.filters import Period, filter_vocab, keep_pos, period_label
from rostrum.operators.rows import unnest

PIECE = 1 << 20  # words that are counted at once


def word_count(df: DataFrame, tokens: str, term: str = "term", out: str = "freq") -> DataFrame:
    """Corpus frequency of each token of an array column."""
    return unnest(df, **{term: tokens}).groupBy(term).agg(F.count("*").alias(out))


def pieces(batch: pa.RecordBatch, *columns: str) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``PIECE`` items of some array columns, at least one row each."""
    run = np.cumsum(sum(list_sizes(batch.column(c)) for c in columns)) // PIECE
    cuts = [0, *(np.flatnonzero(run[1:] != run[:-1]) + 1).tolist(), batch.num_rows]
    for a, z in zip(cuts, cuts[1:]):
        if z > a:
            yield batch.slice(a, z - a)


def list_sizes(lists: pa.ListArray) -> np.ndarray:
    """Items of each list; none of a null."""
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def coded(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(row, code) of each word, the code negative for a null, and the words by code."""
    words = lists.flatten().dictionary_encode()
    code = pc.fill_null(words.indices.cast(pa.int64()), -1).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(lists)), list_sizes(lists)), code, words.dictionary


def count_in_rows(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """(row, code, count) of the different non-null words of each row, and the words by code."""
    row, code, words = coded(lists)
    n = max(1, len(words))
    key = np.sort((row * n + code)[code >= 0])
    firsts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][:len(key)])
    return key[firsts] // n, key[firsts] % n, np.diff(np.append(firsts, len(key))), words


def bag_of_words(df: DataFrame, doc: str, tokens: str, term: str = "term", out: str = "tf") -> DataFrame:
    """Counts per document and term. The input has one row per document, so the words are counted inside it, unshuffled, many rows at a time."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in (p for b in batches for p in pieces(b, "toks")):
            row, code, n, words = count_in_rows(piece.column("toks"))
            yield pa.RecordBatch.from_arrays([piece.column("doc").take(pa.array(row)), words.take(pa.array(code)), pa.array(n, pa.int64())], names=[doc, term, out])

    kind, item = df.schema[doc].dataType.simpleString(), df.schema[tokens].dataType.elementType.simpleString()
    return df.select(F.col(doc).alias("doc"), F.col(tokens).alias("toks")).mapInArrow(count, f"`{doc}` {kind}, `{term}` {item}, `{out}` bigint")


def doc_frequency(df: DataFrame, tokens: str, term: str = "term", out: str = "df") -> DataFrame:
    """Number of documents per term; duplicates go inside the row, so documents need no shuffle."""
    return unnest(df, **{term: F.array_distinct(tokens)}).groupBy(term).agg(F.count("*").alias(out))


def value_counts(df: DataFrame, column: str, out: str = "count") -> DataFrame:
    """Counts of the non-null values, most frequent first."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias(out))
    return counts.orderBy(F.col(out).desc(), F.col(column))


def inlink_count(triples: DataFrame, target: str = "o") -> DataFrame:
    """Links per target, most linked first."""
    return value_counts(triples.select(F.col(target).alias("uri")), "uri", "freq").select("freq", "uri")


def facet_terms(df: DataFrame, facets: Mapping[str, str], size: int = 25) -> DataFrame:
    """Top values of several facets in one pass → (facet, value, count).

    A document counts once per distinct value, also for list columns. Only ``size`` rows per facet and task
    reach the final ranking.
    """
    def entries(facet: str, column: str) -> Column:
        c = F.col(column)
        values = c if isinstance(df.schema[column].dataType, T.ArrayType) else F.array(c)
        return F.transform(F.array_distinct(F.coalesce(values.cast("array<string>"), F.array().cast("array<string>"))),
                           lambda v: F.struct(F.lit(facet).alias("facet"), v.alias("value")))

    exploded = unnest(df, e=F.concat(*[entries(f, c) for f, c in facets.items()])).select("e.*")
    counts = exploded.filter("value is not null").groupBy("facet", "value").agg(F.count("*").alias("count"))
    rn = F.row_number().over(Window.partitionBy("facet").orderBy(F.desc("count"), "value"))
    return counts.withColumn("_rn", rn).filter(F.col("_rn") <= size).drop("_rn")


def facet_term_dates(df: DataFrame, term: str = "term", date: str = "date", terms: int = 10, dates: int = 10_000) -> DataFrame:
    """First terms in order, each with its first dates in order → (term, date, count).

    Terms are text and sort as text. The result has one row per sitting day, a calendar-bounded number.
    """
    keyed = df.filter(F.col(term).isNotNull()).select(F.col(term).cast("string").alias(term), date)
    first = keyed.groupBy(term).agg(F.count("*").alias("term_count")).orderBy(term).limit(terms)
    counts = keyed.filter(F.col(date).isNotNull()).groupBy(term, date).agg(F.count("*").alias("count"))
    rn = F.row_number().over(Window.partitionBy(term).orderBy(date))
    capped = counts.withColumn("_rn", rn).filter(F.col("_rn") <= dates).drop("_rn")
    return first.join(capped, term, "left").select(term, "term_count", date, "count")


def hit_histogram(df: DataFrame, date: str = "date", unit: str = "month") -> DataFrame:
    """Hits over time."""
    return df.groupBy(F.trunc(date, unit).alias("bucket")).agg(F.count("*").alias("count"))


def indexed_sittings(df: DataFrame, term: int | str, term_col: str = "term", nr: str = "sitting_nr", size: int | None = None) -> DataFrame:
    """Sitting numbers of a term, in textual order; all of them, or the first ``size``."""
    of_term = df.filter(F.col(term_col).cast("string") == str(term)).filter(F.col(nr).isNotNull())
    found = of_term.select(F.col(nr).cast("string").alias(nr)).distinct().orderBy(nr)
    return found if size is None else found.limit(size)


def topic_cooccurrence(doc_topics: DataFrame, k: int, topics: str = "topics") -> DataFrame:
    """How often two topics share a document, for all pairs of ``k`` topics → (source, target, weight).

    ``topics`` holds the few leading topics of a document; both they and the nodes are padded to two digits.
    """
    spark: SparkSession = doc_topics.sparkSession
    padded = doc_topics.select(F.array_sort(F.transform(topics, pad_topic)).alias("t"))
    pairs = F.flatten(F.transform("t", lambda a, i: F.transform(
        F.slice("t", i + 2, F.greatest(F.size("t"), F.lit(1))), lambda b: F.struct(a.alias("source"), b.alias("target")))))
    seen = unnest(padded, p=pairs).select("p.*").groupBy("source", "target").agg(F.count("*").alias("n"))
    nodes = spark.range(k - 1).select(F.col("id").alias("a"), F.explode(F.sequence(F.col("id") + 1, F.lit(k - 1))).alias("b"))
    edges = nodes.select(pad_topic("a").alias("source"), pad_topic("b").alias("target"))
    return edges.join(seen, ["source", "target"], "left").select(
        "source", "target", F.coalesce("n", F.lit(0).cast("long")).alias("weight"))


def topic_count_rule(vocab: DataFrame) -> DataFrame:
    """Suggested number of topics: cube root of half the vocabulary, halves rounded to even."""
    return vocab.agg(F.bround(F.pow(F.count("*") / 2, F.lit(1 / 3))).cast("int").alias("n"))


def period_top_list(df: DataFrame, periods: Mapping[str, Period], key: str, date: str = "Date") -> DataFrame:
    """Counts of a key per open-ended period → (period, key, count)."""
    labelled = df.withColumn("period", period_label(date, periods))
    return labelled.filter(F.col("period").isNotNull() & F.col(key).isNotNull()).groupBy("period", key).agg(F.count("*").alias("count"))


def topk_per_period(counts: DataFrame, key: str, k: int = 10, period: str = "period", count: str = "count") -> DataFrame:
    """The ``k`` most frequent keys of each period."""
    rn = F.row_number().over(Window.partitionBy(period).orderBy(F.col(count).desc(), key))
    return counts.withColumn("rank", rn).filter(F.col("rank") <= k)


def drop_most_frequent(counts: DataFrame, skip: int = 25, term: str = "term", freq: str = "freq") -> DataFrame:
    """All but the ``skip`` most frequent terms. The few skipped rows are found by a top-k, not by a global ranking."""
    top = counts.orderBy(F.col(freq).desc(), term).limit(skip).select(term)
    return counts.join(F.broadcast(top), term, "left_anti")  # at most ``skip`` rows


def build_vocabulary(tokens: DataFrame, column: str, stop: Sequence[str] = (), min_count: int = 50, skip_top: int = 25,
                     pos: Sequence[str] = ()) -> DataFrame:
    """Topic-model vocabulary: frequent words without stop words and without the most frequent ones → (term, freq).

    With ``pos`` the column is a ``lemma_POS lemma_POS …`` text, of which only lemmas of these parts of speech count.
    """
    if pos:
        tokens = tokens.select(keep_pos(F.col(column), pos).alias(column))
    return drop_most_frequent(filter_vocab(word_count(tokens, column), stop, min_count), skip_top)
