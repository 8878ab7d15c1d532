"""Joins and set operations.

No side is broadcast by hint: the optimizer broadcasts sides it knows (or finds at run time) to be small, and
sort-merge joins the rest, where adaptive execution splits hot keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from rostrum.functions.text import lc_norm


def join_text_left(meta: DataFrame, texts: DataFrame, key: str = "Hash") -> DataFrame:
    """Every metadata row, with its text where one exists."""
    return meta.join(texts, key, "left")


def join_annotations_left(meta: DataFrame, annotations: DataFrame, key: str = "Hash") -> DataFrame:
    """Every metadata row once per annotation, or once without any."""
    return meta.join(annotations, key, "left")


def join_pages_inner(page_ids: DataFrame, page_freqs: DataFrame, key: str = "uri") -> DataFrame:
    return page_ids.join(page_freqs, key)


def semi_join_ids(pages: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return pages.join(ids.select(key), key, "left_semi")


def anti_join_indexed(crawl: DataFrame, indexed: DataFrame, term: int | str, term_col: str = "term",
                      nr: str = "sitting_nr") -> DataFrame:
    """Sittings of a term that the search table does not have yet."""
    same = F.col(term_col).cast("string") == str(term)
    return crawl.filter(same).join(indexed.filter(same).select(nr), nr, "left_anti").select(*crawl.columns)


def join_sitting_speech(speeches: DataFrame, sittings: DataFrame, key: str = "sitting_uid") -> DataFrame:
    """Carry the sitting's columns onto each of its speeches."""
    return speeches.join(sittings, key)


def join_bill_left(speeches: DataFrame, bills: DataFrame, id_col: str = "id", url: str = "bill_url") -> DataFrame:
    """Title and details of the bill page; speeches without a bill pass unchanged.

    Rows without address get a join key of their own, so they do not all land on one task.
    """
    has = F.coalesce(F.col(url), F.lit("")) != ""
    keyed = speeches.withColumn("_bill", F.when(has, F.col(url)).otherwise(F.concat(F.lit(" "), F.col(id_col))))
    pages = bills.select(F.col(url).alias("_bill"), F.col("bill_title").alias("_title"), F.col("bill_details").alias("_details"))
    joined = keyed.join(pages, "_bill", "left")
    old = {c: F.col(c) if c in speeches.columns else F.lit(None) for c in ("bill_title", "bill_details")}
    return (joined.withColumn("bill_title", F.coalesce("_title", old["bill_title"]))
            .withColumn("bill_details", F.coalesce("_details", old["bill_details"]))
            .drop("_bill", "_title", "_details"))


def join_topic_strict(records: DataFrame, topics: DataFrame, key: str = "id") -> tuple[DataFrame, DataFrame]:
    """(records with topic, records whose topic is missing)."""
    return records.join(topics, key), records.join(topics.select(key), key, "left_anti")


def anti_join_stopwords(tokens: DataFrame, stop: DataFrame, token: str = "tok", word: str = "word") -> DataFrame:
    return tokens.join(stop, F.lower(tokens[token]) == F.lower(stop[word]), "left_anti")


def semi_join_vocab(tokens: DataFrame, vocab: DataFrame, token: str = "tok", term: str = "term") -> DataFrame:
    return tokens.join(vocab, tokens[token] == vocab[term], "left_semi")


def join_doc_names(rows: DataFrame, names: DataFrame, key: str = "doc_id") -> DataFrame:
    """Names of documents by identifier, never by row order."""
    return rows.join(names, key)


def outer_compare(counts: DataFrame, period: str, key: str, value: str, labels: Sequence[str]) -> DataFrame:
    """Periods side by side, one row per key that occurs in any of them."""
    return counts.groupBy(key).pivot(period, list(labels)).agg(F.sum(value))


def join_protected_words(tokens: DataFrame, words: DataFrame, token: str = "tok", word: str = "word",
                         out: str = "protected") -> DataFrame:
    """Mark tokens that no stemmer may change; case and old accents do not matter."""
    marks = words.select(lc_norm(word).alias("_w")).distinct().withColumn(out, F.lit(True))
    joined = tokens.join(marks, lc_norm(tokens[token]) == marks["_w"], "left").drop("_w")
    return joined.withColumn(out, F.coalesce(out, F.lit(False)))


def union_terms(*parts: DataFrame) -> DataFrame:
    """One speech table from extractors that fill different columns."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def distinct_ids(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).distinct()


def skip_duplicate_suggestions(df: DataFrame, text: str = "input", weight: str = "weight") -> DataFrame:
    """One row per suggestion text, with its highest weight."""
    return df.groupBy(text).agg(F.max(weight).alias(weight))


def rank_one(df: DataFrame, key: str, *order) -> DataFrame:
    """First row per key in the given order. The rank limit is applied before the shuffle as well, so a hot key stays small."""
    from pyspark.sql import Window

    rn = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("_rn", rn).filter(F.col("_rn") == 1).drop("_rn")


def upsert_by_id(old: DataFrame, new: DataFrame, id_col: str = "id", seq: str = "seq") -> DataFrame:
    """Old and new versions together, the latest of each id kept."""
    return rank_one(old.unionByName(new, allowMissingColumns=True), id_col, F.col(seq).desc())
