"""Row filters of searches and reports."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

Period = tuple[dt.date | None, dt.date | None]


def date_eq(date: str, column: str = "date_filter") -> Column:
    return F.col(column) == date


def date_range(date_from: str, date_to: str | None, column: str = "date_filter") -> Column:
    """Inclusive range over the textual date; an open upper end would match nothing, so it is refused."""
    if not date_to:
        raise ValueError("date_from needs date_to")
    return F.col(column).between(date_from, date_to)


def any_of(values: Sequence[str], column: str) -> Column:
    return F.col(column).isin(list(values))


def search_filter(date: str | None = None, date_from: str | None = None, date_to: str | None = None,
                  speakers: Sequence[str] | None = None, parties: Sequence[str] | None = None,
                  types: Sequence[str] | None = None) -> Column:
    """All given filters together; none given matches everything, and ``date_to`` alone is ignored."""
    parts = [F.lit(True)]
    if date:
        parts.append(date_eq(date))
    if date_from:
        parts.append(date_range(date_from, date_to))
    if speakers:
        parts.append(any_of(speakers, "speaker_filter"))
    if parties:
        parts.append(any_of(parties, "speaker_party_filter"))
    if types:
        parts.append(any_of(types, "type_filter"))
    return reduce(lambda a, b: a & b, parts)


def filter_sitting_speech(df: DataFrame, sitting_id: str | None = None, speech_id: str | None = None,
                          sitting: str = "sitting_nr", speech: str = "idx") -> DataFrame:
    """Restrict to one sitting and/or one speech; identifiers are compared as text."""
    if sitting_id is not None:
        df = df.filter(F.col(sitting).cast("string") == str(sitting_id))
    if speech_id is not None:
        df = df.filter(F.col(speech).cast("string") == str(speech_id))
    return df


def filter_name_excluding(df: DataFrame, name: str, words: Iterable[str], name_col: str = "Name",
                          key: str = "Concept") -> DataFrame:
    """Rows of one person whose key contains none of the words; a missing key stays."""
    cond = F.col(name_col).contains(name)
    for w in words:
        cond = cond & ~F.coalesce(F.col(key), F.lit("")).contains(w)
    return df.filter(cond)


def in_period(date: str | Column, period: Period) -> Column:
    """Strictly inside the period; ``None`` leaves an end open."""
    c = F.col(date) if isinstance(date, str) else date
    lo, hi = period
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (c > F.lit(lo))
    if hi is not None:
        cond = cond & (c < F.lit(hi))
    return cond


def period_label(date: str, periods: Mapping[str, Period]) -> Column:
    """Name of the period a date lies in, NULL on borders and outside. Periods must not overlap."""
    return F.coalesce(*[F.when(in_period(date, p), F.lit(name)) for name, p in periods.items()])


# Words that mark list, category and settlement pages.
UNIMPORTANT = ("Kategória", "listája", "lista", "település")


def filter_important_pages(df: DataFrame, min_freq: int = 100, words: Sequence[str] = UNIMPORTANT,
                           uri: str = "uri", freq: str = "freq") -> DataFrame:
    """Often linked pages that are no lists and have no digits in their last path part."""
    cond = F.col(freq) > min_freq
    for w in words:
        cond = cond & ~F.col(uri).contains(w)
    return df.filter(cond & ~F.col(uri).rlike(r"(?dU)\A.*/.*\d+.*$"))


def filter_articles(df: DataFrame, title: str = "title", content: str = "content", min_length: int | None = None) -> DataFrame:
    """Article pages: no name-space colon in the title and some content (longer than ``min_length`` if given)."""
    df = df.filter(~F.col(title).contains(":") & F.col(content).rlike(r"(?U)\S"))
    return df if min_length is None else df.filter(F.length(content) > min_length)


GOOD_POS = ("noun", "adj", "propn")


def keep_pos(lemmatized: Column, pos: Sequence[str] = GOOD_POS) -> Column:
    """Lower-case lemmas of a ``lemma_POS lemma_POS …`` text whose part of speech is wanted."""
    ending = rf"_(?:{'|'.join(pos)})\z"
    kept = F.filter(F.split(F.lower(lemmatized), r"(?U)\s+"), lambda w: w.rlike(ending))
    return F.transform(kept, lambda w: F.regexp_replace(w, ending, ""))


def filter_vocab(counts: DataFrame, stop: Sequence[str], min_count: int = 50, term: str = "term",
                 freq: str = "freq") -> DataFrame:
    """Words more frequent than ``min_count`` that are no stop words."""
    kept = counts.filter(F.col(freq) > min_count)
    return kept.filter(~F.col(term).isin(list(stop))) if stop else kept


def filter_confident_topic(df: DataFrame, threshold: float = 0.81, prob: str = "prob") -> DataFrame:
    return df.filter(F.col(prob) > threshold)


def guard_text(text: Column, result: Column) -> Column:
    """Empty result for a missing text."""
    return F.when(text.isNotNull(), F.coalesce(result, F.array())).otherwise(F.array())
