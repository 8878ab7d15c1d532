"""Record-shaping projections."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from rostrum.functions.text import (NBSP, chair_from_header, clean_speaker, clean_text, smart_truncate, strip_bill_titles, strip_chars,
                                    titlecase_upper)
from rostrum.operators.rows import compute_once
from rostrum.schemas import INDEX_RENAMED, INDEX_SITTING, INDEX_SPEECH

# Which column feeds which facet or filter column.
FILTER_COPIES = {
    "bill_title": "bill_title_filter", "date": "date_filter", "term": "term_filter", "speaker": "speaker_filter",
    "speaker_party": "speaker_party_filter", "topic": "topic_filter", "type": "type_filter",
}

# Weight of each kind of suggestion (fixed values).
SUGGESTION_WEIGHTS = {"speaker": 10, "speaker_party": 5, "type": 7, "topic": 5, "bill_title": 5}


def flatten_speech(df: DataFrame, details: str = "plenary_sitting_details") -> DataFrame:
    """Nested speech → flat search record. Fields the input lacks are left out; ``header`` is read at speech level only."""
    own = [c for c in INDEX_SPEECH if c in df.columns]
    inner = df.schema[details].dataType.names
    return df.select(
        *own,
        *[F.col(details)[c].alias(c) for c in INDEX_SITTING if c in inner and c not in own],
        *[F.col(details)[c].alias(f"sitting_{c}") for c in INDEX_RENAMED if c in inner],
    )


def rename_drop(df: DataFrame, names: Sequence[str], drop: Iterable[str] = ()) -> DataFrame:
    """Rename all columns by position, then drop some."""
    return df.toDF(*names).drop(*drop)


def copy_to_filters(df: DataFrame, copies: dict[str, str] = FILTER_COPIES) -> DataFrame:
    """Keep an exact copy of analysed columns for facets and filters."""
    return df.withColumns({new: F.col(old) for old, new in copies.items() if old in df.columns and new not in df.columns})


def build_suggestions(df: DataFrame, out: str = "suggest") -> DataFrame:
    """Add the weighted completion inputs of each record; missing fields give none.

    Scalars are truncated (the speaker is not); the items of lists are kept whole.
    """
    def entry(name: str, weight: int) -> Column:
        c = F.col(name)
        if isinstance(df.schema[name].dataType, T.ArrayType):
            inputs = c
        else:
            inputs = F.array(c if name == "speaker" else smart_truncate(c))
        return F.when(c.isNotNull(), F.struct(inputs.alias("input"), F.lit(weight).alias("weight")))

    entries = [entry(n, w) for n, w in SUGGESTION_WEIGHTS.items() if n in df.columns]
    return df.withColumn(out, F.filter(F.array(*entries), lambda e: e.isNotNull()))


def _normal(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return F.nullif(strip_chars(F.replace(c, F.lit(NBSP), F.lit(" ")), " \n"), F.lit(""))
    if isinstance(kind, T.ArrayType):
        return F.when(F.size(c) > 0, c)
    if isinstance(kind, T.StructType):
        fields = [_normal(c[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(c.isNotNull(), F.struct(*fields))
    return c


def normalize_record(df: DataFrame) -> DataFrame:
    """Hard spaces → spaces, trim; empty strings and empty lists become NULL, also inside nested records."""
    return df.select(*[_normal(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])


def clean_speech(df: DataFrame, header: str = "header") -> DataFrame:
    """A raw speech record in its final form.

    In this order: the speaker is split from title and party; a chair without a bracket is named from the sitting header, if that column exists;
    names in capitals get title case; text and bill titles are cleaned; empty values become NULL. Titles and parties given before stay where
    the speaker holds none.
    """
    has = set(df.columns)
    head = F.col(header) if header in has else F.lit(None).cast("string")
    df = compute_once(df, {"_s": clean_speaker("speaker")})
    df = compute_once(df, {"_c": chair_from_header(F.when(~F.col("_s.bracketed"), F.col("_s.speaker")), head)})
    new = {"speaker": titlecase_upper(F.when(F.col("_s.bracketed"), F.col("_s.speaker")).otherwise(F.col("_c.speaker"))),
           "speaker_title": F.coalesce("_s.title", "_c.title", *["speaker_title"] * ("speaker_title" in has)),
           "speaker_party": F.coalesce("_s.party", *["speaker_party"] * ("speaker_party" in has)), "text": clean_text("text")}
    if isinstance(dict((f.name, f.dataType) for f in df.schema.fields).get("bill_title"), T.ArrayType):
        new["bill_title"] = strip_bill_titles("bill_title")
    return normalize_record(df.withColumns(new).drop("_s", "_c"))


def speech_key(df: DataFrame, term: str = "term", nr: str = "sitting_nr", idx: str = "idx") -> DataFrame:
    """Add ``sitting_uid`` (term-number) and ``id`` (term-number-index)."""
    uid = F.concat_ws("-", F.col(term).cast("string"), F.col(nr).cast("string"))
    return df.withColumn("sitting_uid", uid).withColumn("id", F.concat_ws("-", "sitting_uid", F.col(idx).cast("string")))


def with_topic_number(df: DataFrame, topics: str = "topics", out: str = "topic_number") -> DataFrame:
    """First topic of an ``a|b|c`` list."""
    return df.withColumn(out, F.split(F.col(topics), r"\|")[0])
