"""Speech-shaped views over the given tables, for Spark and as SQL text with the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rostrum.functions.text import words
from rostrum.operators.rows import spread, unnest
from rostrum.plans.registry import table

DOC_DATE = "date '1998-01-01' + cast(doc_id * 37 % 7000 as int)"
DOC_TERM = "cast(36 + floor((year(date)-1998)/4.0) as int)"
DOC_PARTY = "case when doc_id % 5 = 0 then null else concat('P', cast(doc_id % 4 as string)) end"
DATE_FILTER = "concat(replace(cast(date as string),'-','.'),'.')"


def docs(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as dated speeches."""
    return (
        table(spark, sf, "documents")
        .selectExpr("doc_id", "text", "lang as type", "source as speaker", f"{DOC_PARTY} as party",
                    f"{DOC_DATE} as date")
        .selectExpr("*", f"{DATE_FILTER} as date_filter", f"{DOC_TERM} as term")
    )


V_DOC = f"""v_doc as (
  select *, {DATE_FILTER} as date_filter, {DOC_TERM} as term from (
    select doc_id, text, lang as type, source as speaker, {DOC_PARTY} as party, {DOC_DATE} as date from documents) t)"""

SPEECH_COLUMNS = [
    "concat('36-', cast(conv_id as string), '-', cast(turn + 1 as string)) as id",
    "concat('36-', cast(conv_id as string)) as sitting_uid",
    "turn + 1 as idx", "role as speaker", "text",
    "case when turn % 3 = 0 then concat('t', cast(turn as string)) end as topic",
]


def speeches(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations as sittings, turns as speeches."""
    return table(spark, sf, "conversations").selectExpr(*SPEECH_COLUMNS)


V_SPEECH = f"v_speech as (select {', '.join(SPEECH_COLUMNS)} from conversations)"


def token_array(spark: SparkSession, sf: str) -> DataFrame:
    """One row per document with its lower-case words."""
    d = spread(table(spark, sf, "documents").select("doc_id", "text"), "doc_id")
    return d.select("doc_id", words(F.lower("text")).alias("toks"))


def tokens(spark: SparkSession, sf: str) -> DataFrame:
    return unnest(token_array(spark, sf), "doc_id", tok="toks")


V_TOKEN = r"""v_token as (
  select doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+', 0)) as tok from documents)"""

POS = "case length(tok) % 4 when 0 then 'noun' when 1 then 'adj' when 2 then 'propn' else 'verb' end"


def lemmas(spark: SparkSession, sf: str) -> DataFrame:
    return tokens(spark, sf).selectExpr("doc_id", f"concat(tok, '_', {POS}) as lemma_pos")


V_LEMMA = f"{V_TOKEN}, v_lemma as (select doc_id, concat(tok, '_', {POS}) as lemma_pos from v_token)"


def links(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select(
        "page_id", "url", F.explode(F.regexp_extract_all("html", F.lit('<a href="([^"]*)">'), F.lit(1))).alias("href"))


V_LINK = """v_link as (
  select page_id, url, unnest(regexp_extract_all(html, '<a href="([^"]*)">', 1)) as href from pages)"""
