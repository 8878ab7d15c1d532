"""Readers for the file formats of the corpus."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rostrum import schemas
from rostrum.functions.text import speech_body, strip_chars, strip_space
from rostrum.operators.joins import rank_one, semi_join_ids
from rostrum.sources.archives import archive_members, read_members


def parse_speech_lines(lines: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """Lines of an array file with one record each → (records, rejects with a reason).

    Fields that may be a string or a list become lists. Lines that are no JSON object, and records without id or
    speaker, are rejected and do not stop the job.
    """
    body = strip_chars(column, " ,\r\n")
    rows = lines.filter(~F.trim(column).isin("[", "]", "")).select(F.col(column).alias("raw"), F.try_parse_json(body).alias("v"))

    def get(path: str, kind: str = "string") -> Column:
        return F.try_variant_get("v", path, kind)

    lists = [F.coalesce(get(f"$.{f}", "array<string>"), F.when(get(f"$.{f}").isNotNull(), F.array(get(f"$.{f}")))).alias(f)
             for f in schemas.SPEECH_LISTS]
    sitting = F.struct(*[get(f"$.plenary_sitting_details.{f}").alias(f) for f in schemas.SITTING_FIELDS])
    typed = rows.select("raw", "v", *[get(f"$.{f}").alias(f) for f in schemas.SPEECH_SCALARS], *lists,
                        sitting.alias("plenary_sitting_details"))
    reason = (F.when(F.col("v").isNull(), "no JSON").when(F.col("id").isNull(), "no id")
              .when(F.col("speaker").isNull(), "no speaker"))
    typed = typed.withColumn("reason", reason)
    return typed.filter("reason is null").drop("raw", "v", "reason"), typed.filter("reason is not null").select("raw", "reason")


def read_speech_lines(spark: SparkSession, path: str, limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Array files with one record per line; they split at any line. ``limit`` counts lines with records."""
    lines = spark.read.text(path).filter(~F.trim("value").isin("[", "]", ""))
    return parse_speech_lines(lines if limit is None else lines.limit(limit))


def read_json_array(spark: SparkSession, path: str, schema: str = schemas.SPEECH) -> DataFrame:
    """Files that hold one JSON array each, in any layout."""
    return spark.read.option("multiLine", True).schema(schema).json(path)


def unzip(archives: DataFrame, suffix: str, name: str = "path", content: str = "content") -> DataFrame:
    """Members of zip archives with a suffix → (archive, member, pos, text, error); unreadable members carry an error."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["archive", "member", "pos", "text", "error"]
        for b in batches:
            for path, data in zip(b[name], b[content]):
                rows = []
                try:
                    archive = zipfile.ZipFile(io.BytesIO(data))
                except Exception as e:  # an unreadable archive is one row with its error
                    yield pd.DataFrame([(path, None, None, None, f"{type(e).__name__}: {e}")], columns=columns, dtype="object")
                    continue
                with archive as z:
                    for pos, member in enumerate(z.namelist()):
                        if not member.endswith(suffix):
                            continue
                        try:
                            rows.append((path, member, pos, z.read(member).decode("utf-8"), None))
                        except Exception as e:  # one broken member does not lose the archive
                            rows.append((path, member, pos, None, f"{type(e).__name__}: {e}"))
                        if len(rows) >= 512:
                            yield pd.DataFrame(rows, columns=columns, dtype="object")
                            rows = []
                yield pd.DataFrame(rows, columns=columns, dtype="object")

    return archives.select(name, content).mapInPandas(run, "archive string, member string, pos int, text string, error string")


def zip_texts(archives: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Text members → (Hash, Text of the speech), and the members that could not be used.

    The hash is the second path part up to its first dot; of members with the same hash the last one counts.
    """
    return member_texts(unzip(archives, ".txt"))


def member_texts(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same for (archive, member, pos, text, error) rows."""
    members = members.withColumn("Hash", F.regexp_extract("member", r"\A[^/]*/([^/.]*)", 1))
    good = F.col("error").isNull() & F.coalesce(F.col("member").contains("/"), F.lit(False))
    texts = rank_one(members.filter(good), "Hash", F.col("archive").desc(), F.col("pos").desc())
    return texts.select("Hash", speech_body("text").alias("Text")), members.filter(~good).select("archive", "member", "error")


def binary_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def read_zip_text(spark: SparkSession, path: str) -> DataFrame:
    """Texts of archives of any size below ``path``, read by member ranges."""
    members = archive_members(spark, path)
    return member_texts(read_members(members.filter(F.col("error").isNotNull() | F.col("member").endswith(".txt"))))[0]


def zip_json(archives: DataFrame, ids: DataFrame, schema: str = "title string, content string", key: str = "id") -> DataFrame:
    """``<id>.json`` members whose id is wanted; only those are decoded."""
    members = unzip(archives, ".json").withColumn(key, _number_of_name())
    return _decoded(semi_join_ids(members.select(key, "text"), ids, key), schema, key)


def _number_of_name() -> Column:
    return F.regexp_extract("member", r"\A([0-9]+)", 1).try_cast("bigint")


def _decoded(wanted: DataFrame, schema: str, key: str) -> DataFrame:
    return wanted.select(key, F.from_json("text", schema).alias("j")).select(key, "j.*")


def read_zip_json(spark: SparkSession, path: str, ids: DataFrame, schema: str = "title string, content string", key: str = "id") -> DataFrame:
    """Members whose id is wanted, of archives of any size below ``path``; the others are neither read nor unpacked."""
    members = archive_members(spark, path).filter(F.col("member").endswith(".json") & F.col("error").isNull()).withColumn(key, _number_of_name())
    texts = read_members(semi_join_ids(members, ids, key)).withColumn(key, _number_of_name())
    return _decoded(texts.filter("error is null").select(key, "text"), schema, key)


def read_metadata_tsv(spark: SparkSession, path: str, names: Sequence[str] = schemas.METADATA_COLUMNS) -> DataFrame:
    """Tab-separated metadata with a head line; columns are named by position."""
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    return spark.read.csv(path, sep="\t", header=True, schema=schema, enforceSchema=True, escape='"').toDF(*names)


def read_merged_tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Tab-separated table whose texts may hold line breaks."""
    return spark.read.csv(path, sep="\t", header=True, schema=schema, escape='"', multiLine=True)


WIKI_SCHEMA = "id bigint, title string, revision struct<text:struct<_VALUE:string,`_xml:space`:string>>"


def read_wiki_dump(spark: SparkSession, path: str) -> DataFrame:
    """MediaWiki pages, also compressed → (id, title, content)."""
    pages = spark.read.format("xml").option("rowTag", "page").schema(WIKI_SCHEMA).load(path)
    return pages.select("id", "title", F.col("revision.text._VALUE").alias("content"))


# The literal ends at the last quote of the line: no group is repeated, so its length costs no stack.
TRIPLE = r'\A\s*<([^>]*)>\s+<([^>]*)>\s+(?:<([^>]*)>|"(.*)"[^\s"]*)\s*\.\s*\z'


def parse_triples(lines: DataFrame, column: str = "value") -> DataFrame:
    """One triple per line → (s, p, o); comments and other lines are skipped."""
    c = F.col(column)
    obj = F.coalesce(F.nullif(F.regexp_extract(c, TRIPLE, 3), F.lit("")), F.regexp_extract(c, TRIPLE, 4))
    return lines.filter(c.rlike(TRIPLE)).select(F.regexp_extract(c, TRIPLE, 1).alias("s"),
                                                F.regexp_extract(c, TRIPLE, 2).alias("p"), obj.alias("o"))


def read_triples(spark: SparkSession, path: str) -> DataFrame:
    return parse_triples(spark.read.text(path))


def read_inlinks_csv(spark: SparkSession, path: str) -> DataFrame:
    """Space-separated link counts without head line → (freq, uri)."""
    return spark.read.csv(path, sep=" ", schema="freq bigint, uri string")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Stored web pages."""
    return spark.read.parquet(path)


def read_topic_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Document topics ``id <tab> a|b|c`` → (id, topics)."""
    rows = spark.read.csv(path, sep="\t", schema="id string, topics string")
    return rows.select(strip_space("id").alias("id"), F.split(strip_space("topics"), r"\|").alias("topics"))


def parse_word_list(lines: DataFrame, column: str = "value") -> DataFrame:
    """Words, one per line, without comments, banners (lines without letters or digits around a title) and repeats."""
    word = strip_space(column)
    return lines.select(word.alias("word")).filter(
        (F.col("word") != "") & ~F.col("word").startswith("#") & ~F.col("word").rlike(r"[=*_]{2,}|-{2,}")).distinct()


def read_word_list(spark: SparkSession, path: str) -> DataFrame:
    return parse_word_list(spark.read.text(path))


def read_annotations(spark: SparkSession, path: str) -> DataFrame:
    """Nested annotation lists per document."""
    return spark.read.parquet(path)
