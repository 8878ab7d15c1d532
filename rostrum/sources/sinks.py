"""Writers. Each writes in parallel, one file per task, and none gathers rows."""

from __future__ import annotations

import hashlib
import io
import uuid
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from rostrum.functions.text import pad_topic, topic_label


def write_speech_feed(speeches: DataFrame, path: str, term: str = "term") -> None:
    """JSON records, one folder per term."""
    speeches.write.partitionBy(term).json(path)


def write_array_lines(df: DataFrame, path: str) -> None:
    """JSON array files with one record per line, one array per task."""
    lines = df.select(F.to_json(F.struct("*")).alias("value"))

    def framed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({"value": ["["]})
        held: list[str] = []  # the last record of a file takes no comma
        for b in batches:
            rows = held + list(b["value"])
            held = rows[-1:]
            yield pd.DataFrame({"value": [f"{r}," for r in rows[:-1]]}, dtype="object")
        yield pd.DataFrame({"value": [*held, "]"]})

    lines.mapInPandas(framed, "value string").write.text(path)


def write_tsv(df: DataFrame, path: str, header: bool = True) -> None:
    """Tab-separated table; quotes are doubled, outer blanks and line breaks inside values are kept."""
    df.write.csv(path, sep="\t", header=header, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def write_by_topic(docs: DataFrame, path: str, topic: str = "topic") -> None:
    """Documents in one folder per dominant topic. Rows are not regrouped, so a hot topic is written by many tasks."""
    docs.write.partitionBy(topic).parquet(path)


def write_wiki_json(pages: DataFrame, path: str) -> None:
    pages.select("id", "title", "content").write.json(path)


def zip_members(df: DataFrame, member: str, text: str, per_archive: int = 1000) -> DataFrame:
    """Pack texts into zip archives → (path, content); one archive per ``per_archive`` rows of a task."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), per_archive):
                part = b.iloc[at:at + per_archive]
                buf = io.BytesIO()
                with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
                    for name, body in zip(part[member], part[text]):
                        z.writestr(name, body)
                yield pd.DataFrame({"path": [f"{part[member].iloc[0]}.zip"], "content": [buf.getvalue()]})

    return df.select(member, text).mapInPandas(run, "path string, content binary")


def write_archives(archives: DataFrame, folder: str) -> None:
    """Write (path, content) rows as files of a shared folder, named by a hash of both; a task that runs again writes the same files."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs
        system, root = fs.FileSystem.from_uri("file:///" + folder.removeprefix("file:").lstrip("/") if folder.startswith(("/", "file:")) else folder)
        system.create_dir(root, recursive=True)
        for b in batches:
            for name, data in zip(b["path"], b["content"]):
                digest = hashlib.sha256(name.encode() + bytes(data)).hexdigest()
                part = f"{root}/.{digest}-{uuid.uuid4().hex}"
                with system.open_output_stream(part) as f:
                    f.write(bytes(data))
                system.move(part, f"{root}/{digest}.zip")
            yield pd.DataFrame({"n": [len(b)]})

    archives.select("path", "content").mapInPandas(run, "n long").agg(F.sum("n")).collect()


def write_topic_graph(edges: DataFrame, k: int, path: str) -> None:
    """Topic graph as two tables: nodes (id, name) and edges (source, target, weight)."""
    spark = edges.sparkSession
    spark.range(k).select(pad_topic("id").alias("id"), topic_label("id").alias("name")).write.parquet(f"{path}/nodes")
    edges.write.parquet(f"{path}/edges")


def publish_version(spark: SparkSession, df: DataFrame, path: str, version: int, alias: str = "speeches") -> DataFrame:
    """Write a new version beside the old ones, then point the alias at it; readers see the old one until then.

    The pointer is a table beside the versions, so that other sessions find it by ``current_version``; here it also becomes a view.
    """
    df.write.parquet(f"{path}/v{version}")
    point_alias(spark, path, version, alias)
    current_version(spark, path, alias).createOrReplaceTempView(alias)
    return spark.table(alias)


def point_alias(spark: SparkSession, path: str, version: int, alias: str = "speeches") -> None:
    """Let the alias name a version that is written already, also an older one."""
    row = spark.range(1).select(F.lit(alias).alias("alias"), F.lit(version).alias("version"), F.current_timestamp().alias("since"))
    row.write.mode("append").parquet(f"{path}/aliases")


def current_version(spark: SparkSession, path: str, alias: str = "speeches") -> DataFrame:
    """The version that the alias names now."""
    pointers = spark.read.schema("alias string, version int, since timestamp").parquet(f"{path}/aliases")
    version = pointers.filter(F.col("alias") == alias).agg(F.max_by("version", "since")).first()[0]
    if version is None:
        raise ValueError(f"no version is published as {alias!r}")
    return spark.read.parquet(f"{path}/v{version}")

