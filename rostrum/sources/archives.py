"""Zip archives by member ranges: directories first, names filtered and joined as a table, then only the wanted members, many tasks per archive."""

from __future__ import annotations

import bz2
import math
import struct
import zipfile
import zlib
from collections.abc import Callable, Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from rostrum.session import cut_lineage

MEMBERS = "archive string, member string, pos long, offset long, packed long, size long, method int, crc long, error string"
TEXTS = "archive string, member string, pos long, text string, error string"


def open_seekable(uri: str) -> BinaryIO:
    """A file of any file system that pyarrow reaches, opened for seeking."""
    from pyarrow import fs
    if uri.startswith("file:/") or "://" not in uri:
        return open("/" + uri.removeprefix("file:").lstrip("/"), "rb")
    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_file(path)


def _batch(rows: list[tuple], schema: str, batch_of: tuple[str, ...]) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32()}
    types = [kinds[c.split()[1]] for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), types)], names=list(batch_of))


def _names(schema: str) -> tuple[str, ...]:
    return tuple(c.split()[0] for c in schema.split(", "))


def archive_members(spark: SparkSession, path: str, opener: Callable[[str], BinaryIO] = open_seekable) -> DataFrame:
    """(archive, member, pos, offset, packed, size, method, crc, error) of all zip files below ``path``.

    Spark lists the files; of each only the directory at its end is read, by one task. An unreadable archive is one row with an error.
    """
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column("path").to_pylist():
                try:
                    with opener(archive) as f, zipfile.ZipFile(f) as z:
                        infos = z.infolist()
                except Exception as e:  # one broken archive does not end the job
                    yield _batch([(archive, *[None] * 7, f"{type(e).__name__}: {e}")], MEMBERS, _names(MEMBERS))
                    continue
                for at in range(0, len(infos), 10_000):
                    yield _batch([(archive, i.filename, at + n, i.header_offset, i.compress_size, i.file_size, i.compress_type, i.CRC,
                                   "encrypted" if i.flag_bits & 1 else None) for n, i in enumerate(infos[at: at + 10_000])], MEMBERS, _names(MEMBERS))

    files = spark.read.format("binaryFile").load(path).select("path")  # without the content column no file is read
    return files.repartition("path").mapInArrow(kernel, MEMBERS)


def member_bytes(f: BinaryIO, offset: int, packed: int, size: int, method: int, crc: int) -> bytes:
    """One member, unpacked and checked."""
    f.seek(offset)
    head = f.read(30)
    if len(head) < 30 or head[:4] != b"PK\x03\x04":
        raise ValueError("no member at its offset")
    f.seek(offset + 30 + sum(struct.unpack("<HH", head[26:30])))
    data = f.read(packed)
    if method == zipfile.ZIP_DEFLATED:
        data = zlib.decompress(data, -15)
    elif method == zipfile.ZIP_BZIP2:
        data = bz2.decompress(data)
    elif method != zipfile.ZIP_STORED:
        raise ValueError(f"method {method}")
    if len(data) != size or zlib.crc32(data) != crc:
        raise ValueError("checksum")
    return data


def read_members(members: DataFrame, task_bytes: int = 128 << 20, opener: Callable[[str], BinaryIO] = open_seekable) -> DataFrame:
    """(archive, member, pos, text, error) of the given rows of ``archive_members``, filtered or joined as wanted.

    Members are split by range of their place into tasks of about ``task_bytes`` unpacked bytes, so a task reads neighbours, seeks past the rest and holds
    one member at a time; an archive may have any size. Broken members, and rows that carry an error already, have an error and no text.
    """
    members = cut_lineage(members.select(*_names(MEMBERS)))
    tasks = max(1, math.ceil((members.agg(F.sum("size")).first()[0] or 0) / task_bytes))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, f = None, None
        rows, held = [], 0
        for batch in batches:
            for archive, member, pos, offset, packed, size, method, crc, error in zip(*[c.to_pylist() for c in batch.columns]):
                text = None
                if error is None:
                    try:
                        if archive != name:
                            if f is not None:
                                f.close()
                            name, f = None, None
                            name, f = archive, opener(archive)
                        text = member_bytes(f, offset, packed, size, method, crc).decode("utf-8")
                    except Exception as e:  # one broken member does not lose the archive
                        error = f"{type(e).__name__}: {e}"
                rows.append((archive, member, pos, text, error))
                held += len(text or "")
                if held > 4 << 20 or len(rows) >= 1000:
                    yield _batch(rows, TEXTS, _names(TEXTS))
                    rows, held = [], 0
        if rows:
            yield _batch(rows, TEXTS, _names(TEXTS))
        if f is not None:
            f.close()

    return members.repartitionByRange(tasks, "archive", "offset").sortWithinPartitions("archive", "offset").mapInArrow(kernel, TEXTS)
