"""Operator 2: quality rules, with lines that many documents of one host share removed.

A line is normalised (lower case, white space to single blanks) and hashed. Per host, the distinct documents of every line are counted;
copies of one document count once, as they agree on the hash of all their normalised lines in order. Lines above the limits are boilerplate;
they are taken out of the texts, and a document that loses too large a part of its words with them is rejected.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rostrum.llm.fixed import binary_text, bounded_batches, saved
from rostrum.llm.words import chain, distinct, hash_spans, per_row, texts_of, words_of

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
MEASURED = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_left long, cleaned binary"


def line_hash(normal: bytes) -> int:
    """First 60 bits of the MD5 digest."""
    return int(hashlib.md5(normal).hexdigest()[:15], 16)


def _normal(raw: bytes) -> bytes:
    return b" ".join(raw.lower().split())


def _lines(text: bytes) -> tuple[int, list[int]]:
    """The hash of all normalised lines, and the hashes of the distinct ones."""
    normal = [k for k in map(_normal, text.split(b"\n")) if k]
    return line_hash(b"".join(k + b"\n" for k in normal)), [line_hash(k) for k in dict.fromkeys(normal)]


def _hashes(batches):
    for batch in batches:
        buf, offsets = texts_of(batch)
        data = buf.tobytes()
        found = [_lines(data[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.list_(pa.int64()))],
                                         names=["host", "copy", "lines"])


def _clean(text: bytes, common: set[int]) -> tuple[int, bytes]:
    """Number of lines equal to an earlier one, and the text without the common lines; the other lines stay as they are."""
    raw = text.split(b"\n")
    solid = [r for r in raw if r.strip()]
    again = len(solid) - len(set(solid))
    if not common:
        return again, text
    return again, b"\n".join(r for r in raw if not (k := _normal(r)) or line_hash(k) not in common)


def _measure(batches):
    for batch in batches:
        buf, offsets = texts_of(batch)
        n = len(buf) - 8
        starts, ends, ptr = words_of(buf, offsets)
        h = hash_spans(buf, starts, ends)
        points = np.zeros(n + 1, np.int64)
        np.cumsum((buf[:n] & 0xC0) != 0x80, out=points[1:])
        chars = per_row(points[ends] - points[starts], ptr)
        marks = np.zeros(n + 1, np.int64)
        np.cumsum(SYMBOLS[buf[:n]], out=marks[1:])
        symbols = marks[offsets[1:]] - marks[offsets[:-1]]
        grams = chain(h[:-2], h[1:-1], h[2:]) if len(h) > 2 else h[:0]
        repeats, dups, left, cleaned = [], [], [], []
        hosts, valid = batch.column("host").to_pylist(), batch.column("text").is_valid().to_pylist()
        common: dict[str, set[int]] = {}
        data = buf[:n].tobytes()
        for i, (a, b) in enumerate(zip(ptr[:-1].tolist(), ptr[1:].tolist())):
            covered = 0
            if b - a > 3:
                _, _, inverse = distinct(grams[a: b - 2])
                twice = np.bincount(inverse)[inverse] > 1
                mark = np.zeros(b - a, bool)
                for k in range(3):
                    mark[k: k + len(twice)] |= twice
                covered = int(mark.sum())
            repeats.append(covered)
            if hosts[i] not in common:
                common[hosts[i]] = set(batch.column("common")[i].as_py() or ())
            again, text = _clean(data[offsets[i]: offsets[i + 1]], common[hosts[i]])
            dups.append(again)
            left.append(len(text.split()))
            cleaned.append(text if valid[i] else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(np.diff(ptr), pa.int64()), pa.array(chars, pa.int64()), pa.array(symbols, pa.int64()), pa.array(dups, pa.int64()),
             pa.array(repeats, pa.int64()), pa.array(left, pa.int64()), pa.array(cleaned, pa.binary())],
            names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_left", "cleaned"])


def quality_rules(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source", min_words: int = 50, max_repeat: int = 50,
                  min_documents: int = 20, max_share: float = 0.01, max_removed: float = 0.5) -> DataFrame:
    """Per row its counts, ``base_failed``, the words left without boilerplate lines (``n_left``), ``kept``, and the text without them (``cleaned``).

    A line is boilerplate in a host if more than ``min_documents`` distinct documents there hold it and more than ``max_share`` of all its documents.
    ``kept`` is false for rows that fail the base rules and for rows that lose more than ``max_removed`` of their words.
    Null texts have no words and stay null, rows without a host form one host of their own; rows with equal ids are judged one by one.
    """
    bounded_batches(docs.sparkSession)
    base = binary_text(docs, doc_id, text, F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"))
    sizes = base.groupBy("host").agg(F.count("*").alias("documents"))
    lines = base.mapInArrow(_hashes, "host string, copy long, lines array<long>").select("host", "copy", F.explode("lines").alias("line"))
    # Distinct documents of a line first, then their count, both combined before their shuffle.
    counts = lines.distinct().groupBy("host", "line").agg(F.count("*").alias("found"))
    found = counts.filter(F.col("found") > min_documents).join(sizes, "host").filter(F.col("found") > max_share * F.col("documents"))
    # At most the lines of a mean document over max_share per host. Written, so that Spark knows the size: texts are shuffled only if it is large.
    common = saved(found.groupBy("host").agg(F.collect_list("line").alias("common")), "common")
    out = base.join(common, "host", "left").select("doc_id", "text", "host", "common").mapInArrow(_measure, MEASURED)
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words"))
    kept = ~failed & (F.col("n_words") - F.col("n_left") <= max_removed * F.col("n_words"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), "n_left", kept.alias("kept"),
                      F.col("cleaned").cast("string").alias("cleaned"))
