"""Statistics of fixed size over all rows, and helpers that the operators share.

Whatever comes to the driver here has a size set by a parameter and not by the input: counter vectors, bit vectors, histograms.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from rostrum.llm.words import mix
from rostrum.session import scratch_path

BATCH_BYTES = 4 << 20
SMALL_BATCH_BYTES = 1 << 20  # for kernels whose arrays take many times the bytes of their texts
BLOCK = 1 << 15


def bounded_batches(spark: SparkSession, size: int = BATCH_BYTES) -> SparkSession:
    """Python workers get batches of bounded bytes, so that very long texts do not add up in one batch."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))
    return spark


def saved(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back: evaluated once, safe against lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def binary_text(docs: DataFrame, doc_id: str, text: str, *more: str) -> DataFrame:
    """The id as ``doc_id`` and the text as bytes; other columns only where they are named."""
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").cast("binary").alias("text"), *more)


def vector_sum(df: DataFrame, kernel: Callable[[Iterator[pa.RecordBatch]], np.ndarray], size: int) -> np.ndarray:
    """Sum over all partitions of one vector of ``size`` numbers each; only the sum comes to the driver."""
    blocks = -(-size // BLOCK)

    def parts(batches):
        v = np.asarray(kernel(batches), np.int64)
        for b in range(blocks):
            part = v[b * BLOCK: (b + 1) * BLOCK]
            if part.any():
                yield pa.RecordBatch.from_pydict({"block": pa.array([b], pa.int32()), "v": pa.array([part.tobytes()], pa.binary())})

    def total(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, v in zip(batch.column("block").to_pylist(), batch.column("v").to_pylist()):
                part = np.frombuffer(v, np.int64)
                sums[b] = sums[b] + part if b in sums else part
        for b, v in sums.items():
            yield pa.RecordBatch.from_pydict({"block": pa.array([b], pa.int32()), "v": pa.array([v.tobytes()], pa.binary())})

    out = np.zeros(size, np.int64)
    summed = df.mapInArrow(parts, "block int, v binary").repartition(blocks, "block").mapInArrow(total, "block int, v binary")
    for row in summed.toLocalIterator():
        out[row["block"] * BLOCK: (row["block"] + 1) * BLOCK] += np.frombuffer(row["v"], np.int64)
    return out


class IdFilter:
    """A Bloom filter of ids: a bit vector of fixed size that never misses an id. What it lets through is joined exactly."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @staticmethod
    def places(ids: np.ndarray, size: int) -> list[np.ndarray]:
        h = mix(ids.astype(np.int64).view(np.uint64))
        return [((h >> np.uint64(s)) & np.uint64(size - 1)).astype(np.int64) for s in (0, 20, 40)]

    def may_hold(self, ids: np.ndarray) -> np.ndarray:
        size = len(self.bits) * 8
        out = np.ones(len(ids), bool)
        for p in self.places(ids, size):
            out &= (self.bits[p >> 3] >> (p & 7).astype(np.uint8)) & 1 == 1
        return out

    @classmethod
    def of(cls, ids: DataFrame, size: int = 1 << 24) -> IdFilter:
        """Filter of ``size`` bits, a power of two, over the one long column of ``ids``."""
        def kernel(batches):
            bits = np.zeros(size, bool)
            for batch in batches:
                for p in cls.places(batch.column(0).drop_null().to_numpy(zero_copy_only=False), size):
                    bits[p] = True
            return np.packbits(bits, bitorder="little").view(np.int64)

        def union(batches):
            total: dict[int, np.ndarray] = {}
            for batch in batches:
                for b, v in zip(batch.column("block").to_pylist(), batch.column("v").to_pylist()):
                    part = np.frombuffer(v, np.int64)
                    total[b] = total[b] | part if b in total else part
            for b, v in total.items():
                yield pa.RecordBatch.from_pydict({"block": pa.array([b], pa.int32()), "v": pa.array([v.tobytes()], pa.binary())})

        def parts(batches):
            v = kernel(batches)
            for b in range(0, len(v), BLOCK):
                if v[b: b + BLOCK].any():
                    yield pa.RecordBatch.from_pydict({"block": pa.array([b], pa.int32()), "v": pa.array([v[b: b + BLOCK].tobytes()], pa.binary())})

        out = np.zeros(size // 64, np.int64)
        made = ids.mapInArrow(parts, "block int, v binary").repartition(max(1, len(out) // BLOCK), "block").mapInArrow(union, "block int, v binary")
        for row in made.toLocalIterator():
            out[row["block"]: row["block"] + BLOCK] |= np.frombuffer(row["v"], np.int64)
        return cls(out.view(np.uint8))


def kth_largest(df: DataFrame, column: str, k: int, digits: int = 16) -> float | None:
    """The exact k-th largest value of a double column without nulls, by histograms of its leading bits.

    Each round counts the values per next ``digits`` bits and goes on inside one bucket, so that a histogram of at most
    2**digits rows comes to the driver. None if there are fewer than k values.
    """
    if k < 1:
        return None
    ordered = _ordered(df, column)
    prefix, width = 0, 64
    while width > 0:
        width -= digits
        part = ordered.filter(F.shiftrightunsigned("_o", width + digits) == prefix) if width + digits < 64 else ordered
        n = {r[0]: r[1] for r in part.groupBy(F.shiftrightunsigned("_o", width).alias("b")).count().collect()}
        for b in sorted(n, reverse=True):
            if n[b] >= k:
                break
            k -= n[b]
        else:
            return None
        prefix = b
    return _value(prefix)


def _ordered(df: DataFrame, column: str) -> DataFrame:
    """The bits of a double as a long whose unsigned order is that of the values."""
    def kernel(batches):
        for batch in batches:
            v = batch.column(0).to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
            u = v.view(np.uint64)
            top = np.uint64(1 << 63)
            o = np.where(u & top != 0, ~u, u | top)
            yield pa.RecordBatch.from_arrays([pa.array(o.view(np.int64))], names=["_o"])

    return df.select(F.col(column).cast("double").alias("_v")).filter(F.col("_v").isNotNull()).mapInArrow(kernel, "_o long")


def _value(bits: int) -> float:
    u = np.array([bits & ((1 << 64) - 1)], np.uint64)
    top = np.uint64(1 << 63)
    return float(np.where(u & top != 0, u & ~top, ~u).astype(np.uint64).view(np.float64)[0])
