"""Operator 9: quality by importance resampling.

Two generative models over hashed unigrams and bigrams of tokens are counted: one over the target documents (label 1), one over all. A
document's weight is the log ratio of its likelihoods. Gumbel noise added to the log weights turns the largest k into a sample without
replacement in proportion to the weights. k is the number of documents whose weight reaches that of all but a small part of the target documents
in the same input, so that a clean input keeps its rows and a poor one does not; both thresholds are found exactly by histograms.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from rostrum.llm.fixed import SMALL_BATCH_BYTES, binary_text, bounded_batches, kth_largest, saved, vector_sum
from rostrum.llm.toxicity import labelled_ids
from rostrum.llm.words import PAD, WORDLIKE, chain, hash_spans, mix, runs, texts_of


def ngrams(batch: pa.RecordBatch, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the tokens and token pairs of each row, and their row numbers.

    Tokens are runs of letters and digits in lower case, and single other characters; blanks part them.
    """
    buf, offsets = texts_of(batch, lower=True)
    n = len(buf) - PAD
    wordlike = WORDLIKE[buf[:n]]
    starts, ends, ptr = runs(wordlike, offsets)
    marks = np.flatnonzero(~wordlike & (buf[:n] > 32))
    all_starts = np.concatenate([starts, marks])
    order = np.argsort(all_starts, kind="stable")
    starts, ends = all_starts[order], np.concatenate([ends, marks + 1])[order]
    row = np.searchsorted(offsets, starts, side="right") - 1
    h = hash_spans(buf, starts, ends)
    same = np.flatnonzero(row[1:] == row[:-1])
    pairs = chain(h[same], h[same + 1])
    mask = np.uint64(buckets - 1)
    return (np.concatenate([h, pairs]) & mask).astype(np.int64), np.concatenate([row, row[same]])


def ratios(docs: DataFrame, target: list[int], buckets: int) -> np.ndarray:
    """Log ratio of target and raw probability per bucket, the target smoothed with the raw model."""
    ids = np.array(sorted(target), np.int64)

    def kernel(batches):
        total = np.zeros(2 * buckets, np.int64)
        for batch in batches:
            grams, row = ngrams(batch, buckets)
            own = batch.column("doc_id")
            chosen = np.isin(own.fill_null(0).to_numpy(zero_copy_only=False), ids) & own.is_valid().to_numpy(zero_copy_only=False)
            total[:buckets] += np.bincount(grams, minlength=buckets)
            total[buckets:] += np.bincount(grams[chosen[row]], minlength=buckets)
        return total

    total = vector_sum(docs, kernel, 2 * buckets)
    raw, own = total[:buckets] + 1.0, total[buckets:].astype(float)
    p = raw / raw.sum()
    return np.log((own + buckets * p) / (own.sum() + buckets)) - np.log(p)


def weigh(docs: DataFrame, ratio: np.ndarray, doc_id: str, text: str, seed: int, *more: str | Column) -> DataFrame:
    """(doc_id, log_weight, key) per row, and further columns."""
    buckets, shared = len(ratio), docs.sparkSession.sparkContext.broadcast(ratio)
    kept = binary_text(docs, doc_id, text, *more)
    names = kept.columns[2:]

    def kernel(batches):
        for batch in batches:
            grams, row = ngrams(batch, buckets)
            weight = np.bincount(row, shared.value[grams], batch.num_rows).astype(float)
            ids = batch.column("doc_id").fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            u = (mix(mix(ids.view(np.uint64)) + np.uint64(seed)) >> np.uint64(11)).astype(float) + 0.5
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(weight), pa.array(weight - np.log(-np.log(u * 2.0**-53))), *[batch.column(c) for c in names]],
                names=["doc_id", "log_weight", "key", *names])

    schema = StructType([StructField("doc_id", LongType()), StructField("log_weight", DoubleType()), StructField("key", DoubleType()),
                         *[kept.schema[c] for c in names]])
    return kept.mapInArrow(kernel, schema)


def importance_sample(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", share: float | None = None,
                      loss: float = 0.005, rows: int = 20_000, buckets: int = 1 << 16, seed: int = 11, whole_rows: bool = False) -> DataFrame:
    """(doc_id, log_weight, key, kept) per row; ``kept`` marks the k rows with the largest key = log_weight + Gumbel noise.

    At most ``rows`` documents with label 1 are used: four of five teach the target model, all other counts cover all rows. k is the number of rows
    that weigh at least as much as all but a part ``loss`` of the fifth ones, or ``share`` of the rows where it is given. Noise depends on the id alone; rows
    with equal keys at the threshold are all kept. A null or empty text has weight 0. Without a labelled document in the input every row is kept.
    With ``whole_rows`` the result is the kept rows of ``docs`` themselves, weighed once more rather than shuffled to a join.
    """
    spark = bounded_batches(docs.sparkSession, SMALL_BATCH_BYTES)
    target = labelled_ids(labels, doc_id, label, 1, rows)
    # The threshold is taken from target documents that the model has not seen, as those it has learnt from weigh more than their like.
    learnt, unseen = ([i for k, i in enumerate(target) if k % 5], target[::5]) if len(target) > 9 else (target, target)
    ratio = ratios(binary_text(docs, doc_id, text), learnt, buckets)
    weighed = saved(weigh(docs, ratio, doc_id, text, seed), "weights")
    if share is None:
        chosen = weighed.join(F.broadcast(spark.createDataFrame(pa.table({"doc_id": pa.array(unseen, pa.int64())}))), "doc_id")  # at most ``rows`` ids
        least = kth_largest(chosen, "log_weight", math.ceil((1 - loss) * chosen.count()))
        k = weighed.filter(F.col("log_weight") >= F.lit(-math.inf if least is None else least)).count()
    else:
        k = math.ceil(share * weighed.count())
    least = kth_largest(weighed, "key", k)
    kept = F.col("key") >= F.lit(-math.inf if least is None else least)
    if whole_rows:
        return weigh(docs, ratio, doc_id, text, seed, F.struct(*docs.columns).alias("row")).filter(kept).select("row.*")
    return weighed.withColumn("kept", kept)
