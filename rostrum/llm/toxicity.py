"""Operator 7: toxicity by averaged subword embeddings and a linear softmax.

A word is the mean of the vectors of its byte n-grams (3 to 6, with border marks) and of itself, a window the mean of its words; a softmax
over the window's vector tells how likely label 1 is. Vectors and softmax are trained together with numpy on a bounded sample of labelled
rows. Unseen spellings share n-gram vectors with known ones. A text is as toxic as its worst window; all its windows count.

As the softmax is linear, the embedding table reduces to one number per n-gram for scoring, and a word's number is computed once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from rostrum.llm.fixed import SMALL_BATCH_BYTES, binary_text, bounded_batches
from rostrum.llm.words import PAD, UnitCache, hash_spans, lanes_of, mix, per_row, ragged, texts_of, words_of

_LANE = np.array([(1 << (8 * n)) - 1 for n in range(8)], np.uint64)


def subwords(words: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each word's n-grams and of the word itself, one after the other, and how many each word has."""
    data = b"".join([b"<" + w + b">" for w in words])
    buf = np.zeros(len(data) + PAD, np.uint8)
    buf[: len(data)] = np.frombuffer(data, np.uint8)
    lens = np.array([len(w) + 2 for w in words], np.int64)
    starts = np.cumsum(lens) - lens
    lanes, place = lanes_of(buf), np.arange(len(buf))
    found, owner = [hash_spans(buf, starts, starts + lens)], [np.arange(len(words))]
    for n in range(3, 7):
        count = np.maximum(lens - n + 1, 0)
        found.append(mix((lanes[ragged(place, starts, count)] & _LANE[n]) ^ np.uint64(n << 56)))
        owner.append(np.repeat(np.arange(len(words)), count))
    who = np.concatenate(owner)
    order = np.argsort(who, kind="stable")
    return (np.concatenate(found)[order] & np.uint64(buckets - 1)).astype(np.int64), np.bincount(who, minlength=len(words))


@dataclass
class Model:
    """What scoring needs: one number per n-gram bucket, the bias, the line that makes a window's value a probability, the value of no window."""
    value: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0
    window: int = 12
    nothing: float = 0.0

    def words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        flat, lens = subwords(words, len(self.value))
        ptr = np.concatenate([[0], np.cumsum(lens)])
        return per_row(self.value[flat].astype(np.float64), ptr) / lens, np.ones(len(words), np.int64)

    def worst(self, values: np.ndarray, ptr: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest window mean of each row and the window's first word; rows without a word have the value of none."""
        total = np.concatenate([[0.0], np.cumsum(values)])
        n = np.diff(ptr)
        size = np.minimum(n, self.window)
        count = np.where(n > 0, n - size + 1, 0)
        first = ragged(np.arange(len(values) + 1), ptr[:-1], count)
        width = np.repeat(size, count)
        means = (total[first + width] - total[first]) / np.maximum(width, 1)
        best, at = np.zeros(len(n)), np.zeros(len(n), np.int64)
        some = np.flatnonzero(count)
        if len(some):
            cuts = (np.cumsum(count) - count)[some]
            best[some] = np.maximum.reduceat(means, cuts)
            hit = np.flatnonzero(means == np.repeat(best[some], count[some]))
            at[some] = first[hit[np.searchsorted(hit, cuts)]]
        return np.where(n > 0, best + self.bias, self.nothing), at

    def probability(self, z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * z + self.shift, -60, 60)))


def train(texts: list[bytes], labels: list[int], negatives_per_positive: float = 1.0, buckets: int = 1 << 16, size: int = 12, epochs: int = 14,
          warm_up: int = 5, batch: int = 128, rate: float = 0.5, window: int = 12, seed: int = 7) -> Model:
    """Fit embeddings and softmax jointly with AdaGrad on windows of the texts.

    The first epochs draw windows at random; later ones take the window that the model finds worst, in clean texts as well, and a random one
    of each clean text. A fifth of the texts is kept back to fit the final line, with the classes weighed as they occur.
    """
    rng = np.random.default_rng(seed)
    data = b"\n".join(texts)
    buf = np.zeros(len(data) + PAD, np.uint8)
    buf[: len(data)] = np.frombuffer(data, np.uint8)
    lens = np.array([len(t) + 1 for t in texts], np.int64)
    offsets = np.concatenate([[0], np.cumsum(lens)])
    offsets[-1] -= 1
    starts, ends, ptr = words_of(buf, offsets)
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(data[a:b], len(known)) for a, b in zip(starts.tolist(), ends.tolist())), np.int64, len(starts))
    flat, count = subwords(list(known), buckets)
    first = np.cumsum(count) - count
    y, n = np.array(labels, np.int64), np.diff(ptr)
    held = (np.arange(len(texts)) % 5 == 0) | (n == 0)
    learn = np.flatnonzero(~held)

    table = rng.normal(0, 0.3, (buckets, size)).astype(np.float32)
    soft, bias = rng.normal(0, 0.3, (2, size)).astype(np.float32), np.zeros(2, np.float32)
    g_table, g_soft, g_bias = np.full_like(table, 1e-4), np.full_like(soft, 1e-4), np.full_like(bias, 1e-4)

    def step(at: np.ndarray, width: np.ndarray, target: np.ndarray) -> None:
        word = ids[ragged(np.arange(len(ids)), at, width)]
        sub = flat[ragged(np.arange(len(flat)), first[word], count[word])]
        owner = np.repeat(np.repeat(np.arange(len(at)), width), count[word])
        weight = (1 / np.repeat(np.repeat(width, width) * count[word], count[word])).astype(np.float32)
        x = np.stack([np.bincount(owner, weight * table[sub, d], len(at)) for d in range(size)], axis=1).astype(np.float32)
        z = x @ soft.T + bias
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(at)), target] -= 1
        back = p @ soft
        for param, past, grad in ((soft, g_soft, p.T @ x), (bias, g_bias, p.sum(axis=0))):
            past += grad * grad
            param -= rate * 0.2 * grad / np.sqrt(past)
        rows, inverse = np.unique(sub, return_inverse=True)
        grad = np.stack([np.bincount(inverse, weight * back[owner, d], len(rows)) for d in range(size)], axis=1).astype(np.float32)
        g_table[rows] += grad * grad
        table[rows] -= rate * grad / np.sqrt(g_table[rows])

    def model() -> Model:
        way = soft[1] - soft[0]
        return Model((table @ way).astype(np.float32), float(bias[1] - bias[0]), window=window)

    for epoch in range(epochs):
        width = np.minimum(n[learn], window)
        free = ptr[learn] + (rng.random(len(learn)) * (n[learn] - width + 1)).astype(np.int64)
        if epoch < warm_up:
            at, who = free, learn
        else:
            now = model()
            values = (per_row(now.value[flat].astype(np.float64), np.concatenate([[0], np.cumsum(count)])) / count)[ids]
            worst = now.worst(values, ptr)[1][learn]
            clean = y[learn] == 0
            at, who, width = np.concatenate([worst, free[clean]]), np.concatenate([learn, learn[clean]]), np.concatenate([width, width[clean]])
        order = rng.permutation(len(at))
        for k in range(0, len(order), batch):
            part = order[k: k + batch]
            step(at[part], width[part], y[who[part]])

    out = model()
    values = (per_row(out.value[flat].astype(np.float64), np.concatenate([[0], np.cumsum(count)])) / count)[ids] if len(ids) else np.empty(0)
    z = out.worst(values, ptr)[0][held]
    clean = z[(y[held] == 0) & (n[held] > 0)]
    out.nothing = float(np.median(clean)) if len(clean) else -10.0  # an empty text is scored as a middling clean one
    z[n[held] == 0] = out.nothing
    out.slope, out.shift = _line(z, y[held], np.where(y[held] == 0, negatives_per_positive, 1.0))
    return out


def _line(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Logistic regression on one number by Newton steps, lightly pulled to a slope of 1."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -60, 60)))
        r, w = weight * (p - y), weight * p * (1 - p)
        grad = np.array([(r * z).sum() + 0.1 * (a - 1), r.sum() + 0.01 * b])
        hess = np.array([[(w * z * z).sum() + 0.1, (w * z).sum()], [(w * z).sum(), w.sum() + 0.01]])
        da, db = np.linalg.solve(hess, grad)
        a, b = a - np.clip(da, -2, 2), b - np.clip(db, -2, 2)
    return float(max(a, 1e-3)), float(b)


def held_out(doc_id: str = "doc_id") -> F.Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def labelled_ids(labels: DataFrame, doc_id: str, label: str, value: int, rows: int) -> list[int]:
    """At most ``rows`` ids with the label's value, chosen by their hash among those that may be learned from."""
    found = labels.filter(F.col(label) == value).filter(F.col(doc_id).isNotNull()).filter(~held_out(doc_id)).select(F.col(doc_id).cast("long").alias("i")).distinct()
    return [r["i"] for r in found.orderBy(F.xxhash64("i"), "i").limit(rows).collect()]


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", rows: int = 1700, max_words: int = 1500,
        **training) -> Model | None:
    """Train on at most ``rows`` labelled documents of each class of at most ``max_words`` words; None where a class has none."""
    bounded_batches(docs.sparkSession, SMALL_BATCH_BYTES)
    known = {i: v for v in (0, 1) for i in labelled_ids(labels, doc_id, label, v, rows)}
    ids = np.array(sorted(known), np.int64)

    def kernel(batches):
        for batch in batches:
            own = batch.column("doc_id")
            mask = np.isin(own.fill_null(0).to_numpy(zero_copy_only=False), ids) & own.is_valid().to_numpy(zero_copy_only=False)
            part = batch.filter(pa.array(mask))
            if part.num_rows:
                buf, offsets = texts_of(part, lower=True)
                short = np.diff(words_of(buf, offsets)[2]) <= max_words
                data = buf.tobytes()
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column("doc_id").filter(pa.array(short)),
                    "text": pa.array([data[a:b] for a, b, s in zip(offsets[:-1], offsets[1:], short) if s], pa.binary())})

    # Of rows that repeat an id the smallest text counts, so at most one row per chosen id comes here.
    found = binary_text(docs, doc_id, text).mapInArrow(kernel, "doc_id long, text binary").groupBy("doc_id").agg(F.min("text").alias("text"))
    sample = {r["doc_id"]: bytes(r["text"]) for r in found.collect()}
    chosen = sorted(sample)
    share = {r[0]: r[1] for r in labels.filter(F.col(label).isin(0, 1) & ~held_out(doc_id)).groupBy(label).count().collect()}
    if len({known[i] for i in chosen}) < 2:
        return None
    ratio = share[0] / share[1] * sum(known[i] for i in chosen) / sum(1 - known[i] for i in chosen)
    return train([sample[i] for i in chosen], [known[i] for i in chosen], ratio, **training)


def score(docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text", *more: str | F.Column) -> DataFrame:
    """(doc_id, score, predicted) per row, and the named columns; null and empty texts have the model's value of no window.

    Without a model (no labels to learn from) every score is 0.
    """
    bounded_batches(docs.sparkSession, SMALL_BATCH_BYTES)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    holder: dict = {}  # one cache per worker's copy of this function
    kept = binary_text(docs, doc_id, text, *more)
    more = kept.columns[2:]

    def kernel(batches):
        own = shared.value
        cache = holder.setdefault("cache", UnitCache(own.words if own else None))
        for batch in batches:
            if own is None:
                p = np.zeros(batch.num_rows)
            else:
                buf, offsets = texts_of(batch, lower=True)
                starts, ends, ptr = words_of(buf, offsets)
                pool, off, _ = cache.lookup(buf, starts, ends)
                p = own.probability(own.worst(pool[off] if len(off) else np.empty(0), ptr)[0])
            extra = [batch.column(c) for c in more]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32)), *extra],
                                             names=["doc_id", "score", "predicted", *more])

    schema = StructType([StructField("doc_id", LongType()), StructField("score", DoubleType()), StructField("predicted", IntegerType()),
                         *[kept.schema[c] for c in more]])
    return kept.mapInArrow(kernel, schema)


def toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", **fitting) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row; labels of held-out ids are not learned from."""
    model = fit(docs, labels, doc_id, text, **fitting)
    return score(docs, model, doc_id, text).select("doc_id", held_out().alias("held_out"), "score", "predicted")
