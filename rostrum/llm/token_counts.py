"""Operator 3: exact token counts of texts of any length by overlapping chunks.

A text is cut into chunks that overlap. Each chunk is encoded with the offsets of its units. Two neighbours are spliced at an offset
that is a boundary in both: a place where white space begins after another character, at which the vocabulary's pattern always
splits, whatever stands before or after. Tokens before it come from the first chunk, those after it from the second. Where the overlap
holds no such place, the first chunk is encoded anew with twice the overlap, up to the end of the text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rostrum.llm.encoders import cache_of, spaced_units
from rostrum.llm.fixed import binary_text, bounded_batches
from rostrum.llm.words import PAD, texts_of

Encoded = tuple[np.ndarray, np.ndarray]  # ends of the units, tokens up to each


def encode_all(chunks: list[bytes], path: str) -> list[Encoded]:
    """Unit ends and running token counts of every chunk."""
    data = b"".join(chunks)
    buf = np.zeros(len(data) + PAD, np.uint8)
    buf[: len(data)] = np.frombuffer(data, np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(c) for c in chunks])]).astype(np.int64)
    starts, ends, ptr = spaced_units(buf, offsets)
    pool, off, length = cache_of(path, True)[1].lookup(buf, starts, ends)
    counts = pool[off] if len(off) else length
    return [(ends[a:b] - offsets[i], np.cumsum(counts[a:b])) for i, (a, b) in enumerate(zip(ptr[:-1].tolist(), ptr[1:].tolist()))]


def before(e: Encoded, at: int) -> int:
    """Tokens of the units that end at ``at`` or earlier."""
    k = int(np.searchsorted(e[0], at, side="right"))
    return int(e[1][k - 1]) if k else 0


def splice(text: bytes, starts: list[int], encoded: list[Encoded], overlap: int, encode: Callable[[bytes], Encoded]) -> tuple[int, int]:
    """Tokens of the text and the number of widened overlaps."""
    total, widened, i = 0, 0, 0
    origin, cur, skip = 0, encoded[0], 0  # the chunk in hand, and its tokens before the last splice
    stop = min(starts[1] + overlap, len(text)) if len(starts) > 1 else len(text)
    while i + 1 < len(starts):
        nxt, wide = starts[i + 1], overlap
        while True:
            ours, theirs = cur[0][:-1] + origin, encoded[i + 1][0] + nxt  # the end of a chunk is no boundary of the text
            ours = ours[ours > nxt]
            common = np.intersect1d(ours, theirs[:-1], assume_unique=True)
            if len(common) or stop == len(text):
                break
            wide *= 2
            stop = min(nxt + wide, len(text))
            cur = encode(text[origin:stop])
            widened += 1
            while i + 2 < len(starts) and starts[i + 2] < stop and not len(np.intersect1d(cur[0][:-1] + origin, encoded[i + 1][0][:-1] + nxt)):
                i += 1  # the whole next chunk holds no boundary
                nxt = starts[i + 1]
        if not len(common):
            break  # the chunk in hand reaches the end of the text
        at = int(common[0])
        total += before(cur, at - origin) - skip
        i += 1
        origin, cur = nxt, encoded[i]
        skip = before(cur, at - origin)
        stop = min(starts[i + 1] + overlap, len(text)) if i + 1 < len(starts) else len(text)
    return total + (int(cur[1][-1]) if len(cur[1]) else 0) - skip, widened


def count_texts(texts: list[bytes], path: str, chunk: int, overlap: int) -> list[tuple[int, int, int]]:
    """(tokens, chunks, widened overlaps) per text."""
    cuts = [list(range(0, max(len(t) - overlap, 1), chunk)) for t in texts]
    parts = [t[s: s + chunk + overlap] for t, starts in zip(texts, cuts) for s in starts]
    encoded = encode_all(parts, path)
    out, a = [], 0
    for t, starts in zip(texts, cuts):
        own = encoded[a: a + len(starts)]
        a += len(starts)
        tokens, widened = splice(t, starts, own, overlap, lambda s: encode_all([s], path)[0])
        out.append((tokens, len(starts), widened))
    return out


def token_counts(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", limit: int = 512, chunk: int = 1 << 14,
                 overlap: int = 1 << 9) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit, n_chunks, n_widened) per row, n_tokens as the library of ``path`` counts them.

    A null text counts as an empty one: no bytes and no tokens. Rows are counted where they lie, without a shuffle; rows that repeat
    are counted each. Texts without white space are encoded whole, by widening.
    """
    bounded_batches(docs.sparkSession)

    def kernel(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            buf, offsets = texts_of(batch)
            data = buf.tobytes()
            texts = [data[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            found = count_texts(texts, path, chunk, overlap)
            n = np.array([f[0] for f in found], np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(offsets)), pa.array(n), pa.array(n > limit),
                 pa.array([f[1] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit", "n_chunks", "n_widened"])

    return binary_text(docs, doc_id, text).mapInArrow(
        kernel, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, n_chunks long, n_widened long")
