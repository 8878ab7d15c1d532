"""Operator 4: sum-of-squares packing of token sequences into windows.

Every partition packs its own documents in the order in which they come. A level array counts the partially filled windows per fill level; a
piece goes to the level for which the sum of the squared counts becomes smallest, a new window included. Documents longer than a window fill
whole ones first. At the end of a partition no further document comes, so the open windows are taken apart, the emptiest first, and their pieces
placed by the same rule among the others, where a piece may now be cut to complete a window: a completed window lowers the squared counts like any
other move. One window per partition stays padded. The same step keeps the memory bounded: where no uncut choice completes windows (documents of more
than half a window each), the emptiest window is taken apart as soon as more than ``max_open`` are open.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rostrum.llm.encoders import cache_of
from rostrum.llm.fixed import SMALL_BATCH_BYTES, binary_text, bounded_batches
from rostrum.llm.words import per_row, ragged, texts_of, words_of

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
Piece = tuple[int | None, int, np.ndarray, int]  # document, start, ids, tokens of the document


class Packer:
    """Online packing of one partition; ``done`` collects (piece, sequence, offset) of closed windows."""

    def __init__(self, window: int, max_open: int = 4096, first: int = 0):
        self.window, self.max_open, self.next = window, max(1, max_open), first
        self.level = np.zeros(window + 1)
        self.level[window] = -0.5  # closing a window takes its count away and adds none
        self.open: list[list[list[Piece]]] = [[] for _ in range(window)]
        self.n_open = 0
        self.done: list[tuple[Piece, int, int]] = []

    def close(self, pieces: list[Piece]) -> None:
        at = 0
        for p in pieces:
            self.done.append((p, self.next, at))
            at += len(p[2])
        self.next += 1

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        w, n = self.window, len(ids)
        whole = n - n % w
        for s in range(0, whole, w):
            self.close([(doc, s, ids[s: s + w], n)])
        if whole < n:
            self.place((doc, whole, ids[whole:], n))

    def place(self, piece: Piece) -> None:
        w, s, level = self.window, len(piece[2]), self.level
        filled = level[1: w - s + 1]
        gain = np.where(filled > 0, level[1 + s:] - filled, np.inf)
        h = len(gain) - int(np.argmin(gain[::-1])) if len(gain) else 0  # among equals the fullest
        if h and gain[h - 1] <= level[s] - 0.5:
            self._put(h, piece)
            return
        self.open[s].append([piece])
        level[s] += 1
        self.n_open += 1
        if self.n_open > self.max_open:
            self.empty_one()

    def _put(self, h: int, piece: Piece) -> None:
        """Add a piece that fits to the last opened window of level ``h``."""
        pieces = self.open[h].pop()
        self.level[h] -= 1
        pieces.append(piece)
        h += len(piece[2])
        if h == self.window:
            self.close(pieces)
            self.n_open -= 1
        else:
            self.open[h].append(pieces)
            self.level[h] += 1

    def place_cut(self, piece: Piece) -> None:
        """Place a piece by the same rule where it may be cut: the part that completes a window stays there, the rest is placed again.

        No window is opened unless none is open. Among equals a place without a cut is taken, then the fullest.
        """
        w = self.window
        while len(piece[2]):
            doc, start, ids, n = piece
            s = len(ids)
            filled = self.level[1:w]
            after = self.level[np.minimum(np.arange(1, w) + s, w)]
            gain = np.where(filled > 0, after - filled, np.inf)
            best = np.flatnonzero(gain == gain.min()) + 1 if self.n_open else ()
            if not len(best):
                self.place(piece)
                return
            whole = best[best + s <= w]
            h = int((whole if len(whole) else best)[-1])
            self._put(h, (doc, start, ids[: w - h], n))
            piece = doc, start + min(s, w - h), ids[w - h:], n

    def empty_one(self) -> None:
        """Take the emptiest open window apart and place its pieces, cut where that completes a window."""
        h = int(np.argmax(self.level[1: self.window] > 0)) + 1
        pieces = self.open[h].pop()
        self.level[h] -= 1
        self.n_open -= 1
        for p in pieces:
            self.place_cut(p)

    def finish(self) -> None:
        """Take open windows apart, the emptiest first, until one is left, which is closed with padding."""
        while self.n_open > 1:
            self.empty_one()
        for windows in self.open:
            while windows:
                self.close(windows.pop())
        self.level[: self.window] = 0
        self.n_open = 0

    def take(self) -> list[tuple[Piece, int, int]]:
        out, self.done = self.done, []
        return out


def _batch(done: list[tuple[Piece, int, int]], with_ids: bool) -> pa.RecordBatch:
    cols = {
        "doc_id": pa.array([p[0] for p, _, _ in done], pa.int64()), "start": pa.array([p[1] for p, _, _ in done], pa.int64()),
        "length": pa.array([len(p[2]) for p, _, _ in done], pa.int64()),
        "ids_crc32": pa.array([zlib.crc32(p[2].astype("<u4").tobytes()) for p, _, _ in done], pa.int64()),
        "doc_tokens": pa.array([p[3] for p, _, _ in done], pa.int64()), "sequence_id": pa.array([s for _, s, _ in done], pa.int64()),
        "offset": pa.array([o for _, _, o in done], pa.int64())}
    if with_ids:
        cols["ids"] = pa.array([p[2].tolist() for p, _, _ in done], pa.list_(pa.int32()))
    return pa.RecordBatch.from_pydict(cols)


def pack(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", window: int = 2048, end_id: int = 1, with_ids: bool = False,
         max_open: int = 4096) -> DataFrame:
    """One row per piece: which ids of which document lie at which offset of which sequence; ``with_ids`` adds the ids themselves.

    A document's ids are those of the library in ``path`` without added ones, then ``end_id``; a null or empty text has ``end_id`` alone. Rows
    that repeat an id are packed each. A sequence number holds the partition's number in its upper bits, so partitions need no
    common counter and a repeated task gives the same rows. ``max_open`` windows are held open per task; no id is dropped at any value. Very long
    texts fill whole windows; columns of other names are ignored, an empty table gives no row.
    """
    bounded_batches(docs.sparkSession, SMALL_BATCH_BYTES)

    def kernel(batches: Iterator[pa.RecordBatch]):
        from pyspark import TaskContext
        packer = Packer(window, max_open, first=TaskContext.get().partitionId() << 32)
        cache = cache_of(path)[1]
        for batch in batches:
            buf, offsets = texts_of(batch)
            starts, ends, ptr = words_of(buf, offsets)
            pool, off, length = cache.lookup(buf, starts, ends)
            flat = ragged(pool, off, length) if len(off) else np.empty(0, np.int32)
            stops = np.cumsum(per_row(length, ptr)).tolist()
            a, end = 0, np.array([end_id], np.int32)
            for doc, b in zip(batch.column("doc_id").to_pylist(), stops):
                packer.add(doc, np.concatenate([flat[a:b], end]))
                a = b
            if packer.done:
                yield _batch(packer.take(), with_ids)
        packer.finish()
        if packer.done:
            yield _batch(packer.take(), with_ids)

    return binary_text(docs, doc_id, text).mapInArrow(kernel, PIECES + (", ids array<int>" if with_ids else ""))
