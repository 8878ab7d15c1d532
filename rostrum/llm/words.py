"""Words of whole Arrow batches as numpy arrays: spans, 64-bit hashes, and values computed once per distinct word.

A column of texts is one byte buffer with offsets, so words are found, hashed and looked up for all texts of a batch at once;
no Python object is made per word. Two words count as equal when their 64-bit hashes are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash

PAD = 8
LONG = 512  # longer spans are hashed one by one

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
WORDLIKE = np.zeros(256, bool)  # ASCII letters and digits, and every byte of a longer character
WORDLIKE[48:58] = WORDLIKE[65:91] = WORDLIKE[97:123] = WORDLIKE[128:] = True

_MASK = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], dtype=np.uint64)
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)
_S = np.uint64(32)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> _S)) * _B
    x = (x ^ (x >> _S)) * _B
    return x ^ (x >> _S)


def chain(*hashes: np.ndarray) -> np.ndarray:
    """One hash of a sequence of hashes, element by element."""
    out = np.full(len(hashes[0]), len(hashes), np.uint64)
    for h in hashes:
        out = mix((out * _C) ^ h)
    return out


def texts_of(batch: pa.RecordBatch, name: str = "text", lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a binary column, followed by padding, and the offsets of its rows; a null text is an empty one."""
    col = batch.column(name)
    if col.null_count:
        col = col.fill_null(b"")
    wide = pa.types.is_large_binary(col.type) or pa.types.is_large_string(col.type)
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[col.offset: col.offset + len(col) + 1].astype(np.int64)
    n = int(off[-1] - off[0])
    buf = np.zeros(n + PAD, np.uint8)
    if n:
        part = np.frombuffer(data, np.uint8)[off[0]: off[-1]]
        buf[:n] = LOWER[part] if lower else part
    return buf, off - off[0]


def runs(solid: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of marked bytes that do not cross a row: starts, ends, and the index of each row's first run."""
    n = len(solid)
    border = np.zeros(n + 1, bool)
    border[offsets] = True
    before = border[:n].copy()
    before[1:] |= ~solid[:-1]
    after = border[1:].copy()
    after[:-1] |= ~solid[1:]
    starts = np.flatnonzero(solid & before)
    return starts, np.flatnonzero(solid & after) + 1, np.searchsorted(starts, offsets)


def words_of(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of the words ``[^\\x20\\x09-\\x0D]+`` and the index of each row's first word."""
    return runs(~SPACE[buf[: len(buf) - PAD]], offsets)


def lanes_of(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from every position on as one number; a view on the buffer."""
    return np.ndarray((len(buf) - PAD + 1,), "<u8", buffer=buf, strides=(1,))


def hash_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans; spans of up to eight bytes of one length never collide."""
    lens = ends - starts
    h = lens.astype(np.uint64) * _A
    if not len(h):
        return h
    lanes = lanes_of(buf)
    long = np.flatnonzero(lens > LONG)
    live = np.flatnonzero(lens <= LONG) if len(long) else None
    pos, rem, part = (starts, lens, h) if live is None else (starts[live], lens[live], h[live])
    at = live
    while len(pos):
        part = mix(part ^ (lanes[pos] & _MASK[np.minimum(rem, 8)]))
        if at is None:
            h = part
        else:
            h[at] = part
        more = np.flatnonzero(rem > 8)
        at = more if at is None else at[more]
        pos, rem, part = pos[more] + 8, rem[more] - 8, part[more]
    for i in long:
        h[i] = xxhash.xxh3_64_intdigest(buf[starts[i]: ends[i]].tobytes(), seed=1)
    return h


def ragged(pool: np.ndarray, off: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The pieces pool[off : off + length] one after the other."""
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return pool[np.repeat(off - ends + length, length) + np.arange(total)]


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, a position of each, and the number of each element's key."""
    order = np.argsort(keys)
    s = keys[order]
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    inverse = np.empty(len(s), np.int64)
    inverse[order] = np.cumsum(new) - 1
    return s[new], order[new], inverse


class UnitCache:
    """Values of byte strings, computed once per distinct string while it stays in the cache.

    ``compute(list of bytes)`` gives one flat array and the number of entries per string. Beyond ``capacity`` strings the cache
    starts anew, which costs time and never changes a value.
    """

    def __init__(self, compute: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], capacity: int = 600_000):
        self.compute, self.capacity = compute, capacity
        self.keys = np.empty(0, np.uint64)

    def lookup(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, found: tuple | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pool, offset, length): where the values of each span lie in the pool. ``found`` are the distinct hashes of the spans, where known."""
        uniq, first, inverse = distinct(hash_spans(buf, starts, ends)) if found is None else found
        if len(self.keys) > self.capacity:
            self.keys = np.empty(0, np.uint64)
        pos = np.searchsorted(self.keys, uniq)
        if len(self.keys):
            held = self.keys[np.minimum(pos, len(self.keys) - 1)] == uniq
        else:
            held = np.zeros(len(uniq), bool)
        miss = np.flatnonzero(~held)
        if len(miss):
            data = buf.tobytes()
            at = first[miss]
            flat, length = self.compute([data[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())])
            length = np.asarray(length, np.int64)
            off = np.cumsum(length) - length
            if len(self.keys):
                off += len(self.pool)
                self.pool = np.concatenate([self.pool, flat])
                self.off, self.len = np.insert(self.off, pos[miss], off), np.insert(self.len, pos[miss], length)
                self.keys = np.insert(self.keys, pos[miss], uniq[miss])
            else:
                self.pool, self.off, self.len, self.keys = np.asarray(flat), off, length, uniq
            pos = np.searchsorted(self.keys, uniq)
        if not len(uniq):
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        return self.pool, self.off[pos][inverse], self.len[pos][inverse]


def per_row(values: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """Sums of values[ptr[i] : ptr[i + 1]]."""
    total = np.zeros(len(values) + 1, values.dtype if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[ptr[1:]] - total[ptr[:-1]]


def groups(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[dict[str, list]]:
    """Runs of rows with equal keys in sorted batches, as columns of Python values; holds one run at a time."""
    names: list[str] = []
    held: dict[str, list] | None = None
    last = None
    for batch in batches:
        names = batch.schema.names
        cols = {c: batch.column(c).to_pylist() for c in names}
        ids = list(zip(*[cols[k] for k in keys]))
        a = 0
        for i in range(1, len(ids) + 1):
            if i < len(ids) and ids[i] == ids[a]:
                continue
            part = {c: v[a:i] for c, v in cols.items()}
            if held is not None and last == ids[a]:
                for c in names:
                    held[c] += part[c]
            else:
                if held is not None:
                    yield held
                held, last = part, ids[a]
            a = i
    if held is not None:
        yield held


def rows(schema: pa.Schema, **columns: object) -> pa.RecordBatch:
    """A record batch of the given columns in the order of the schema."""
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)
