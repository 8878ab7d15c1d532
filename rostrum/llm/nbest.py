"""Operator 5: the n best segmentations of a text into the pieces of a SentencePiece vocabulary, and back.

The lattice of a text has an edge for every vocabulary piece and a heavily scored edge of byte pieces for a character that has none. Where no piece
crosses a place (before a run of blanks marks), the lattice falls into units. All distinct units of a batch get forward and
backward Viterbi scores together, as arrays; the gap between the best path and the best path through any edge off it tells how little a second
choice costs. Only the n - 1 units of a text with the smallest gaps can differ in one of its n best paths. Each of those is searched by A-star from its end
backwards; the forward score of a place is the exact cost still to come, so every path that is taken out is the next best.

The scores of a BPE vocabulary are ranks of merges, whose sum the lattice makes largest; its best path is not the model's encoding there. That is given
beside the paths: merges do not cross units either, so the library encodes every distinct unit of a batch once.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rostrum.llm.fixed import binary_text, bounded_batches
from rostrum.llm.words import PAD, UnitCache, distinct, hash_spans, mix, texts_of

BLANK = "▁"
_BLANK = BLANK.encode()
_NONE = -np.inf
BITS = 20  # bit tables of hashes that tell quickly what is no piece
_SHIFT = np.uint64(64 - BITS)
UNKNOWN = 10.0  # fixed value: how far below the smallest score a character without a piece lies


class Pieces:
    """Vocabulary, lattice scores, and both directions of segmentation."""

    def __init__(self, path: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.model = model
        size = model.vocab_size()
        ordinary = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        text = {i: model.id_to_piece(i) for i in ordinary}
        if any(BLANK in p.lstrip(BLANK) for p in text.values()):
            raise ValueError(f"{path} has pieces with blanks inside, so units are not proven")
        self.score = {text[i]: (model.get_score(i), i) for i in ordinary}
        self.longest = max(map(len, self.score))
        byte = {int(model.id_to_piece(i)[3:5], 16): i for i in range(size) if model.is_byte(i)}
        self.byte = [byte.get(b, model.unk_id()) for b in range(256)]
        low = min((s for s, _ in self.score.values() if s > -1e8), default=0.0)
        self.unknown = low - UNKNOWN
        self.bytes_of = [b""] * size
        for i in ordinary:
            self.bytes_of[i] = text[i].encode()
        for b, i in byte.items():
            self.bytes_of[i] = bytes([b])
        keys, prefixes = self._hashes(list(self.score))
        order = np.argsort(keys)
        values = list(self.score.values())
        self.keys = keys[order]
        self.values = np.array([values[i][0] for i in order])
        self.ids = np.array([values[i][1] for i in order], np.int64)
        self.begins, self.whole = np.zeros(1 << BITS, bool), np.zeros(1 << BITS, bool)
        self.begins[prefixes >> _SHIFT] = True
        self.whole[keys >> _SHIFT] = True
        self.searched = lru_cache(maxsize=50_000)(self.best)

    @staticmethod
    def _hashes(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the pieces, and of all their beginnings."""
        lens = np.fromiter(map(len, pieces), np.int64, len(pieces))
        codes = np.frombuffer("".join(pieces).encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1 << 32)
        first, h, found = np.cumsum(lens) - lens, np.zeros(len(pieces), np.uint64), []
        for e in range(int(lens.max(initial=0))):
            r = np.flatnonzero(lens > e)
            h[r] = mix(h[r] ^ codes[first[r] + e])
            found.append(h[r])
        return h, np.concatenate(found) if found else h

    # ---- one unit

    def edges(self, unit: str, e: int) -> Iterator[tuple[int, float, tuple[int, ...]]]:
        """The edges (start, score, ids) that end at place ``e``."""
        for s in range(max(0, e - self.longest), e):
            hit = self.score.get(unit[s:e])
            if hit is not None:
                yield s, hit[0], (hit[1],)
        if unit[e - 1] not in self.score:
            yield e - 1, self.unknown, tuple(self.byte[b] for b in unit[e - 1].encode())

    def best(self, unit: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The n best (score, ids) of a unit by backward A-star; among equals the path that is nearest to its end goes on."""
        ahead = [0.0]
        for e in range(1, len(unit) + 1):
            ahead.append(max(ahead[s] + w for s, w, _ in self.edges(unit, e)))
        heap: list[tuple] = [(-ahead[-1], len(unit), 0, 0.0, None)]  # rank, place, number, score behind, ids behind
        out, number = [], 0
        while heap and len(out) < n:
            rank, at, _, done, behind = heapq.heappop(heap)
            if not at:
                ids: list[int] = []
                while behind is not None:
                    ids += behind[0]
                    behind = behind[1]
                out.append((-rank, tuple(ids)))
                continue
            for s, w, piece in self.edges(unit, at):
                number += 1
                heapq.heappush(heap, (-(ahead[s] + (w + done)), s, number, w + done, (piece, behind)))
        return out

    # ---- many units

    def compute(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Per unit its best score, its gap, and the ids of its best path, as one flat array."""
        texts = [u.decode("utf-8", "replace") for u in units]
        out: list[np.ndarray | None] = [None] * len(texts)
        by_size: dict[int, list[int]] = {}
        for i, t in enumerate(texts):
            by_size.setdefault(len(t), []).append(i)
        for size, rows in by_size.items():
            if size > 64 or len(rows) < 4:
                for i in rows:
                    two = self.best(texts[i], 2)
                    gap = two[0][0] - two[1][0] if len(two) > 1 else np.inf
                    out[i] = np.array([two[0][0], gap, *two[0][1]])
            else:
                for k in range(0, len(rows), 8192):
                    self._viterbi([texts[i] for i in rows[k: k + 8192]], rows[k: k + 8192], size, out)
        lens = np.fromiter(map(len, out), np.int64, len(out))
        return np.concatenate(out) if out else np.empty(0), lens

    def _viterbi(self, texts: list[str], rows: list[int], size: int, out: list) -> None:
        m = len(texts)
        codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).reshape(m, size).astype(np.uint64) + np.uint64(1 << 32)
        edges: dict[int, list[tuple[int, np.ndarray | slice, np.ndarray, np.ndarray]]] = {e: [] for e in range(1, size + 1)}  # start, rows, scores, ids
        every = slice(None)
        for s in range(size):
            live, h = np.arange(m), np.zeros(m, np.uint64)
            for e in range(s + 1, min(size, s + self.longest) + 1):
                h = mix(h ^ codes[live, e - 1])
                may = np.flatnonzero(self.whole[h >> _SHIFT])
                at = np.minimum(np.searchsorted(self.keys, h[may]), len(self.keys) - 1)
                hit = self.keys[at] == h[may]
                r, at = live[may[hit]], at[hit]
                if e == s + 1:
                    score, ids = np.full(m, self.unknown), np.full(m, -1)
                    score[r], ids[r] = self.values[at], self.ids[at]
                    edges[e].append((s, every, score, ids))
                elif len(r):
                    edges[e].append((s, r, self.values[at], self.ids[at]))
                on = np.flatnonzero(self.begins[h >> _SHIFT])  # others begin no piece
                if not len(on):
                    break
                if len(on) < len(live):
                    live, h = live[on], h[on]
        for own in edges.values():
            own.sort(key=lambda x: x[0])
        ahead, back, piece = np.full((size + 1, m), _NONE), np.zeros((size + 1, m), np.int64), np.full((size + 1, m), -1)
        ahead[0] = 0
        for e in range(1, size + 1):
            for s, r, w, ids in edges[e]:
                total = ahead[s][r] + w
                better = np.flatnonzero(total > ahead[e][r])
                to = better if r is every else r[better]
                ahead[e][to], back[e][to], piece[e][to] = total[better], s, ids[better]
        behind = np.full((size + 1, m), _NONE)
        behind[size] = 0
        for e in range(size, 0, -1):
            for s, r, w, _ in edges[e]:
                behind[s][r] = np.maximum(behind[s][r], w + behind[e][r])
        on = np.zeros((size + 1, m), bool)
        on[size] = True
        second = np.full(m, _NONE)
        found: list[tuple[np.ndarray, int, np.ndarray]] = []
        for e in range(size, 0, -1):
            r = np.flatnonzero(on[e])
            on[back[e][r], r] = True
            for s, to, w, _ in edges[e]:
                mine = on[e][to] & (back[e][to] == s)
                second[to] = np.maximum(second[to], np.where(mine, _NONE, ahead[s][to] + w + behind[e][to]))
            found.append((r, e, piece[e][r]))
        best = ahead[size]
        row = np.concatenate([f[0] for f in found])
        ids = np.concatenate([f[2] for f in found])
        end = np.concatenate([np.full(len(f[0]), f[1]) for f in found])
        order = np.lexsort((end, row))
        row, ids, end = row[order], ids[order], end[order]
        cut = np.searchsorted(row, np.arange(m + 1))
        odd = set(row[ids < 0].tolist())
        for k in range(m):
            own = ids[cut[k]: cut[k + 1]]
            if k in odd:
                own = np.array([j for i, e in zip(own.tolist(), end[cut[k]: cut[k + 1]].tolist())
                                for j in ([i] if i >= 0 else [self.byte[b] for b in texts[k][e - 1].encode()])], np.int64)
            out[rows[k]] = np.concatenate([[best[k], best[k] - second[k]], own])

    def encodings(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The model's own ids per unit, as one flat array, and their numbers. The library puts one blank before what it encodes."""
        texts = [u.decode("utf-8", "replace") for u in units]
        blank = self.score[BLANK][1] if BLANK in self.score else self.model.unk_id()
        found = [own if t != " " else [blank] for t, own in zip(texts, self.model.encode([t[1:] for t in texts], num_threads=1))]
        lens = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((i for own in found for i in own), np.int32, int(lens.sum())), lens

    # ---- texts

    def merge(self, units: list[str], n: int) -> list[tuple[float, tuple[tuple[int, ...], ...]]]:
        """The n best combinations (loss against the best, ids per unit) of units that do not depend on each other."""
        out: list[tuple[float, tuple[tuple[int, ...], ...]]] = [(0.0, ())]
        for u in units:
            found = self.searched(u, n)
            both = [(loss + found[0][0] - score, ids + (own,)) for loss, ids in out for score, own in found]
            out = sorted(both)[:n]
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of a segmentation; the blank that stands before every text is taken off."""
        text = b"".join(map(self.bytes_of.__getitem__, ids)).replace(_BLANK, b" ").decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def unit_spans(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Units of texts in which a blank is one byte: a run of blanks with what follows up to the next run."""
    n = len(buf) - PAD
    blank = buf[:n] == 32
    cut = np.zeros(n + 1, bool)
    cut[1:n] = blank[1:] & ~blank[:-1]
    cut[offsets] = True
    places = np.flatnonzero(cut)
    starts, ends = places[:-1], places[1:]
    ptr = np.searchsorted(starts, offsets)
    return starts, ends, ptr


@lru_cache(maxsize=2)
def pieces_of(path: str) -> tuple[Pieces, UnitCache, UnitCache]:
    """One vocabulary and its caches of paths and of encodings per worker process."""
    pieces = Pieces(path)
    return pieces, UnitCache(lambda units: pieces.compute([u.replace(b" ", _BLANK) for u in units]), 400_000), UnitCache(pieces.encodings, 400_000)


def nbest(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", n: int = 3, with_ids: bool = False) -> DataFrame:
    """(doc_id, rank, score, n_pieces, ids_crc32, round_trip, model_pieces, model_crc32) per row and rank from 1 to at most n.

    ``with_ids`` adds the ids of the path and ``model_ids``. The model columns tell of the vocabulary's own encoding of the text, as the library gives it,
    and are the same on all ranks; the path of rank 1 is that encoding where the scores are log-probabilities, and need not be it for BPE.
    Texts are taken as they are, with one blank put before them as the vocabulary expects. A null or empty text has one empty
    segmentation. ``round_trip`` tells whether the decoded ids are the text. Paths of equal score come in a fixed order.
    """
    bounded_batches(docs.sparkSession)

    def kernel(batches: Iterator[pa.RecordBatch]):
        pieces, cache, encoded = pieces_of(path)
        for batch in batches:
            raw, offsets = texts_of(batch)
            data = raw.tobytes()
            texts = [data[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            marked = [b" " + t if t else t for t in texts]
            joined = b"".join(marked)
            buf = np.zeros(len(joined) + PAD, np.uint8)
            buf[: len(joined)] = np.frombuffer(joined, np.uint8)
            cuts = np.concatenate([[0], np.cumsum([len(t) for t in marked])]).astype(np.int64)
            starts, ends, ptr = unit_spans(buf, cuts)
            units = distinct(hash_spans(buf, starts, ends))
            pool, off, length = cache.lookup(buf, starts, ends, units)
            own_pool, own_off, own_length = encoded.lookup(buf, starts, ends, units)
            cols: dict[str, list] = {c: [] for c in ("doc_id", "rank", "score", "n_pieces", "ids_crc32", "round_trip", "model_pieces", "model_crc32", "ids",
                                                     "model_ids")}
            for i, doc in enumerate(batch.column("doc_id").to_pylist()):
                a, b = int(ptr[i]), int(ptr[i + 1])
                found = _of_text(joined, pool, off[a:b], length[a:b], starts[a:b], ends[a:b], pieces, n) if b > a else [(0.0, np.empty(0, np.int32), False)]
                whole = texts[i].decode("utf-8", "replace")
                if BLANK in whole:  # the library takes it for a blank, so units do not part there
                    own = np.array(pieces.model.encode(whole), np.int32)
                else:
                    own = _joined(own_pool, own_off[a:b], own_length[a:b])
                model = (len(own), zlib.crc32(own.astype("<u4").tobytes()))
                trip = False
                for rank, (score, ids, same) in enumerate(found, 1):
                    trip = trip if same else pieces.decode(ids.tolist()) == whole
                    values = (doc, rank, score, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), trip, *model,
                              ids.tolist() if with_ids else None, own.tolist() if with_ids else None)
                    for c, v in zip(cols, values):
                        cols[c].append(v)
            if not with_ids:
                del cols["ids"], cols["model_ids"]
            kinds = {"score": pa.float64(), "rank": pa.int32(), "round_trip": pa.bool_(), "ids": pa.list_(pa.int32()), "model_ids": pa.list_(pa.int32())}
            yield pa.RecordBatch.from_pydict({c: pa.array(v, kinds.get(c, pa.int64())) for c, v in cols.items()})

    return binary_text(docs, doc_id, text).mapInArrow(
        kernel, "doc_id long, rank int, score double, n_pieces long, ids_crc32 long, round_trip boolean, model_pieces long, model_crc32 long"
        + (", ids array<int>, model_ids array<int>" if with_ids else ""))


def _joined(pool, off, length) -> np.ndarray:
    """The pieces of the units of one text one after the other."""
    if not len(off):
        return np.empty(0, np.int32)
    stop = np.cumsum(length)
    return pool[np.repeat(off - stop + length, length) + np.arange(int(stop[-1]))].astype(np.int32)


def _of_text(data: bytes, pool, off, length, starts, ends, pieces: Pieces, n: int) -> list[tuple[float, np.ndarray, bool]]:
    """The n best (score, ids, whether the ids stand for the same bytes as those before) of one text from the values of its units."""
    total, gaps = float(pool[off].sum()), pool[off + 1]
    size = length - 2
    stop = np.cumsum(size)
    flat = pool[np.repeat(off + 2 - stop + size, size) + np.arange(int(stop[-1]))].astype(np.int32)
    few = np.argpartition(gaps, n - 2)[: n - 1] if 1 < n <= len(gaps) else np.arange(len(gaps) if n > 1 else 0)
    if len(few):  # equal gaps at the border: the earlier units
        edge = gaps[few].max()
        under = np.flatnonzero(gaps < edge)
        few = np.concatenate([under, np.flatnonzero(gaps == edge)[: len(few) - len(under)]])
    vary = np.sort(few[np.isfinite(gaps[few])])
    names = [data[starts[i]: ends[i]].decode("utf-8", "replace").replace(" ", BLANK) for i in vary.tolist()]
    out, last = [], None
    for loss, ids in pieces.merge(names, n):
        said = [b"".join(map(pieces.bytes_of.__getitem__, own)) for own in ids]
        parts, at = [], 0
        for i, piece in zip(vary.tolist(), ids):
            parts += [flat[at: stop[i] - size[i]], np.array(piece, np.int32)]
            at = stop[i]
        out.append((total - loss, np.concatenate([*parts, flat[at:]]), said == last))
        last = said
    return out
