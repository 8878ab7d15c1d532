"""Token counts and packing against the library on whole texts."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from rostrum.llm import packing, token_counts as T
from rostrum.llm.encoders import cache_of
from rostrum.llm.words import PAD, ragged, words_of

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "\n\n", "a", "  a  b ", "don't we'll 'the 's", "<|endoftext|>", "x <|endoftext|>y  <|startoftext|> z", "a  b 　  c", "é́ ΣΑΣ İ",
       "1234 56,7%%%", "漢字かな　  x", "tab\t\ttab \r\n x", "    \x85 y", "!!! ... ,,.", "ß Straße ÄÖÜ", "a" * 3000, "😀 😀😀", "\x1c \x1f x", "  "]


def texts(n=400):
    t = pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["text"])["text"].to_pylist()[:n]
    rng = random.Random(7)
    letters = "ab é'sSt.,!  \n\n 漢1<|>"
    return [x or "" for x in t] + ODD + ["".join(rng.choice(letters) for _ in range(rng.randrange(200))) for _ in range(600)]


def library(path, found):
    t = Tokenizer.from_file(path)
    return [e.ids for e in t.encode_batch(found, add_special_tokens=False)]


@pytest.mark.parametrize("chunk,overlap", [(1 << 14, 1 << 9), (40, 8), (16, 2)])
def test_counts_equal_the_library(chunk, overlap):
    found = texts(120 if chunk < 100 else 400)
    got = T.count_texts([x.encode() for x in found], BYTE, chunk, overlap)
    assert [g[0] for g in got] == [len(i) for i in library(BYTE, found)]
    if chunk < 100:
        assert any(g[2] for g in got) and any(g[1] > 3 for g in got)


def test_word_ids_equal_the_library():
    found = texts()
    for text, want in zip(found, library(WORD, found)):
        data = text.encode()
        buf = np.zeros(len(data) + PAD, np.uint8)
        buf[: len(data)] = np.frombuffer(data, np.uint8)
        starts, ends, _ = words_of(buf, np.array([0, len(data)]))
        pool, off, length = cache_of(WORD)[1].lookup(buf, starts, ends)
        assert (ragged(pool, off, length).tolist() if len(off) else []) == want, text


def test_count_query_rows(spark):
    docs = spark.createDataFrame([(1, None, 7), (2, "", 7), (2, "a b", 8), (None, "x" * 50000, 9)], "doc_id long, text string, n_tokens long")
    rows = {(r.doc_id, r.n_bytes): (r.n_tokens, r.over_limit) for r in T.token_counts(docs, BYTE).collect()}
    assert rows[1, 0] == (0, False) and rows[2, 0] == (0, False) and rows[2, 3] == (2, False)
    assert rows[None, 50000] == (len(library(BYTE, ["x" * 50000])[0]), True)
    assert T.token_counts(docs.limit(0), BYTE).count() == 0


def check_pieces(rows, want, window=2048):
    """Every id lies in one piece, sequences have no gap and no overflow."""
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for doc, ids in want.items():
        at = 0
        for r in sorted(by_doc[doc], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            part = np.array(ids[at: at + r["length"]], "<u4")
            assert zlib.crc32(part.tobytes()) == r["ids_crc32"]
            at += r["length"]
        assert at == len(ids)
    fills = []
    for parts in by_seq.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at and n > 0
            at += n
        assert at <= window
        fills.append(at)
    return fills


def test_packing_is_whole(spark):
    found = texts()
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(found)] + [(10**6, None)], "doc_id long, text string").repartition(3)
    rows = [r.asDict() for r in packing.pack(docs, WORD).collect()]
    want = {i: ids + [1] for i, ids in enumerate(library(WORD, found))} | {10**6: [1]}
    fills = check_pieces(rows, want)
    assert sum(f < 2048 for f in fills) <= 3
    assert packing.pack(docs.limit(0), WORD).count() == 0


def test_level_rule_by_brute_force():
    rng = np.random.default_rng(3)
    packer, levels = packing.Packer(32), {}
    for i in range(400):
        s = int(rng.integers(1, 32))
        options = {h: _after(levels, h, s, 32) for h in [0, *[h for h, n in levels.items() if n and h + s <= 32]]}
        before = dict(levels)
        packer.place((i, 0, np.zeros(s, np.int32), s))
        now = {h: len(w) for h, w in enumerate(packer.open) if w}
        cost = sum(n * n for n in now.values())
        assert cost == min(options.values()), (before, s)
        levels = now


def _after(levels, h, s, w):
    new = dict(levels)
    if h:
        new[h] -= 1
    if h + s < w:
        new[h + s] = new.get(h + s, 0) + 1
    return sum(n * n for n in new.values())


@pytest.mark.parametrize("sizes,max_open", [((1, 32), 4096), ((17, 32), 4096), ((1, 80), 3), ((17, 32), 5)])
def test_every_placement_follows_the_rule(sizes, max_open):
    """Each step, those of the end and of the memory bound included, reaches the smallest sum of squares among all its options."""
    w, cuts, cut_of = 32, [], packing.Packer._put

    class Watched(packing.Packer):
        def counts(self):
            assert [len(x) for x in self.open[1:]] == self.level[1:w].tolist()
            return {h: len(x) for h, x in enumerate(self.open) if x}

        def place_cut(self, piece):
            self.left = len(piece[2])
            super().place_cut(piece)
            self.left = 0

        def _put(self, h, piece):
            before, s = self.counts(), self.left or len(piece[2])
            fits = [_after(before, x, min(s, w - x), w) for x in before if self.left or x + s <= w]
            cut_of(self, h, piece)
            assert sum(n * n for n in self.counts().values()) == min(fits)
            if self.left:
                self.left -= len(piece[2])
                cuts.append(self.left)

    rng = np.random.default_rng(11)
    packer, want = Watched(w, max_open), {}
    packer.left = 0
    for i in range(500):
        ids = rng.integers(0, 1000, rng.integers(*sizes)).astype(np.int32)
        want[i] = ids.tolist()
        packer.add(i, ids)
        assert packer.n_open <= max_open
    packer.finish()
    assert cuts
    assert sum(f < w for f in check_pieces(rows_of(packer), want, w)) <= 1


def rows_of(packer):
    return [{"doc_id": p[0], "start": p[1], "length": len(p[2]), "ids_crc32": zlib.crc32(p[2].astype("<u4").tobytes()), "doc_tokens": p[3],
             "sequence_id": s, "offset": o} for p, s, o in packer.take()]


def test_memory_bound_keeps_every_piece():
    packer, want = packing.Packer(16, max_open=2), {}
    rng = np.random.default_rng(5)
    for i in range(300):
        ids = rng.integers(0, 1000, rng.integers(1, 40)).astype(np.int32)
        want[i] = ids.tolist()
        packer.add(i, ids)
    packer.finish()
    assert sum(f < 16 for f in check_pieces(rows_of(packer), want, 16)) <= 1


def test_packing_of_odd_rows(spark):
    """Repeated ids are packed each, null texts have the end alone, columns of other names do no harm."""
    docs = spark.createDataFrame([(1, "a b", 7, 9), (1, "a b", 7, 9), (2, None, 7, 9), (None, "x " * 9000, 7, 9)], "doc_id long, text string, offset long, length long")
    rows = packing.pack(docs.coalesce(1), WORD).collect()
    ids = {t: len(library(WORD, [t])[0]) + 1 for t in ("a b", "x " * 9000)}
    assert sorted((r.doc_id, r.start, r.length) for r in rows if r.doc_id == 1 and r.start == 0)[0][2] <= ids["a b"]
    assert sum(r.length for r in rows if r.doc_id == 1) == 2 * ids["a b"] and sum(r.length for r in rows if r.doc_id == 2) == 1
    assert sum(r.length for r in rows if r.doc_id is None) == ids["x " * 9000]
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)
