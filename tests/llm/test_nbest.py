"""N-best segmentation against all paths, the decoder against the library."""

import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import sentencepiece

from rostrum.llm import nbest as N

PATH = public_tokenizers.path("piece_bpe_32k.model")


def all_paths(pieces, text):
    """(score, ids) of every path through the lattice."""
    paths = {0: [(0.0, ())]}
    for e in range(1, len(text) + 1):
        paths[e] = [(p + w, ids + own) for s, w, own in pieces.edges(text, e) for p, ids in paths[s]]
    return sorted(paths[len(text)], key=lambda p: (-p[0], p[1]))


def test_unit_search_and_arrays_by_all_paths():
    pieces = N.Pieces(PATH)
    rng = random.Random(3)
    units = ["▁the", "▁hello", "▁", "▁▁x", "漢字é", "▁😀a", "abab", "\n", "▁Straße."] + ["".join(rng.choice("▁abtheno\n.é漢") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    flat, lens = pieces.compute([u.encode() for u in units])
    at = 0
    for u, k in zip(units, lens.tolist()):
        want = all_paths(pieces, u)
        got = pieces.best(u, 4)
        assert [g[0] for g in got] == [w[0] for w in want[:4]], u
        assert {g[1] for g in got} <= {w[1] for w in want}
        v = flat[at: at + k]
        at += k
        assert v[0] == want[0][0]
        assert v[1] == (want[0][0] - want[1][0] if len(want) > 1 else np.inf), u
        assert tuple(v[2:].astype(int)) in {w[1] for w in want if w[0] == want[0][0]}


def test_text_is_ranked_over_all_units(spark):
    pieces = N.Pieces(PATH)
    texts = ["the cat", "a bb", "no on", " x", "漢 é", "ab\nc"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = N.nbest(docs, PATH, n=4, with_ids=True).collect()
    for i, t in enumerate(texts):
        want = all_paths(pieces, "▁" + t.replace(" ", "▁"))
        got = sorted((r for r in rows if r.doc_id == i), key=lambda r: r["rank"])
        assert [r.score for r in got] == [w[0] for w in want[:4]], t
        for r in got:
            assert r.round_trip and (r.score, tuple(r.ids)) in [(w[0], w[1]) for w in want]


def test_round_trip_and_library_decoder(spark):
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    t = [x for x in pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["text"])["text"].to_pylist() if x][:60]
    texts = t + ["  two  blanks ", "a" * 3000, "😀\x01\t"]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(1000, None), (1001, ""), (None, "x"), (5, "again")], "doc_id long, text string")
    rows = N.nbest(docs.withColumnRenamed("doc_id", "doc_id"), PATH, with_ids=True).collect()
    assert all(r.round_trip for r in rows)
    for r in rows:
        if r.doc_id is not None and r.doc_id < len(texts) and r.doc_id != 5:
            assert model.decode(r.ids) == texts[r.doc_id]
    empty = [r for r in rows if r.doc_id in (1000, 1001)]
    assert len(empty) == 2 and all(r.n_pieces == 0 and r["rank"] == 1 for r in empty)
    for _, own in itertools.groupby(sorted(rows, key=lambda r: (r.doc_id or -1, r["rank"])), key=lambda r: r.doc_id):
        scores = [r.score for r in own]
        if len(scores) == 3:
            assert scores == sorted(scores, reverse=True)
    assert N.nbest(docs.limit(0), PATH).count() == 0


def test_model_encoding_equals_the_library(spark):
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    t = [x for x in pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["text"])["text"].to_pylist() if x]
    texts = t + ["thinking", "internationalization", "  two  blanks ", "a ", "a  ", " ", "   ", "a\u2581 b", "\u2581", "\t\n x\r\n", "😀\x01\t", "漢 é", "a" * 3000, "<s> </s>", ""]
    docs = spark.createDataFrame([*enumerate(texts), (-1, None)], "doc_id long, text string")
    rows = N.nbest(docs, PATH, with_ids=True).collect()
    assert {r.doc_id for r in rows} == {-1, *range(len(texts))}
    for r in rows:
        want = model.encode(texts[r.doc_id]) if r.doc_id >= 0 else []
        assert r.model_ids == want and r.model_pieces == len(want), texts[r.doc_id]
        assert r.model_crc32 == zlib.crc32(np.array(want, "<u4").tobytes())


def test_units_are_searched_and_texts_decoded_once(monkeypatch):
    """One search of a batch serves both caches; a path whose changed units stand for the same bytes needs no second decoding."""
    pieces = N.Pieces(PATH)
    keys, beginnings = pieces._hashes(["ab", "abc"])
    assert keys[0] == beginnings[2] == beginnings[3] and keys[1] == beginnings[4] and len(set(beginnings.tolist())) == 3
    text = b" the cat sat on the mat"
    buf = np.concatenate([np.frombuffer(text, np.uint8), np.zeros(N.PAD, np.uint8)])
    starts, ends, _ = N.unit_spans(buf, np.array([0, len(text)]))
    units = N.distinct(N.hash_spans(buf, starts, ends))
    cache = N.UnitCache(lambda found: pieces.compute([u.replace(b" ", N._BLANK) for u in found]))
    pool, off, length = cache.lookup(buf, starts, ends)
    found = N._of_text(text, pool, off, length, starts, ends, pieces, 3)
    assert [same for _, _, same in found] == [False, True, True]
    assert {pieces.decode(ids.tolist()) for _, ids, _ in found} == {text[1:].decode()}
    monkeypatch.setattr("rostrum.llm.words.hash_spans", None)
    again = cache.lookup(buf, starts, ends, units)
    assert again[1].tolist() == off.tolist() and again[2].tolist() == length.tolist()
