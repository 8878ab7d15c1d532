"""Token ids of text units by the ``tokenizers`` library, with values of repeated units kept.

A unit is a stretch of text whose tokens do not depend on what stands around it. For a byte-level vocabulary that is a run of white
space with the word behind it: its pattern always ends a match where white space begins after something else, and what follows is
matched from there alone. For a vocabulary that drops white space it is a word. Special strings hold no white space, so they lie
inside one unit.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np

from rostrum.llm.words import PAD, SPACE, UnitCache, runs

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# One word of letters that normalisation leaves alone, perhaps with one blank or line end before and marks behind: three matches
# of the patterns at most, so they can be given to the model one by one. Everything else goes through the whole library call.
PLAIN = re.compile(r"([ \n]?)([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,!?;:]*)")


def _byte_letters() -> list[str]:
    """The character that byte-level models write for each byte: itself if printable, else one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, spare = {b: chr(b) for b in shown}, 256
    for b in range(256):
        if b not in out:
            out[b] = chr(spare)
            spare += 1
    return [out[b] for b in range(256)]


class UnitEncoder:
    """``compute`` for a cache of units: ids of each unit, by the library in ``path``."""

    def __init__(self, path: str, memory: int = 150_000):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.drops_space = spec["normalizer"] is not None
        pre = spec["pre_tokenizer"]
        known = [] if self.drops_space is False and pre["type"] == "ByteLevel" else [p["type"] for p in pre.get("pretokenizers", [])]
        if spec["model"]["type"] != "BPE" or known not in ([], ["Split", "ByteLevel"]):
            raise ValueError(f"{path} splits texts in a way for which no unit is proven")
        self.letters = str.maketrans({chr(b): c for b, c in enumerate(_byte_letters())})
        self.memory, self.known = memory, {}

    def part(self, s: str) -> list[int]:
        """Ids of one match of the pattern."""
        ids = self.known.get(s)
        if ids is None:
            if len(self.known) >= self.memory:
                self.known.clear()
            mapped = s.encode().decode("latin-1").translate(self.letters)
            ids = self.known[s] = [t.id for t in self.tokenizer.model.tokenize(mapped)]
        return ids

    def compute(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        flat: list[int] = []
        lens: list[int] = []
        rest: list[tuple[int, str]] = []
        out: list[list[int] | None] = []
        for i, u in enumerate(units):
            s = u.decode("utf-8", "replace")
            m = PLAIN.fullmatch(s)
            if m is None:
                rest.append((i, s))
                out.append(None)
                continue
            gap, word, marks = m.groups()
            if self.drops_space:
                ids = self.part(word.lower())
            elif gap == "\n":
                ids = self.part("\n") + self.part(word)
            else:
                ids = self.part(gap + word)
            out.append(ids + self.part(marks) if marks else ids)
        for k in range(0, len(rest), 256):
            part = rest[k: k + 256]
            for (i, _), e in zip(part, self.tokenizer.encode_batch([s for _, s in part], add_special_tokens=False)):
                out[i] = e.ids
        for ids in out:
            flat += ids
            lens.append(len(ids))
        return np.array(flat, np.int32), np.array(lens, np.int64)


@lru_cache(maxsize=4)
def cache_of(path: str, counts_only: bool = False) -> tuple[UnitEncoder, UnitCache]:
    """One encoder and cache per worker process."""
    encoder = UnitEncoder(path)
    if not counts_only:
        return encoder, UnitCache(encoder.compute)

    def count(units):
        _, lens = encoder.compute(units)
        return lens, np.ones(len(lens), np.int64)

    return encoder, UnitCache(count)


def space_mask(buf: np.ndarray) -> np.ndarray:
    """Bytes of white space, that of longer characters included."""
    n = len(buf) - PAD
    b = buf[:n]
    mask = SPACE[b]
    lead = np.flatnonzero((b == 0xC2) | (b >= 0xE1) & (b <= 0xE3))
    if len(lead):
        x, y, z = b[lead], buf[lead + 1], buf[lead + 2]
        two = (x == 0xC2) & ((y == 0x85) | (y == 0xA0))
        three = (x == 0xE1) & (y == 0x9A) & (z == 0x80) | (x == 0xE2) & (y == 0x81) & (z == 0x9F) | (x == 0xE3) & (y == 0x80) & (z == 0x80)
        three |= (x == 0xE2) & (y == 0x80) & ((z >= 0x80) & (z <= 0x8A) | (z == 0xA8) | (z == 0xA9) | (z == 0xAF))
        for at, size in ((lead[two], 2), (lead[three], 3)):
            for k in range(size):
                mask[np.minimum(at + k, n - 1)] = True
    return mask


def spaced_units(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of white space with the word behind it, a row's trailing white space as a last unit, and each row's first unit."""
    _, ends, ptr = runs(~space_mask(buf), offsets)
    last = np.where(ptr[1:] > ptr[:-1], ends[np.maximum(ptr[1:] - 1, 0)] if len(ends) else 0, offsets[:-1])
    tail = np.flatnonzero(last < offsets[1:])
    ends = np.insert(ends, ptr[1:][tail], offsets[1:][tail])
    ptr = ptr + np.searchsorted(tail, np.arange(len(ptr)))
    starts = np.zeros(len(ends), np.int64)
    starts[1:] = ends[:-1]
    filled = np.flatnonzero(ptr[1:] > ptr[:-1])
    starts[ptr[:-1][filled]] = offsets[:-1][filled]
    return starts, ends, ptr
