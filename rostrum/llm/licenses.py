"""Operator 10: license notices by conditional compression.

Stretches of text around license words are candidate blocks; they run over line ends, so that a wrapped notice is in one block. Every block is
compressed alone and with each template as a raw zstandard dictionary, and the templates are ranked by the bytes that they save. The winners are
confirmed in that order by the exact differences in wording: a place without a differing word is an exact notice, a few that do not change the meaning make
a variant, and any number, name or negation that differs rejects it. The words of confirmed notices leave the block, which is then
compressed anew, until no template is confirmed any more.
"""

from __future__ import annotations

import difflib
import re
from collections.abc import Mapping
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from rostrum.llm.fixed import binary_text, bounded_batches
from rostrum.llm.words import texts_of

# The wording of common public license notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "Released under CC0 1.0, dedicated to the public domain.",
    "AGPL-3.0": "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, "
                "or (at your option) any later version",
    "Apache-2.0-header": "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
                         "http://www.apache.org/licenses/LICENSE-2.0",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0-header": "it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, "
                      "or (at your option) any later version",
    "GPL-3.0-header": "it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, "
                      "or (at your option) any later version",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
           "provided that the above copyright notice and this permission notice appear in all copies",
    "LGPL-2.1": "modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, "
                "or (at your option) any later version",
    "LGPL-3.0": "it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, "
                "or (at your option) any later version",
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, "
                "to deal in the Software without restriction",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "reserved": "All rights reserved.",
}
RESTRICTED = frozenset({"AGPL-3.0", "CC-BY-NC-4.0", "GPL-2.0", "GPL-2.0-header", "GPL-3.0", "GPL-3.0-header", "LGPL-2.1", "LGPL-3.0", "reserved"})
# Words of a trigger may stand on two lines, with marks of a comment between them.
TRIGGER = re.compile(rb"licen[cs]|copyright|rights reserved|permission is hereby|redistribution and use|public domain|hereby granted|creative commons|released under"
                     .replace(b" ", rb"[^a-z0-9\x80-\xff]{1,40}"))
WORD = re.compile(rb"[a-z0-9]+(?:[.-][a-z0-9]+)*|[\x80-\xff]+")
DECISIVE = frozenset({b"not", b"no", b"non", b"without", b"only", b"except", b"public", b"general", b"lesser", b"affero", b"mozilla", b"mit", b"apache", b"gnu", b"cc", b"bsd", b"all"})


def words(text: bytes) -> list[bytes]:
    return WORD.findall(text.lower())


def decisive(word: bytes) -> bool:
    """A word that tells licenses apart: a number, a part such as by-nc, or a listed one."""
    return word in DECISIVE or b"-" in word or any(48 <= c <= 57 for c in word)


class Scanner:
    """Finds notices in texts; templates and limits are parameters."""

    def __init__(self, templates: Mapping[str, str] = TEMPLATES, max_changed: float = 0.1, least_saving: int = 4):
        import zstandard
        self.names = sorted(templates)
        self.words = {n: words(templates[n].encode()) for n in self.names}
        self.reach = 2 * max(len(t.encode()) for t in templates.values())
        self.plain = zstandard.ZstdCompressor(level=3, write_content_size=False)
        self.given = {n: zstandard.ZstdCompressor(level=3, write_content_size=False, dict_data=zstandard.ZstdCompressionDict(
            b" ".join(self.words[n]), dict_type=zstandard.DICT_TYPE_RAWCONTENT)) for n in self.names}
        self.most = {n: int(max_changed * len(self.words[n])) for n in self.names}
        self.least_saving = least_saving
        self.seeds = {n: self._seeds(self.words[n], self.most[n]) for n in self.names}
        self.overlap = max(len(self.words[n]) + 2 * self.most[n] for n in self.names) + 1
        self.window = 8 * self.overlap
        self.judged = lru_cache(maxsize=20_000)(self.judge)

    @staticmethod
    def _seeds(template: list[bytes], most: int) -> dict[bytes, list[int]]:
        """Runs of words and their places. A place that differs in ``most`` words has one of them whole, as the words fall into ``most`` + 1 runs."""
        size = max(1, -(-(len(template) - most) // (most + 1)))
        out: dict[bytes, list[int]] = {}
        for i in range(len(template) - size + 1):
            out.setdefault(b" %s " % b" ".join(template[i: i + size]), []).append(i)
        return out

    def blocks(self, text: bytes) -> list[bytes]:
        """Stretches around license words, within reach of the longest template on both sides, that do not cut a word."""
        out: list[list[int]] = []
        for m in TRIGGER.finditer(text.lower()):
            a, b = max(0, m.start() - self.reach), min(len(text), m.end() + self.reach)
            if out and a <= out[-1][1]:
                out[-1][1] = b
            else:
                out.append([a, b])
        return [self._whole(text, a, b) for a, b in out]

    def _whole(self, text: bytes, a: int, b: int) -> bytes:
        """text[a:b] without the words that the borders cut, if a word of common length is cut."""
        if a > 0 and not text[a - 1: a].isspace():
            cut = re.search(rb"\s", text[a: a + 64])
            a += cut.start() if cut else 0
        if b < len(text) and not text[b: b + 1].isspace():
            cut = re.search(rb"\s\S*\Z", text[max(a, b - 64): b])
            b = max(a, b - 64) + cut.start() if cut else b
        return text[a:b]

    def saved(self, name: str, data: bytes, alone: int) -> int:
        """Bytes that a template saves of ``alone`` compressed ones."""
        return alone - len(self.given[name].compress(data))

    def ranked(self, block: list[bytes]) -> list[tuple[int, str]]:
        """(saved bytes, template), the largest reduction first. All are ranked, as a short notice may save little in a long block that repeats it."""
        data = b" ".join(w for w in block if w)
        alone = len(self.plain.compress(data))
        return sorted(((self.saved(n, data, alone), n) for n in self.names), key=lambda r: (-r[0], r[1]))

    def saving(self, name: str, place: list[bytes]) -> int:
        """Thousandths of the compressed bytes of a place that its template saves; 0 below ``least_saving`` bytes."""
        data = b" ".join(place)
        alone = len(self.plain.compress(data))
        saved = self.saved(name, data, alone)
        return round(1000 * saved / alone) if saved >= self.least_saving else 0

    def judge(self, text: bytes) -> tuple[tuple[str, int, int], ...]:
        """(template, differing words, saving in thousandths) of the notices in a block, in its order.

        A long block is judged in overlapping windows. A notice that may go on behind its window is left to the next one, which holds it whole.
        """
        block = words(text)
        found: list[tuple[int, str, int, int]] = []
        for start in range(0, max(1, len(block) - self.overlap), self.window - self.overlap):
            end = start + self.window
            for a, name, changed, saving in self._notices(block, start, min(end, len(block)), max(self.most.values()) if end < len(block) else 0):
                found.append((a, name, changed, saving))
        return tuple(f[1:] for f in sorted(found))

    def _notices(self, block: list[bytes], start: int, end: int, rest: int) -> list[tuple[int, str, int, int]]:
        """Notices that end ``rest`` words before the end of a window or earlier; their words are emptied in the block."""
        found = []
        while True:  # the notices of one template are taken out per round
            part = block[start:end]
            for _, name in self.ranked(part) if any(part) else ():
                places = self._apart(part, [p for p in self.places(name, part) if start + p[2] <= end - rest])
                taken = [(c, a, b, s) for c, a, b in places if (s := self.saving(name, part[a:b]))]
                if taken:
                    break
            else:
                return found
            for changed, a, b, saving in taken:
                found.append((start + a, name, changed, saving))
                block[start + a: start + b] = [b""] * (b - a)

    @staticmethod
    def _apart(part: list[bytes], places: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """Places that do not overlap, those with the fewest differing words first."""
        used, out = [not w for w in part], []
        for changed, a, b in places:
            if not any(used[a:b]):
                used[a:b] = [True] * (b - a)
                out.append((changed, a, b))
        return out

    def places(self, name: str, block: list[bytes]) -> list[tuple[int, int, int]]:
        """(differing words, start, end) of the places in the block that differ little from the template and in no decisive word."""
        joined = b" %s " % b" ".join(block)
        template, most = self.words[name], self.most[name]
        starts: set[int] = set()
        for seed, at in self.seeds[name].items():
            k = joined.find(seed)
            while k >= 0:
                place = joined.count(b" ", 0, k)
                starts |= {place - i for i in at}
                k = joined.find(seed, k + 1)
        return sorted({hit for d in starts if (hit := self.confirm(template, block, d, most))})

    @staticmethod
    def confirm(template: list[bytes], block: list[bytes], at: int, most: int) -> tuple[int, int, int] | None:
        """(differing words, start, end) of the template around one place, if it differs little and in no decisive word."""
        if at >= 0 and block[at: at + len(template)] == template:
            return 0, at, at + len(template)
        if not most:
            return None
        low, high = max(0, at - most), max(0, min(len(block), at + len(template) + most))
        match = difflib.SequenceMatcher(None, template, block[low:high], autojunk=False).get_matching_blocks()[:-1]
        if not match:
            return None
        a, b = low + match[0].b, low + match[-1].b + match[-1].size
        a, b = max(low, a - match[0].a), min(high, b + len(template) - match[-1].a - match[-1].size)
        changed: list[bytes] = []
        count = 0
        for tag, i, j, k, m in difflib.SequenceMatcher(None, template, block[a:b], autojunk=False).get_opcodes():
            if tag != "equal":
                changed += template[i:j] + block[a + k: a + m]
                count += max(j - i, m - k)
        if count > most or any(not w or decisive(w) for w in changed):
            return None
        return count, a, b

    def scan(self, text: bytes) -> tuple[int, list[tuple[str, int, int]]]:
        found = self.blocks(text)
        return len(found), [n for b in found for n in (self.judged if len(b) <= 8 * self.reach else self.judge)(b)]


HIT = pa.struct([("license", pa.string()), ("changed", pa.int32()), ("saving", pa.int32())])


def license_scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates: Mapping[str, str] = TEMPLATES, max_changed: float = 0.1,
                 restricted: frozenset[str] = RESTRICTED) -> DataFrame:
    """(doc_id, n_blocks, notices, restricted) per row; notices are structs of license, differing words and saving, in the text's order.

    The saving is that of the notice's own words, in thousandths of their compressed bytes. Null and empty texts have no block; very long ones are read whole. Rows that repeat are scanned each. Rows are scanned where they lie, without a shuffle.
    """
    bounded_batches(docs.sparkSession)
    own: dict[str, Scanner] = {}

    def kernel(batches):
        if not own:
            own["scanner"] = Scanner(templates, max_changed)
        scanner = own["scanner"]
        for batch in batches:
            buf, offsets = texts_of(batch)
            data = buf.tobytes()
            found = [scanner.scan(data[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            hits = [[{"license": n, "changed": c, "saving": s} for n, c, s in f[1]] for f in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([f[0] for f in found], pa.int64()), pa.array(hits, pa.list_(HIT)),
                 pa.array([any(n in restricted for n, _, _ in f[1]) for f in found], pa.bool_())], names=["doc_id", "n_blocks", "notices", "restricted"])

    return binary_text(docs, doc_id, text).mapInArrow(
        kernel, "doc_id long, n_blocks long, notices array<struct<license:string,changed:int,saving:int>>, restricted boolean")
