"""License scan: winnowed fingerprints pick candidates, banded alignment measures them.

Templates are cut into three-word shingles; winnowing keeps the smallest hash
of every three neighbours, and an inverted index maps it to its template and place.  Every
shingle of a text is looked up, so any run of five template words that a text
shares (three of a template of up to ten words) finds an entry.  Entries on neighbouring
diagonals make one candidate, which is aligned to the template within a band
around its diagonal.  What covers enough of a template, with the same words that tell licenses
apart, is reported with the span of the text; of overlapping reports the one with the most words matched stays.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Callable, Mapping, Sequence
from functools import partial
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame

from tidemark.llm import ngrams
from tidemark.llm.common import from_texts

#: License notices and short licenses as their owners publish them: fixed values.
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met")
_BSD_TWO = (f"{_BSD}: 1. Redistributions of source code must retain the above copyright notice, this list of conditions "
            "and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
            "this list of conditions and the following disclaimer in the documentation and/or other materials provided "
            "with the distribution.")
_BSD_THIRD = (" 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
              "promote products derived from this software without specific prior written permission.")
_BSD_END = (" THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
            "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
            "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
            "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
            "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
            "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
            "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
            "POSSIBILITY OF SUCH DAMAGE.")
_MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.")
_MIT_END = (" THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
            "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
            "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER "
            "IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE "
            "USE OR OTHER DEALINGS IN THE SOFTWARE.")
_ISC = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.")
_ISC_END = (" THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
            "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
            "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF "
            "USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF "
            "OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.")
_UNLICENSE = ("This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
              "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
              "binary, for any purpose, commercial or non-commercial, and by any means.")
_GNU = ("This {thing} is free software{mark} you can redistribute it and/or modify it under the terms of the GNU {name} as "
        "published by the Free Software Foundation")
_LATER = ", either version {} of the License, or (at your option) any later version."
_GNU_NAMES = {"GPL": ("program", "General Public License", ("2.0", "3.0")),
              "LGPL": ("library", "Lesser General Public License", ("2.1", "3.0")),
              "AGPL": ("program", "Affero General Public License", ("3.0",))}


def _families() -> dict[str, str]:
    """Notices of licenses that come in versions and kinds."""
    out = {}
    for short, (thing, name, versions) in _GNU_NAMES.items():
        for v in versions:
            plain = v.removesuffix(".0")
            out[f"{short}-{v}"] = f"This work is licensed under the GNU {name}, version {plain}."
            out[f"{short}-{v}-notice"] = _GNU.format(thing=thing, mark=":", name=name) + _LATER.format(plain)
    for kind in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"):
        for v in ("2.0", "2.5", "3.0", "4.0"):
            out[f"CC-{kind}-{v}"] = f"Licensed under CC {kind} {v}."
    return out


TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-notice": _MIT,
    "MIT-text": _MIT + _MIT_END,
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                         "except in compliance with the License. You may obtain a copy of the License at",
    "LGPL-notice": _GNU.format(thing="library", mark=";", name="Lesser General Public License"),
    "BSD-notice": _BSD,
    "BSD-2-Clause-text": _BSD_TWO + _BSD_END,
    "BSD-3-Clause-text": _BSD_TWO + _BSD_THIRD + _BSD_END,
    "ISC-notice": _ISC,
    "ISC-text": _ISC + _ISC_END,
    "MPL-1.1": "Licensed under the Mozilla Public License, version 1.1.",
    "MPL-2.0": "Licensed under the Mozilla Public License, version 2.0.",
    "MPL-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "EPL-1.0": "Licensed under the Eclipse Public License, version 1.0.",
    "EPL-2.0": "Licensed under the Eclipse Public License, version 2.0.",
    "Unlicense": _UNLICENSE,
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring "
               "rights to this work.",
    "all-rights-reserved": "All rights reserved.",
    **_families(),
}
#: Words that tell licenses apart, and words behind which a number is a version: fixed values.
TELLING = {"mit", "apache", "bsd", "isc", "gnu", "lesser", "affero", "mozilla", "eclipse", "cc", "neither", "reserved"}
KINDS = {"by", "by-sa", "by-nc", "by-nd", "by-nc-sa", "by-nc-nd"}  # behind cc
BEFORE_VERSION = {"version", "v", "license", "licence"} | KINDS
_NUMBER = re.compile(r"v?(\d+(?:\.\d+)*)")
SHINGLE, WINDOW = 3, 3
#: Share of a template's words that must be matched, besides all that tell licenses apart.
COVERAGE = 0.8
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SLOTS = 20


def _core(word: str) -> str:
    """The word in lower case without marks around; a version without ``v`` and a last ``.0``."""
    core = word.lower().strip(ngrams.MARKS)
    number = _NUMBER.fullmatch(core)
    return number[1].removesuffix(".0") if number else core


def _hash(word: str) -> int:
    return crc32(_core(word).encode())


def telling(words: Sequence[str], first: int = 0) -> list[str]:
    """The words from ``first`` on that tell licenses apart: names, kinds and versions, in their order."""
    cores = [_core(w) for w in words]

    def tells(i: int) -> bool:
        core, before = cores[i], cores[i - 1] if i else ""
        return core in TELLING or (core in KINDS and before == "cc") or (
            before in BEFORE_VERSION and _NUMBER.fullmatch(core) is not None)

    return [cores[i] for i in range(first, len(cores)) if tells(i)]


class Index:
    """Winnowed shingles of the templates."""

    def __init__(self, templates: Mapping[str, str]):
        self.telling = {name: telling(ngrams.words_of(text)) for name, text in templates.items()}
        self.words = {name: [_hash(w) for w in ngrams.words_of(text)] for name, text in templates.items()}
        if any(len(w) < SHINGLE for w in self.words.values()):
            raise ValueError(f"a template needs {SHINGLE} words")
        self.entries: dict[int, list[tuple[str, int]]] = defaultdict(list)
        for name, words in self.words.items():
            shingles = shingle_hashes(np.array(words, dtype=np.uint32)).tolist()
            window = max(1, min(WINDOW, len(shingles) // WINDOW))  # a short template keeps every shingle
            picked = {min(range(i, i + window), key=lambda j: (shingles[j], -j))
                      for i in range(len(shingles) - window + 1)}
            for j in sorted(picked):
                self.entries[shingles[j]].append((name, j))
        self.maybe = np.zeros(1 << _SLOTS, dtype=bool)
        self.maybe[np.array(list(self.entries), dtype=np.uint32) >> np.uint32(32 - _SLOTS)] = True


def shingle_hashes(words: np.ndarray) -> np.ndarray:
    """32-bit hashes of the shingles of a sequence of word hashes."""
    size = words.size - SHINGLE + 1
    if size <= 0:
        return np.zeros(0, dtype=np.uint32)
    with np.errstate(over="ignore"):
        h = np.zeros(size, dtype=np.uint32)
        for i in range(SHINGLE):
            h = (h ^ words[i:i + size]) * np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(16)
    return h


def align(template: Sequence[int], words: Sequence[int], diagonal: int, band: int) -> tuple[int, int, int]:
    """Matched words, first word and end of the best local alignment within ``band`` of the diagonal.

    A matched word scores 2; a word changed, left out or put in costs 1.
    """
    width, nothing = 2 * band + 1, (0, 0, -1)
    above, best, found = [nothing] * width, (0, 0), (0, 0, 0)
    for r, word in enumerate(template):
        row: list[tuple[int, int, int]] = []
        for c in range(width):
            at = diagonal + r + c - band
            if at < 0 or at >= len(words):
                row.append(nothing)
                continue
            same = word == words[at]
            s, m, first = above[c]
            here = (s + 2, m + 1, at if first < 0 else first) if same else (s - 1, m, first)
            if c + 1 < width and above[c + 1][0] - 1 > here[0]:
                here = (above[c + 1][0] - 1, *above[c + 1][1:])
            if c and row[c - 1][0] - 1 > here[0]:
                here = (row[c - 1][0] - 1, *row[c - 1][1:])
            if here[0] <= 0:
                here = nothing
            row.append(here)
            if (here[0], here[1]) > best:
                best, found = (here[0], here[1]), (here[1], here[2], at + 1)
        above = row
    return found


def scan(index: Index, text: str) -> list[dict]:
    """Reports of one whole text: ``license, coverage, matched, start, end`` (characters), in text order."""
    spans = [m.span() for m in _WORD.finditer(text)]
    words = [_hash(text[a:b]) for a, b in spans]
    diagonals: dict[str, list[int]] = defaultdict(list)
    for i, h in enumerate(shingle_hashes(np.array(words, dtype=np.uint32)).tolist()):
        for name, j in index.entries.get(h, ()):
            diagonals[name].append(i - j)
    found = []
    for name, offsets in diagonals.items():
        template = index.words[name]
        band, done = max(2, len(template) // 8), None
        for d in sorted(set(offsets)):
            if done is not None and d - done <= band:
                continue  # within the band of the candidate before
            done = d
            matched, first, end = align(template, words, d, band)
            if matched >= COVERAGE * len(template) \
                    and telling([text[x:y] for x, y in spans[max(0, first - 1):end]], min(first, 1)) \
                    == index.telling[name]:
                found.append((-matched, first, end, name, matched / len(template)))
    taken: list[tuple[int, int]] = []
    kept = []
    for less, first, end, name, coverage in sorted(found):
        at = bisect_left(taken, (first, end))
        if (at and taken[at - 1][1] > first) or (at < len(taken) and taken[at][0] < end):
            continue
        taken.insert(at, (first, end))
        kept.append({"license": name, "coverage": coverage, "matched": -less,
                     "start": spans[first][0], "end": spans[end - 1][1]})
    return sorted(kept, key=lambda r: r["start"])


def _scanned(templates: Mapping[str, str]) -> Callable[[list[str]], list[list]]:
    index, kept = Index(templates), {}

    def hashed(word: str) -> int:
        if len(kept) >= ngrams.KEPT_WORDS:
            kept.clear()
        found = _hash(word)
        if len(word) <= 64:
            kept[word] = found
        return found

    def run(texts: list[str]) -> list[list]:
        reports = []
        for text in texts:
            get = kept.get
            words = [hashed(w) if (h := get(w)) is None else h for w in ngrams.words_of(text)]
            shingles = shingle_hashes(np.array(words, dtype=np.uint32))
            hit = index.maybe[shingles >> np.uint32(32 - _SLOTS)].any()  # most texts share no shingle
            reports.append(scan(index, text) if hit else [])
        return [reports]

    return run


def scan_licenses(docs: DataFrame, keep: Sequence[str], templates: Mapping[str, str] = TEMPLATES,
                  text: str = "text") -> DataFrame:
    """The columns ``keep`` and ``licenses``, an array of the reports of the whole text.

    A report has the template's name, the share of its words that is matched,
    their number, and the span in characters.  A share of 0.8 must be matched, and the
    words of the span that tell licenses apart (names, kinds such as Lesser or NC, versions)
    must be those of the template, no more and no less.  Null and empty texts
    have an empty array.  Rows are independent of each other.
    """
    kind = "array<struct<license:string,coverage:double,matched:int,start:int,end:int>>"
    return from_texts(docs, text, keep, {"licenses": kind}, partial(_scanned, dict(templates)))
