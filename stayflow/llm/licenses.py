"""License scans by conditional compression.

Candidate blocks are the stretches of a text in which enough word pairs of some template
follow each other, wherever they stand. A block is compressed by itself and with each
template as a raw zstandard dictionary, and the templates are ranked by the bytes they
save. In this order each is compared with the block word by word, line breaks, comment signs
and case left out; the first whose wording differs in few enough words is confirmed at all
its places in the block. Their words are taken out, the rest is ranked again, and so on until
no template is confirmed. A word that tells licenses apart (Affero, NonCommercial, a version
number and the like) never passes as a difference, however long the license. SPDX lines are
read by their grammar.

The paragraphs around words of licensing that end without a license are told as well.

Defined cases: null and empty texts have no blocks; a block longer than two of the longest
templates is worked through in overlapping pieces, so that a very long text takes time in
proportion; several licenses of a document each get a row, repeated rows too; a paragraph
without a license gets a row with null, cut ``REACH`` characters from its word of licensing
where it does not end (this cuts the text told, not what is compared); templates that save
the same go by fewer words, then by name; an empty table gives no rows; other columns are
left alone.
"""
from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator, Mapping, Sequence
from difflib import SequenceMatcher
from functools import cache
from importlib import resources

import numpy as np
import zstandard
from pyspark.sql import DataFrame, functions as F

from stayflow.llm.text import append_columns

# Common short notices of public licenses.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": "Use of this source code is governed by the BSD 2-Clause License.",
    "BSD-3-Clause": "Use of this source code is governed by the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "Dedicated to the public domain under CC0 1.0 Universal.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This work is subject to the terms of the Mozilla Public License, version 2.0.",
    "Proprietary": "All rights reserved.",
}
# The names that stand as headings and in short notices, and the usual headers of files.
_GNU = {
    "AGPL-3.0": ("Affero General", "3"), "GPL-1.0": ("General", "1"), "GPL-2.0": ("General", "2"), "GPL-3.0": ("General", "3"),
    "LGPL-2.0": ("Library General", "2"), "LGPL-2.1": ("Lesser General", "2.1"), "LGPL-3.0": ("Lesser General", "3"),
}
HEADERS = {
    "Apache-2.0": [
        "Apache License Version 2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, '
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
        "See the License for the specific language governing permissions and limitations under the License.",
    ],
    "BSD-2-Clause": ["BSD 2-Clause License", 'BSD 2-Clause "Simplified" License'],
    "BSD-3-Clause": ["BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License'],
    "CC-BY-4.0": ["Creative Commons Attribution 4.0 International"],
    "CC-BY-NC-4.0": ["Creative Commons Attribution-NonCommercial 4.0 International"],
    "CC-BY-NC-ND-4.0": ["Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International"],
    "CC-BY-NC-SA-4.0": ["Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International"],
    "CC-BY-ND-4.0": ["Creative Commons Attribution-NoDerivatives 4.0 International"],
    "CC-BY-SA-4.0": ["Creative Commons Attribution-ShareAlike 4.0 International"],
    "CC0-1.0": ["CC0 1.0 Universal"],
    "ISC": ["ISC License"],
    "MIT": ["MIT License"],
    "MPL-2.0": [
        "Mozilla Public License Version 2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. "
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ],
    **{
        name: [
            f"GNU {kind} Public License version {version}",
            f"is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} Public License as published by the "
            f"Free Software Foundation, either version {version} of the License, or (at your option) any later version.",
            f"is free software; you can redistribute it and/or modify it under the terms of the GNU {kind} Public License version {version} as published by the "
            "Free Software Foundation.",
        ]
        for name, (kind, version) in _GNU.items()
    },
}
# Words that make a paragraph a candidate.
_CUE = re.compile(r"licen[sc]|copyright|rights reserved|public domain|creative commons|\bcc0\b", re.IGNORECASE)
_WORD = re.compile(r"[^\W\d_]+|[0-9]+(?:\.[0-9]+)*")
_GAP = re.compile(r"\n[^\w\n]*(?=\n)")  # a line without a word ends a paragraph
_ID = r"[A-Za-z0-9](?:[A-Za-z0-9.+-]*[A-Za-z0-9+])?"
_SPDX = re.compile(rf"SPDX-License-Identifier:[ \t]*(\(*{_ID}(?:\)*[ \t]+(?:AND|OR|WITH)[ \t]+\(*{_ID})*)", re.IGNORECASE)
_SPDX_ID = re.compile(rf"(WITH[ \t]+)?({_ID})", re.IGNORECASE)
_VARIANT = re.compile(r"(-only|-or-later|\+)$", re.IGNORECASE)

# Words that tell one license from another; so do the numbers behind "version".
_TELLING = frozenset("affero lesser noncommercial noderivatives noderivs sharealike".split())
_BEFORE_NUMBER = frozenset("version v".split())

REACH = 1000
LEAST_SAVED = 0.3
MOST_MISSING = 0.2  # of a short template's words; of a long one's a twentieth and ten
WHOLE_WORDS = 60  # below, the numbers of a template must be there: they tell versions apart
FIELDS = "found array<struct<block:int,start:long,license:string,saved:double,missing_words:int,added_words:int,text:string>>"

Place = tuple[int, int, str, float, int, int]


@cache
def known_licenses() -> dict[str, list[str]]:
    """The short notices, the names and headers, and the whole texts in the folder ``license_texts``, by license."""
    out = defaultdict(list)
    for name, text in TEMPLATES.items():
        out[name].append(text)
    for name, texts in HEADERS.items():
        out[name].extend(texts)
    for file in sorted(resources.files("stayflow.llm").joinpath("license_texts").iterdir(), key=lambda f: f.name):
        text, name = file.read_text(encoding="utf-8"), file.name.removesuffix(".txt")
        out[name] += [text, f"All rights reserved. {text}"] if name.startswith("BSD-") else [text]  # often the end of the line above
    return dict(out)


def blocks(text: str | None) -> list[tuple[int, str]]:
    """(start, text) of candidate blocks: the paragraph around each cue, at most ``REACH`` characters to either side."""
    out, done = [], -1
    for cue in _CUE.finditer(text or ""):
        if cue.start() < done:
            continue
        low, high = max(0, done, cue.start() - REACH), min(len(text), cue.end() + REACH)
        gaps = [m.end() + 1 for m in _GAP.finditer(text, low, cue.start())]
        start = gaps[-1] if gaps and gaps[-1] <= cue.start() else low
        stop = _GAP.search(text, cue.end(), high)
        done = stop.start() if stop else high
        out.append((start, text[start:done]))
    return out


def split_words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def telling(words: Sequence[str | None], i: int) -> bool:
    """Whether the i-th word tells licenses apart."""
    word = words[i]
    if word in _TELLING:
        return True
    if word == "library":
        return i + 1 < len(words) and words[i + 1] == "general"
    return word is not None and word[0].isdigit() and i > 0 and words[i - 1] in _BEFORE_NUMBER


class Template:
    """A license's wording: words, word pairs, and how many differences pass."""

    def __init__(self, name: str, text: str, level: int):
        self.name, self.words = name, split_words(text)
        self.allowed = int(min(MOST_MISSING * len(self.words), 10 + len(self.words) / 20))
        self.pairs = Counter(zip(self.words, self.words[1:])) if len(self.words) > 1 else Counter((w,) for w in self.words)
        # A difference breaks two pairs at most.
        self.least = max(1, self.pairs.total() - 2 * self.allowed)
        self.numbers = [i for i, w in enumerate(self.words) if w[0].isdigit()] if len(self.words) < WHOLE_WORDS else []
        self.data = " ".join(self.words).encode()
        given = zstandard.ZstdCompressionDict(self.data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.given = zstandard.ZstdCompressor(level=level, write_content_size=False, dict_data=given)

    def windows(self, at: Sequence[int]) -> Iterator[tuple[int, int]]:
        """(first, last) pair positions between which the template can stand; ``at`` has the positions of its pairs."""
        far, span, begin = 2 * self.allowed + 1, len(self.words) + self.allowed, 0
        for i in range(1, len(at) + 1):
            if i < len(at) and at[i] - at[i - 1] <= far:
                continue
            if i - begin >= self.least:
                low = at[begin]
                while True:  # any place is inside one of the windows of two spans
                    a, b = bisect_left(at, low, begin, i), bisect_left(at, low + 2 * span, begin, i)
                    if b - a >= self.least:
                        yield at[a], at[b - 1]
                    if b >= i:
                        break
                    low += span
            begin = i

    def exact(self, part: Sequence[str | None]) -> Iterator[int]:
        """First words of the places without any difference, one after the other."""
        n, i = len(self.words), 0
        while True:
            try:
                i = part.index(self.words[0], i)
            except ValueError:
                return
            if part[i : i + n] == self.words:
                yield i
                i += n
            else:
                i += 1

    def align(self, part: list[str | None]) -> tuple[int, int, int, int] | None:
        """(start, stop, missing, added) of the best place in a list of words: template words that it lacks, and words that the template lacks."""
        keys = Counter(zip(part, part[1:]) if len(self.words) > 1 else ((w,) for w in part))
        if sum(min(n, keys[k]) for k, n in self.pairs.items()) < self.least:
            return None
        best, value, first = (0, 0, 0), 0, 0
        common = [m for m in SequenceMatcher(None, self.words, part, autojunk=False).get_matching_blocks() if m.size]
        for i, m in enumerate(common):
            between = part[common[i - 1].b + common[i - 1].size : m.b] if i else [None]
            value -= len(between)
            if value <= 0 or None in between:  # None: a word of a place that has its license
                value, first = 0, i
            value += m.size
            best = max(best, (value, first, i), key=lambda b: b[0])
        used = common[best[1] : best[2] + 1]
        if not used:
            return None
        same = sum(m.size for m in used)
        start, stop = used[0].b, used[-1].b + used[-1].size
        missing, added = len(self.words) - same, stop - start - same
        if missing + added > self.allowed:
            return None
        held = np.zeros(len(self.words), bool)
        for m in used:
            held[m.a : m.a + m.size] = True
        lacks = np.flatnonzero(~held).tolist()
        between = [i for m, n in zip(used, used[1:]) for i in range(m.b + m.size, n.b)]
        if any(telling(self.words, i) for i in lacks) or any(telling(part, i) for i in between) or any(not held[i] for i in self.numbers):
            return None
        return start, stop, missing, added


class Scanner:
    """Templates with their compressors; one for each task."""

    def __init__(self, templates: Mapping[str, str | Sequence[str]], level: int = 3):
        texts = {name: [t] if isinstance(t, str) else list(t) for name, t in templates.items()}
        self.level = level
        self.alone = zstandard.ZstdCompressor(level=level, write_content_size=False)
        self.frame = len(self.alone.compress(b""))  # bytes that no template can save
        self.templates = [t for name in sorted(texts) for text in texts[name] if (t := Template(name, text, level)).words]
        self.sizes = [len(self.alone.compress(t.data)) for t in self.templates]
        # long, middling and short templates, each with the words of its longest place: a block is of the size of its templates
        self.kinds = []
        for low, high in ((1000, 1 << 30), (100, 1000), (0, 100)):
            members = {k for k, t in enumerate(self.templates) if low <= len(t.words) < high}
            if members:
                self.kinds.append((members, max(len(self.templates[k].words) + self.templates[k].allowed for k in members)))
        self.spelled = {name.lower(): name for name in texts}
        # word pairs as numbers, and for each the templates that hold it
        self.number = {w: i for i, w in enumerate(sorted({w for t in self.templates for w in t.words}))}
        held = defaultdict(list)
        for k, t in enumerate(self.templates):
            for pair in t.pairs:
                held[self._code(*pair)].append(k)
        self.codes = np.array(sorted(held), np.int64)
        self.of = [np.array(held[c]) for c in self.codes.tolist()]
        self.least = np.array([t.least for t in self.templates])

    def _code(self, first: str, second: str | None = None) -> int:
        size = len(self.number) + 1
        return self.number[first] * size + (self.number[second] if second is not None else size - 1)

    def gain(self, data: bytes, size: int, k: int) -> float:
        """Share of the compressed size that a template saves; only as much text as the template has can be saved."""
        return (size - len(self.templates[k].given.compress(data))) / max(1, min(size, self.sizes[k]) - self.frame)

    def saved(self, block: str) -> list[tuple[float, str]]:
        """(share of the compressed size saved, license) of every template, best first."""
        data = " ".join(split_words(block)).encode()
        size = len(self.alone.compress(data))
        return sorted(((self.gain(data, size, k), t.name) for k, t in enumerate(self.templates)), key=lambda g: (-g[0], g[1]))

    def rank(self, words: Sequence[str | None]) -> list[int]:
        """The templates by the bytes each saves of the words that are left, most first; those that save none left out."""
        data = " ".join(w for w in words if w is not None).encode()
        size = len(self.alone.compress(data))
        less = [(len(t.given.compress(data)) - size, len(t.words), k) for k, t in enumerate(self.templates)]
        return [k for saved, _, k in sorted(less) if saved < 0]

    def hits(self, words: Sequence[str | None]) -> dict[int, list[int]]:
        """For each template that can stand somewhere: the positions of its word pairs."""
        if not len(self.codes) or not words:
            return {}
        size = len(self.number) + 1
        ids = np.fromiter((self.number.get(w, -1) for w in words), np.int64, len(words))
        found: dict[int, list[int]] = {}
        for code, known in ((ids[:-1] * size + ids[1:], (ids[:-1] >= 0) & (ids[1:] >= 0)), (ids * size + size - 1, ids >= 0)):
            at = np.flatnonzero(known)
            place = np.searchsorted(self.codes, code[at])
            place[place == len(self.codes)] = 0
            same = self.codes[place] == code[at]
            at, place = at[same], place[same]
            if not len(at):
                continue
            owners = [self.of[p] for p in place.tolist()]
            owner, position = np.concatenate(owners), np.repeat(at, [len(o) for o in owners])
            counts = np.bincount(owner, minlength=len(self.templates))
            for k in np.flatnonzero(counts >= self.least).tolist():
                found.setdefault(k, []).extend(position[owner == k].tolist())
        return found

    def stretches(self, words: Sequence[str | None], members: set[int]) -> list[tuple[int, int]]:
        """(first, behind the last) of the candidate blocks: where word pairs of one of the templates are close enough together."""
        found = []
        for k, positions in self.hits(words).items():
            if k in members:
                t = self.templates[k]
                found += [(max(0, first - t.allowed - 1), min(len(words), last + t.allowed + 3)) for first, last in t.windows(sorted(positions))]
        out: list[tuple[int, int]] = []
        for low, high in sorted(found):
            if out and low <= out[-1][1]:
                out[-1] = out[-1][0], max(out[-1][1], high)
            else:
                out.append((low, high))
        return out

    def settle(self, words: list[str | None], low: int, high: int, upto: int) -> Iterator[tuple[int, int, int, int, int, float]]:
        """(start, stop, template, missing, added, gain) of the licenses of one block that start before ``upto``; their words are taken out of ``words``."""
        tried: set[int] = set()
        while any(w is not None for w in words[low:high]):
            for k in self.rank(words[low:high]):
                if k in tried:
                    continue
                tried.add(k)
                placed = list(self._places(words, low, high, upto, k))
                if placed:
                    yield from placed
                    break  # the rest is ranked anew
            else:
                return

    def _places(self, words: list[str | None], low: int, high: int, upto: int, k: int) -> Iterator[tuple[int, int, int, int, int, float]]:
        """All places in a piece where a template's wording is confirmed."""
        t = self.templates[k]
        for i in list(t.exact(words[low:high])):
            start, stop = low + i, low + i + len(t.words)
            if start < upto:
                words[start:stop] = [None] * (stop - start)
                yield start, stop, k, 0, 0, self.gain(t.data, self.sizes[k], k)
        if not t.allowed:
            return
        part = words[low:high]
        keys = zip(part, part[1:]) if len(t.words) > 1 else ((w,) for w in part)
        at = [i for i, key in enumerate(keys) if key in t.pairs]
        for first, last in t.windows(at):
            a, z = low + max(0, first - t.allowed - 1), min(high, low + last + t.allowed + 3)
            rest = words[a:z]
            while place := t.align(rest):
                start, stop = a + place[0], a + place[1]
                rest[place[0] : place[1]] = [None] * (stop - start)
                if start >= upto or None in words[start:stop]:
                    continue
                data = " ".join(words[start:stop]).encode()
                gain = self.gain(data, len(self.alone.compress(data)), k)
                if gain >= LEAST_SAVED:
                    words[start:stop] = [None] * (stop - start)
                    yield start, stop, k, *place[2:], gain

    def spdx(self, text: str) -> Iterator[Place]:
        """The licenses of SPDX lines; those in the table by its names, the others as written."""
        for line in _SPDX.finditer(text):
            start = line.start()
            for m in _SPDX_ID.finditer(line.group(1)):
                if m.group(1) or m.group(2).upper() in ("AND", "OR"):
                    continue
                name, stop = m.group(2), line.start(1) + m.end()
                template = Template(name, f"SPDX-License-Identifier: {name}", self.level)
                size = len(self.alone.compress(template.data))
                yield start, stop, self.spelled.get(name.lower()) or self.spelled.get(_VARIANT.sub("", name).lower(), name), (size - len(template.given.compress(template.data))) / (size - self.frame), 0, 0
                start = stop

    def places(self, text: str) -> list[Place]:
        """(start, stop, license, share saved, missing words, added words) of every license, in the order of the text."""
        out = list(self.spdx(text))
        small = text.lower()
        if not self.hits(split_words(text)):
            return sorted(out)
        at = [m.span() for m in _WORD.finditer(small if len(small) == len(text) else text)]  # a few capitals have longer small forms
        words: list[str | None] = [text[a:b].lower() for a, b in at]
        for start, stop, *_ in out:
            low, high = bisect_left(at, (start,)), bisect_left(at, (stop,))
            words[low:high] = [None] * (high - low)
        for members, longest in self.kinds:
            for low, high in self.stretches(words, members):
                # a place of these templates that starts in the first half of a piece lies inside it
                for a in range(low, max(low + 1, high - longest), longest):
                    last = a + 2 * longest >= high
                    for start, stop, k, missing, added, gain in self.settle(words, a, min(high, a + 2 * longest), high if last else a + longest):
                        out.append((at[start][0], at[stop - 1][1], self.templates[k].name, gain, missing, added))
        return sorted(out)

    def name(self, block: str) -> tuple[str | None, float, int, int]:
        """License, share saved, missing and added words of the place of a block with the fewest differences."""
        found = self.places(block)
        if not found:
            ranked = self.saved(block)
            return None, ranked[0][0] if ranked else 0.0, 0, 0
        return min(found, key=lambda p: (p[4] + p[5], -p[3], p[2]))[2:]

    def rows(self, text: str | None) -> list[dict]:
        """The licenses of a text, and its paragraphs about licensing in which there is none."""
        if not text:
            return []
        found = self.places(text)
        out = [(start, *rest, text[start:stop]) for start, stop, *rest in found]
        starts, far = [p[0] for p in found], 0
        reached = [far := max(far, p[1]) for p in found]  # the furthest end up to each place
        for start, block in blocks(text):
            i = bisect_left(starts, start + len(block))
            if not i or reached[i - 1] <= start:
                ranked = self.saved(block)
                out.append((start, None, ranked[0][0] if ranked else 0.0, 0, 0, block))
        names = ("start", "license", "saved", "missing_words", "added_words", "text")
        return [{"block": i, **dict(zip(names, row))} for i, row in enumerate(sorted(out, key=lambda r: r[0]))]


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: Mapping[str, str | Sequence[str]] | None = None) -> DataFrame:
    """(id, block, start, license, saved, missing_words, added_words, text) of every license and of every candidate block without one (license is null)."""
    known = dict(known_licenses() if templates is None else templates)

    def make():
        scanner = Scanner(known)
        return lambda texts: {"found": [scanner.rows(text) for text in texts]}

    found = append_columns(docs, text_col, make, FIELDS, [id_col])
    return found.select(id_col, F.explode("found").alias("found")).select(id_col, "found.*")
