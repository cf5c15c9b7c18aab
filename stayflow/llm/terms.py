"""Words of whole texts as bytes, worked through in runs of bounded length.

A text of any length is cut at spaces into runs, so the Python objects made of it at one
time stay few; only what an operator keeps of a text (hashes, counts) grows with it.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np

RUN_BYTES = 1 << 20

# Digits, small letters and all of non-ASCII make terms; capitals become small.
TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
# All but space and the five controls from tab on make words; capitals become small.
WORDS = bytes(b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b for b in range(256))


def word_runs(text: str | None, table: bytes, size: int = RUN_BYTES) -> Iterator[list[bytes]]:
    """The words of a text, in order, in lists made of about ``size`` bytes each; null has none."""
    data, start = (text or "").encode().translate(table), 0
    while start < len(data):
        end = data.find(b" ", start + size) if len(data) - start > size else -1
        end = len(data) if end < 0 else end
        found = data[start:end].split()
        if found:
            yield found
        start = end + 1


def gram_runs(text: str | None, table: bytes, words: int, size: int = RUN_BYTES) -> Iterator[list[bytes]]:
    """All runs of ``words`` consecutive words, joined by a space; a shorter text gives its words as one."""
    tail: list[bytes] = []
    whole = True
    for found in word_runs(text, table, size):
        found = tail + found
        if len(found) >= words:
            whole = False
            yield found if words == 1 else list(map(b" ".join, zip(*(found[i:] for i in range(words)))))
        tail = found[len(found) - words + 1 :] if words > 1 and len(found) >= words else found if len(found) < words else []
    if whole and tail:
        yield [b" ".join(tail)]


class Buckets(dict):
    """CRC-32 of a feature modulo a number of buckets; features met before are looked up."""

    KEPT = 1 << 18

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        place = zlib.crc32(feature) % self.buckets
        if len(self) < self.KEPT:
            self[feature] = place
        return place

    def of(self, features: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, features), np.int64, len(features))
