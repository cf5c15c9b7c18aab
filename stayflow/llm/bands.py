"""Quality rules: counts of words, signs and repeats, and compression bands.

A text that zstandard makes much smaller than prose of its length repeats itself; one
that it hardly makes smaller is noise. Both are judged by the ratio of bytes before and
after, over the whole text and over chunks that cover all of it, against limits that depend on
the length, since short texts never compress well. The upper limits hold for one byte a
code point and grow with the bytes a code point has: scripts of two or three bytes a
letter repeat their leading bytes, which is no repetition of text.

Junk in a part of a text is found by runs: several short chunks in a row that are all noise,
or all repetitive, reject a text however long the rest is. A short chunk knows little of the
text before it, so lists of few words and tables of numbers stand out in it.

The limits of the short chunks were set on 1,888 READMEs, manuals and licenses (28.8 MB): of
18,027 chunks of 1,024 bytes a tenth of a percent lies below 1.49 and 5 percent above 1.99;
noise in 64 letters has 1.3, words drawn from 60 have 2.4, columns of numbers 2.3. The run
rule rejects none of the 545 that are prose (nine of ten signs letters or blanks), 4.3
percent of all, which are change logs, tables and lists, and no good document of the tests.

Defined cases: a very long text is worked through in runs of words and chunks; null and empty texts have no words and fail the base rules; repeated rows
each get a row; an empty table gives no rows; columns named as the results are replaced.
"""
from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import DataFrame

from stayflow.llm.terms import word_runs
from stayflow.llm.text import append_columns, filter_rows

WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
_PLAIN = bytes(32 if 9 <= b <= 13 else b for b in range(256))
FIELDS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, "
    "ratio double, chunk_low double, chunk_high double"
)


@dataclass(frozen=True)
class Bands:
    """Limits of the ratio (bytes before by bytes after), for whole texts by length and for chunks.

    ``edges`` are lengths in bytes; ``low`` and ``high`` have one limit more than there
    are edges; upper limits are multiplied by the bytes a code point. A text goes if its
    ratio is outside, or if chunks with more than ``odd_chunks`` of its bytes are. The rest
    after the full chunks is a chunk with the limits of its length. It goes as well if
    ``noisy_run`` short chunks in a row are below ``run_low`` or ``repetitive_run`` above ``run_high``.
    """

    edges: tuple[int, ...] = (128, 256, 512, 1024, 2048, 4096, 8192, 16384, 32768, 65536, 262144, 1048576)
    low: tuple[float, ...] = (0.5, 0.8, 1.0, 1.15, 1.25, 1.35, 1.45, 1.5, 1.5, 1.5, 1.5, 1.5, 1.5)
    high: tuple[float, ...] = (2.2, 2.2, 2.4, 2.7, 3.0, 3.4, 3.7, 4.0, 4.3, 4.6, 5.0, 5.5, 6.0)
    chunk_bytes: int = 4096
    chunk_low: float = 1.35
    chunk_high: float = 3.7
    odd_chunks: float = 0.3
    run_chunk: int = 1024
    run_low: float = 1.45
    run_high: float = 2.2
    noisy_run: int = 4
    repetitive_run: int = 6
    level: int = 3

    def limits(self, size: int) -> tuple[float, float]:
        i = bisect_right(self.edges, size)
        return self.low[i], self.high[i]


def point_bytes(data: bytes) -> float:
    """Bytes a code point of UTF-8; 1 for a part without any."""
    return 1.0 if data.isascii() else len(data) / max(1, int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)))


def repeated_words(ids: np.ndarray, window: int = 8) -> int:
    """Words inside windows of ``window`` words that occur at least twice; words are given as numbers, windows compared by 64-bit hashes."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    hashes = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(window):
            hashes = (hashes ^ ids[k : k + n].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            hashes ^= hashes >> np.uint64(29)
    order = np.argsort(hashes, kind="stable")
    same = hashes[order][1:] == hashes[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    edge = np.zeros(len(ids) + 1, np.int32)
    at = np.flatnonzero(twice)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return int((np.cumsum(edge) > 0).sum())


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    if not text:
        return 0, 0, 0, 0, 0
    number: dict[bytes, int] = {}
    runs = [np.fromiter((number.setdefault(w, len(number)) for w in found), np.int32, len(found)) for found in word_runs(text, _PLAIN)]
    ids = np.concatenate(runs) if runs else np.zeros(0, np.int32)
    chars = len(text) - sum(map(text.count, WHITE))
    lines = [x for x in text.split("\n") if x.strip(WHITE)]
    return len(ids), chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(ids)


class Judge:
    """One text's ratios and verdict; holds a compressor, so one for each task."""

    def __init__(self, bands: Bands):
        self.bands = bands
        self.compress = zstandard.ZstdCompressor(level=bands.level).compress

    def ratios(self, data: bytes) -> tuple[float, float, float]:
        """Of the whole text; shares of its bytes in chunks below and above their limits."""
        if not data:
            return 0.0, 0.0, 0.0
        b, below, above = self.bands, 0, 0
        whole = len(data) / len(self.compress(data))
        for i in range(0, len(data), b.chunk_bytes):
            part = data[i : i + b.chunk_bytes]
            ratio = len(part) / len(self.compress(part)) if len(part) < len(data) else whole
            low, high = (b.chunk_low, b.chunk_high) if len(part) == b.chunk_bytes else b.limits(len(part))
            below += len(part) * (ratio < low)
            above += len(part) * (ratio > high * point_bytes(part))
        return whole, below / len(data), above / len(data)

    def odd_runs(self, data: bytes) -> bool:
        """Whether so many short chunks in a row are noise, or repetitive, that this part alone rejects the text."""
        b, low, high = self.bands, 0, 0
        for i in range(0, len(data) - b.run_chunk + 1, b.run_chunk):
            part = data[i : i + b.run_chunk]
            ratio = b.run_chunk / len(self.compress(part))
            low = low + 1 if ratio < b.run_low else 0
            high = high + 1 if ratio > b.run_high * point_bytes(part) else 0
            if low >= b.noisy_run or high >= b.repetitive_run:
                return True
        return False

    def verdict(self, data: bytes, ratio: float, below: float, above: float) -> bool:
        low, high = self.bands.limits(len(data))
        if not low <= ratio <= high * point_bytes(data) or below + above > self.bands.odd_chunks:
            return False
        return not self.odd_runs(data)

    def row(self, text: str | None) -> tuple:
        counts = base_counts(text)
        failed = counts[0] < 20 or 100 * counts[4] > 30 * counts[0]
        data = (text or "").encode()
        ratios = self.ratios(data)
        return *counts, failed, not failed and self.verdict(data, *ratios), *ratios


def compression_bands(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bands: Bands = Bands()) -> DataFrame:
    """Base counts, ratios and verdict of every document."""
    names = [f.split()[0] for f in FIELDS.split(", ")]

    def make():
        judge = Judge(bands)

        def compute(texts):
            return dict(zip(names, zip(*map(judge.row, texts))))

        return compute

    return append_columns(docs, text_col, make, FIELDS, [id_col])


def keep_good(docs: DataFrame, text_col: str = "text", bands: Bands = Bands()) -> DataFrame:
    """The documents, with all their columns, that pass the base rules and the bands."""
    at = [f.split()[0] for f in FIELDS.split(", ")].index("kept")

    def make():
        judge = Judge(bands)
        return lambda texts: [judge.row(t)[at] for t in texts]

    return filter_rows(docs, text_col, make)
