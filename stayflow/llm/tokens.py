"""Token ids of whole texts with a public tokenizer file.

The tokenizer drops white space and never merges across it, so a text's ids are its
white-space separated chunks' ids joined. A worker process keeps the ids of chunks it has
met in a table of bounded size. Of a new chunk of plain Latin letters, digits and ASCII signs,
for which the tokenizer's normal form is the lower case, each piece goes to the
tokenizer's merge model once; any other new chunk passes through the whole tokenizer.
"""
from __future__ import annotations

import os
import re
import struct
from functools import lru_cache

import numpy as np

TOKENIZER = "word_bpe_49k.json"
CHUNKS_KEPT, PIECES_KEPT = 150_000, 250_000  # of each of two generations
JOINED_BYTES = 64 << 10
LONGEST_KEPT = 64

# The tokenizer file's piece pattern over plain Latin text.
_LETTERS = "a-zÀ-ÖØ-öø-įıĲ-ſ"
_PLAIN = re.compile("[!-~À-ÖØ-öø-įıĲ-ſ]+").fullmatch
_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^{_LETTERS}0-9]+").findall


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, int]:
    """Byte-level letters: printable bytes stand for themselves, the others are numbered from 256."""
    same = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = [b for b in range(256) if b not in same]
    return {b: 256 + i for i, b in enumerate(other)}


class ChunkEncoder:
    """Texts to little-endian unsigned 32-bit ids, as bytes. ``path=None``: the default file."""

    def __init__(self, path: str | None = None, chunks_kept: int = CHUNKS_KEPT, pieces_kept: int = PIECES_KEPT):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path or tokenizer_path())
        self.chunks: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.pieces = _Pieces(self.tokenizer.model, pieces_kept)
        self.kept = chunks_kept

    def _whole(self, chunks: list[bytes], into: dict[bytes, bytes]) -> None:
        """Through the whole tokenizer, many at once; offsets tell whose an id is."""
        text = b" ".join(chunks).decode()
        encoded = self.tokenizer.encode(text, add_special_tokens=False)
        ids = np.array(encoded.ids, dtype="<u4")
        starts = np.array([a for a, _ in encoded.offsets], dtype=np.int64)
        widths = np.array([len(c.decode()) + 1 for c in chunks], dtype=np.int64)
        cuts = np.searchsorted(starts, np.cumsum(widths)).tolist()
        raw, before = ids.tobytes(), 0
        for chunk, cut in zip(chunks, cuts):
            into[chunk] = raw[4 * before : 4 * cut]
            before = cut

    def _learn(self, missing: set[bytes]) -> dict[bytes, bytes]:
        found: dict[bytes, bytes] = {}
        odd, size = [], 0
        piece = self.pieces.__getitem__
        older = self.older.get
        for chunk in missing:
            if (ids := older(chunk)) is not None:
                found[chunk] = ids
                continue
            text = chunk.decode()
            if len(chunk) <= LONGEST_KEPT and _PLAIN(text) and "<|" not in text:
                found[chunk] = b"".join(map(piece, _PIECES(text.lower())))
                continue
            odd.append(chunk)
            size += len(chunk) + 1
            if size >= JOINED_BYTES:
                self._whole(odd, found)
                odd, size = [], 0
        if odd:
            self._whole(odd, found)
        self.pieces.trim()
        return found

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text; none for null."""
        known = self.chunks
        split = [(t or "").encode().split() for t in texts]
        missing = {c for chunks in split for c in chunks if c not in known}
        known.update(self._learn(missing))
        out = [b"".join(map(known.__getitem__, chunks)) for chunks in split]
        for chunk in missing:
            if len(chunk) > LONGEST_KEPT:
                del known[chunk]
        if len(known) > self.kept:
            self.older, self.chunks = known, {}
        return out


@lru_cache(maxsize=1)
def encoder(path: str | None = None) -> ChunkEncoder:
    """One encoder for each worker process, so that a task finds what earlier ones have met."""
    return ChunkEncoder(path)


class _Pieces(dict):
    """Ids of lower-case pieces, from the tokenizer's merge model when a piece is new."""

    def __init__(self, model, kept: int):
        super().__init__()
        self.model, self.kept, self.letters = model, kept, _byte_letters()
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            spelled = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
            found = [t.id for t in self.model.tokenize(spelled)]
            ids = struct.pack(f"<{len(found)}I", *found)
        self[piece] = ids
        return ids

    def trim(self) -> None:
        if len(self) > self.kept:
            self.older = dict(self)
            self.clear()
