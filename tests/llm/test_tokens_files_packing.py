"""Tokens against the tokenizers library; id files by exact round trip; packing by its rules."""
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from stayflow.llm import bitplanes, packing
from stayflow.llm.tokens import ChunkEncoder, tokenizer_path


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def ids_of(library, text, end):
    return np.array(library.encode(text or "", add_special_tokens=False).ids + [end], "<u4")


def test_chunks_equal_whole_texts(library):
    rng = random.Random(1)
    signs = "abAB éÉñİßΣς \t\n\r\x0b\x0c\x1c\x85  ̱́̌'´`.,!<|>×÷ªº 019 hHjJ日本語한각‍😀﻿ 'S't"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 200))) for _ in range(800)]
    texts += [None, "", "<|endoftext|> a<|startoftext|>b <|ENDOFTEXT|>", "x" * 50_000, "don't I'LL we'Ve '’s"]
    small = ChunkEncoder(chunks_kept=300, pieces_kept=200)
    for i in range(0, len(texts), 100):
        for text, raw in zip(texts[i : i + 100], small.encode(texts[i : i + 100])):
            assert raw == ids_of(library, text, 0)[:-1].tobytes()


@pytest.mark.parametrize("unit", ["bit", "byte"])
@pytest.mark.parametrize("ids", [[], [0], [1, 2, 3], [2**32 - 1, 0, 70_000], list(range(5000))])
def test_planes_invert(unit, ids):
    array = np.array(ids, "<u4")
    assert (bitplanes.from_planes(bitplanes.to_planes(array, unit), len(ids)) == array).all()


@pytest.mark.parametrize("unit, chunk", [("bit", 1000), ("byte", 65_536), ("bit", 64)])
def test_files_round_trip(spark, odd, library, unit, chunk, tmp_path):
    rows = sorted(bitplanes.round_trip(odd, path=str(tmp_path), unit=unit, chunk_ids=chunk, file_chars=100_000).collect(), key=lambda r: r.start)
    assert len(list(tmp_path.glob("part-*.ids"))) > 1 and not list(tmp_path.glob(".part*.ids.*"))
    texts = defaultdict(list)
    for r in odd.collect():
        texts[r.doc_id].append(ids_of(library, r.text, bitplanes.END_ID))
    assert [r.doc_id for r in rows] == sorted((k for k, v in texts.items() for _ in v), key=lambda k: (k is not None, k or 0))
    at = 0
    for r in rows:
        assert r.start == at and (r.n_tokens, r.ids_crc32) in [(len(x), zlib.crc32(x.tobytes())) for x in texts[r.doc_id]]
        at += r.n_tokens


def test_files_of_nothing(none):
    assert bitplanes.round_trip(none).count() == 0


def test_broken_file_is_told(tmp_path):
    import pyarrow as pa

    (tmp_path / "f").write_bytes(b"IDPLANE1" + bytes(40))
    with pytest.raises(ValueError):
        list(bitplanes.read_file(pa.OSFile(str(tmp_path / "f"))))


def check_packing(rows, texts, library, size):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for doc, found in pieces.items():
        whole = [ids_of(library, t, packing.END_ID) for t in texts[doc]]
        assert sum(r.length for r in found) == sum(map(len, whole))
        for r in found:
            assert any(r.doc_tokens == len(x) and zlib.crc32(x[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for x in whole)
    assert set(pieces) == set(texts)
    for found in sequences.values():
        at = 0
        for r in sorted(found, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= size and (at == size or at & (at - 1) == 0)  # nothing is padded


@pytest.mark.parametrize("size, shard", [(4096, 2_000_000), (64, 500)])
def test_packing_keeps_every_id(odd, docs, library, size, shard):
    for frame in (odd, docs):
        texts = defaultdict(list)
        for r in frame.select("doc_id", "text").collect():
            texts[r.doc_id].append(r.text)
        check_packing(packing.pack_documents(frame, size=size, shard_tokens=shard).collect(), texts, library, size)


@pytest.mark.parametrize("parts", [1, 50])
def test_short_sequences_are_few_at_any_number_of_partitions(docs, library, parts):
    rows = packing.pack_documents(docs.repartition(parts)).collect()
    size = defaultdict(int)
    for r in rows:
        size[r.sequence_id] += r.length
    total = sum(size.values())
    assert sum(n < packing.SEQUENCE for n in size.values()) == (total % packing.SEQUENCE).bit_count() <= 12
    assert sum(n == packing.SEQUENCE for n in size.values()) == total // packing.SEQUENCE


def test_pieces_go_where_a_plain_search_puts_them():
    rng = np.random.default_rng(1)
    for loose in (False, True):
        lengths = rng.integers(1, 150, 300)
        pieces, costs = packing.pack(lengths, 64, 1.0, 1 / 64, loose)
        room = packing.rooms(int((lengths % 64).sum()), 64)
        room = [r for r in room if r == 64] if loose else room
        used, cost, whole, expect = [0] * len(room), [0.0] * len(room), int((lengths // 64).sum()), []
        for doc in sorted(range(300), key=lambda d: -(lengths[d] % 64)):
            left, start = int(lengths[doc] % 64), int(lengths[doc] // 64 * 64)
            while left:
                fits = [i for i in range(len(room)) if room[i] - used[i] >= left] or [i for i in range(len(room)) if room[i] > used[i]]
                if not fits:
                    expect.append((doc, start, left, -1, 0))
                    break
                at = min(fits, key=lambda i: (cost[i], i))
                n = min(left, room[at] - used[at])
                expect.append((doc, start, n, whole + at, used[at]))
                used[at], cost[at] = used[at] + n, cost[at] + n + n * n / 64
                start, left = start + n, left - n
        assert [tuple(p) for p in pieces[whole:].tolist()] == expect and np.allclose(costs[whole:], cost)


def test_packing_of_nothing(none):
    assert packing.pack_documents(none).count() == 0


def test_costs_are_balanced():
    lengths = np.random.default_rng(3).integers(1, 1500, 4000)
    pieces, costs = packing.pack(lengths)
    full = np.bincount(pieces[:, 3], pieces[:, 2]) == packing.SEQUENCE
    in_order = np.add.reduceat(lengths + lengths**2 / packing.SEQUENCE, np.arange(0, 4000, 6))
    assert costs[full].std() / costs[full].mean() < 0.1 < in_order.std() / in_order.mean()
    assert len(pieces) < 1.2 * len(lengths)
