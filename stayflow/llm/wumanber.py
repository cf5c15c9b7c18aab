"""Benchmark decontamination by Wu-Manber search over words.

The patterns are the windows of 13 consecutive words of the benchmark items (all words
of a shorter item). A table of shifts, addressed by the hash of two words, says how far the
search may move on: a block of words that no pattern holds lets it skip a whole window.
Where the shift is zero, the patterns that end in such a block stand in a bucket, in the
order of their hashes; those with the hash of the text's window are selected and compared
with it word by word. Windows of one length are searched together.

An index is arrays only: the items' words as numbers, the places of the windows in them
sorted by bucket and hash, the shifts. It is built once, broadcast, and kept by each worker.
The benchmark is cut into blocks of at most ``BLOCK_BYTES`` of text, each with its own index,
so neither the driver nor a task ever holds more than one. With several blocks, the rows of
the documents are numbered, each pass gives the hits of the documents that have any, and
hits are put together by row number: texts are written once and not carried along.

Defined cases: null and empty texts have no words; an item without words has no windows;
repeated items count once by their id, and hits of items with a null id count but are not
listed; repeated documents each get a row; with no benchmark nothing is hit; other columns
are left alone, whatever their names, but columns named as the results are replaced; of a
very long text the numbers of its words are held, four bytes a word, and a bit for each hit.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from stayflow.llm.terms import TERMS, word_runs
from stayflow.llm.text import TEXT, free_name, slices
from stayflow.session import materialize

WINDOW = 13
BLOCK_BYTES = 8 << 20
PIECE_WORDS = 4096
SHIFT_BITS = 22
FIELDS = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"

_BASE = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[bytes]:
    return [w for found in word_runs(text, TERMS) for w in found]


def _pairs(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Places in the table of shifts of blocks of two words."""
    with np.errstate(over="ignore"):
        mixed = (first.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9) + second.astype(np.uint64)) * _BASE
    return (mixed >> np.uint64(64 - SHIFT_BITS)).astype(np.int64)


def _window_hashes(ids: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` numbers."""
    n = len(ids) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            out = (out ^ ids[k : k + n].astype(np.uint64)) * _BASE
            out ^= out >> np.uint64(31)
    return out


class Searcher:
    """Shifts and buckets of the windows of one length, as places in the items' words."""

    def __init__(self, ids: np.ndarray, starts: np.ndarray, items: np.ndarray, size: int):
        self.size = size
        self.block = min(2, size)
        furthest = size - self.block + 1
        self.shift = np.full(1 << SHIFT_BITS, furthest, np.int8 if furthest < 128 else np.int32)
        for end in range(self.block - 1, size):
            np.minimum.at(self.shift, self._keys(ids, starts + end), size - 1 - end)
        hashes = np.zeros(len(starts), np.uint64)
        with np.errstate(over="ignore"):
            for k in range(size):
                hashes = (hashes ^ ids[starts + k].astype(np.uint64)) * _BASE
                hashes ^= hashes >> np.uint64(31)
        bucket = self._keys(ids, starts + size - 1)
        order = np.lexsort((items, hashes, bucket))
        self.bucket, self.hashes, self.starts, self.items = bucket[order], hashes[order], starts[order].astype(np.int32), items[order].astype(np.int32)

    def _keys(self, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
        return _pairs(ids[at - 1] if self.block == 2 else np.zeros(len(at), np.int32), ids[at])

    def find(self, ids: np.ndarray, patterns: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(place of its first word, items) of every occurrence in a text's numbers."""
        size, n = self.size, len(ids)
        if n < size:
            return
        keys = self._keys(ids, np.arange(self.block - 1, n))
        steps = np.concatenate([np.zeros(self.block - 1, self.shift.dtype), self.shift[keys]]).tolist()
        stops, end = [], size - 1
        while end < n:  # skip as the shifts allow; a stop is a possible end of a window
            step = steps[end]
            if not step:
                stops.append(end)
                step = 1
            end += step
        if not stops:
            return
        at = np.array(stops)
        key = keys[at - self.block + 1]
        low, high = np.searchsorted(self.bucket, key, "left"), np.searchsorted(self.bucket, key, "right")
        some = np.flatnonzero(low < high)
        if not len(some):
            return
        hashed = _window_hashes(ids, size)
        for a, z, start in zip(low[some].tolist(), high[some].tolist(), (at[some] - size + 1).tolist()):
            bucket = self.hashes[a:z]
            i, j = a + np.searchsorted(bucket, hashed[start], "left"), a + np.searchsorted(bucket, hashed[start], "right")
            if i == j:
                continue
            here = ids[start : start + size]
            same = (patterns[self.starts[i:j, None] + np.arange(size)] == here).all(axis=1)
            if same.any():
                yield start, np.unique(self.items[i:j][same])


class Index:
    """All windows of one block of benchmark pieces (item, words)."""

    def __init__(self, pieces: list[tuple[str | None, bytes]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        self.items = list(dict.fromkeys(item for item, _ in pieces))
        number, place = self.vocabulary, {item: i for i, item in enumerate(self.items)}
        parts, starts, owners, at = [], {}, {}, 0
        for item, text in pieces:
            ids = np.fromiter((number.setdefault(w, len(number) + 1) for w in text.split()), np.int32)
            size = min(window, len(ids))
            if size:
                first = np.arange(at, at + len(ids) - size + 1)
                starts.setdefault(size, []).append(first)
                owners.setdefault(size, []).append(np.full(len(first), place[item]))
            parts.append(ids)
            at += len(ids)
        self.patterns = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        self.searchers = [Searcher(self.patterns, np.concatenate(starts[s]), np.concatenate(owners[s]), s) for s in sorted(starts)]

    def search(self, text: str | None) -> tuple[int, np.ndarray, set]:
        """Number of words, the hit ones as bits, and the items that occur."""
        runs = [np.fromiter(map(self.vocabulary.get, found, repeat(0)), np.int32, len(found)) for found in word_runs(text, TERMS)]
        ids = np.concatenate(runs) if runs else np.zeros(0, np.int32)
        hit, which = np.zeros(len(ids), bool), set()
        for searcher in self.searchers:
            for start, items in searcher.find(ids, self.patterns):
                hit[start : start + searcher.size] = True
                which.update(items.tolist())
        return len(ids), hit, {self.items[i] for i in which}


def _pieces(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(item, words): items in runs of bounded length that overlap by a window less one word."""
    source = benchmark.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).cast("string").alias(TEXT))

    def run(batches):
        for batch in batches:
            for part in slices(batch, TEXT):
                items, texts = [], []
                for item, text in zip(part.column("item").to_pylist(), part.column(TEXT).to_pylist()):
                    found = words(text)
                    for i in range(0, max(1, len(found) - window + 1), PIECE_WORDS):
                        if found:
                            items.append(item)
                            texts.append(b" ".join(found[i : i + PIECE_WORDS + window - 1]))
                yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(texts, pa.binary())], names=["item", "words"])

    return source.mapInArrow(run, "item string, words binary")


def blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple]]:
    """The distinct pieces in blocks of bounded size; at least one block, be it empty."""
    pieces = materialize(_pieces(benchmark, id_col, text_col, window).distinct(), "benchmark-pieces")
    block, size = [], 0
    for row in pieces.toLocalIterator():
        if size + len(row.words) > block_bytes and block:
            yield block
            block, size = [], 0
        block.append((row.item, bytes(row.words)))
        size += len(row.words)
    yield block


def contaminated(n_words: int, n_hit: int) -> bool:
    return n_hit > 0 and 20 * n_hit >= n_words


def _sha256(items) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()


def _hits(docs: DataFrame, row_col: str, text_col: str, shared, all_rows: bool) -> DataFrame:
    """(row, n_words, hits, items): one block's hits; ``all_rows`` keeps the documents without any."""
    schema = T._parse_datatype_string("row long, n_words long, hits binary, items array<string>")
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for part in slices(batch, text_col):
                made = []
                for row, text in zip(part.column(row_col).to_pylist(), part.column(text_col).to_pylist()):
                    n, hit, items = shared.value.search(text)
                    if all_rows or items:
                        made.append((row, n, np.packbits(hit).tobytes() if items else None, sorted(items - {None})))
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*made) if made else [[]] * 4, arrow)], schema=arrow)

    return docs.select(row_col, text_col).mapInArrow(run, schema)


def _together(found: DataFrame) -> DataFrame:
    """(row, n_words, n_hit, items) of documents with their hits in all blocks: at most a row for each block."""

    def add_up(table: pa.Table) -> pa.Table:
        n = max(table.column("n_words").to_pylist())
        bits, items = np.zeros((n + 7) // 8, np.uint8), set()
        for hits, named in zip(table.column("hits").to_pylist(), table.column("items").to_pylist()):
            if hits is not None:
                bits |= np.frombuffer(hits, np.uint8)
                items.update(named)
        row = {"row": [table.column("row")[0].as_py()], "n_words": [n], "n_hit": [int(np.bitwise_count(bits).sum())], "items": [sorted(items)]}
        return pa.table(row, schema=pa.schema([("row", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string()))]))

    return found.groupBy("row").applyInArrow(add_up, "row long, n_words long, n_hit long, items array<string>")


def _searched(docs: DataFrame, text_col: str, index: Index, schema: T.StructType, close) -> DataFrame:
    """One pass; ``close`` makes a batch of ``schema`` from a batch, numbers of words, of hits, and lists of items."""
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches):
        for batch in batches:
            for part in slices(batch, text_col):
                found = [shared.value.search(t) for t in part.column(text_col).to_pylist()]
                yield close(part, [n for n, _, _ in found], [int(h.sum()) for _, h, _ in found], [sorted(i - {None}) for _, _, i in found])

    return docs.mapInArrow(run, schema)


def _two(benchmark: DataFrame, item_col: str, item_text: str, window: int, block_bytes: int) -> tuple[list, Iterator[list] | None]:
    """The first block, and an iterator of all blocks if there are more."""
    following = blocks(benchmark, item_col, item_text, window, block_bytes)
    first, second = next(following), next(following, None)
    return first, None if second is None else chain([first, second], following)


def _by_row(docs: DataFrame, row_col: str, text_col: str, following: Iterator[list], window: int) -> DataFrame:
    """(row, n_words, n_hit, items) of numbered documents over several blocks, one block at a time."""
    parts = None
    for block in following:
        shared = docs.sparkSession.sparkContext.broadcast(Index(block, window))
        part = materialize(_hits(docs, row_col, text_col, shared, parts is None), "block-hits")
        shared.unpersist()
        parts = part if parts is None else parts.unionByName(part)
    plain = parts.groupBy("row").agg(F.max("n_words").alias("n_words"), F.count("hits").alias("_blocks"))
    hit = _together(parts.join(plain.filter("_blocks > 0").select("row"), "row", "left_semi"))
    none = plain.filter("_blocks = 0").select("row", "n_words", F.lit(0).cast("bigint").alias("n_hit"), F.array().cast("array<string>").alias("items"))
    return hit.unionByName(none)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Hit words and occurring items of every document; ``items`` lists the items."""
    source = docs.select(F.col(id_col), F.col(text_col).cast("string").alias(TEXT))
    added = T._parse_datatype_string(FIELDS + ", items array<string>")
    schema = T.StructType([source.schema[id_col], *added.fields])
    arrow = to_arrow_schema(schema)

    def close(part, n_words, n_hit, listed):
        columns = [n_words, n_hit, list(map(len, listed)), list(map(_sha256, listed)), list(map(contaminated, n_words, n_hit)), listed]
        made = [pa.array(c, arrow.field(f.name).type) for c, f in zip(columns, added.fields)]
        return pa.RecordBatch.from_arrays([part.column(id_col), *made], names=schema.names)

    first, following = _two(benchmark, item_col, item_text, window, block_bytes)
    if following is None:
        return _searched(source, TEXT, Index(first, window), schema, close)
    row = free_name("_row", source.columns)
    rows = materialize(source.withColumn(row, F.monotonically_increasing_id()), "numbered-documents")
    hits = _by_row(rows, row, TEXT, following, window)
    judged = F.expr("n_hit > 0 AND 20 * n_hit >= n_words")
    named = hits.withColumns({"n_items": F.size("items").cast("bigint"), "items_sha256": F.sha2(F.concat_ws(",", "items"), 256), "contaminated": judged})
    return rows.select(F.col(id_col), F.col(row).alias("row")).join(named, "row").select(*schema.names)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents, with all their columns, that are not contaminated."""

    def close(part, n_words, n_hit, listed):
        return part.filter(pa.array([not contaminated(n, h) for n, h in zip(n_words, n_hit)], pa.bool_()))

    first, following = _two(benchmark, item_col, item_text, window, block_bytes)
    if following is None:
        return _searched(docs, text_col, Index(first, window), docs.schema, close)
    row = free_name("_row", docs.columns)
    rows = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "numbered-documents")
    body = free_name(TEXT, [row])
    gone = _by_row(rows.select(row, F.col(f"`{text_col}`").cast("string").alias(body)), row, body, following, window)
    gone = gone.filter("n_hit > 0 AND 20 * n_hit >= n_words").select(F.col("row").alias(row))
    return rows.join(gone, row, "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))
