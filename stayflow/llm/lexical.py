"""Ranked lexical search by dense tiles: item weights times document impacts.

Each block of items has a vocabulary, and a document is reduced to the impacts of the terms
in it. Items are taken in tiles with a compact vocabulary of their own; a tile of weights
(items by terms) is multiplied with a tile of impacts (terms by documents) by BLAS in
float64. Weights and impacts are whole numbers, and a tile has so few terms that no sum in
it reaches 2^53, so every product is exact; sums over several tiles of terms are added as
64-bit integers. Of each tile of documents the best per item are kept: those at or above
the last kept score are compared by score and id, so ties are decided as in a full sort.
A task hands on at most ``top`` rows per item; these are ranked in two steps.

Collection counts (documents, terms, documents per term) cover all documents and are taken
once per block. Items go to the tasks in blocks of bounded size, one broadcast each.

Ids are whole numbers. Defined cases: null texts and texts without terms rank nowhere and do
not count; repeated documents are ranked each, repeated items each get their own ranks, and
equal scores go by id, null ids last; an item without terms, an empty collection or no
items give no rows; a very long text is counted run by run; other columns do not matter.
"""
from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from stayflow.llm.terms import TERMS, word_runs
from stayflow.llm.text import TEXT, slices
from stayflow.session import materialize

TOP = 10
BLOCK_BYTES = 8 << 20
ITEM_TILE = 128
TERM_TILE = 2048
DOC_TILE = 512
SALTS = 64

# The scale of impacts and the share of the length in them.
SCALE = 1_000_000_000
LENGTH_SHARE = 90
HIGHEST_IMPACT = 1_000_000


class Block:
    """A block of items: their vocabulary and, for each item, the places of its terms in it."""

    def __init__(self, rows: list[tuple[int, list[bytes]]]):
        self.vocabulary: dict[bytes, int] = {}
        self.numbers = np.array([number for number, _ in rows], np.int64)
        place = self.vocabulary
        self.terms = [np.array([place.setdefault(t, len(place)) for t in terms], np.int64) for _, terms in rows]

    def counts(self, text: str | None) -> tuple[int, np.ndarray, np.ndarray]:
        """Number of terms of a text, and the vocabulary's terms in it with their occurrences."""
        n, places = 0, []
        for found in word_runs(text, TERMS):
            n += len(found)
            at = np.fromiter(map(self.vocabulary.get, found, repeat(-1)), np.int64, len(found))
            places.append(np.unique(at[at >= 0], return_counts=True))
        if len(places) == 1:
            return n, *places[0]
        if not places:
            return 0, np.zeros(0, np.int64), np.zeros(0, np.int64)
        term, back = np.unique(np.concatenate([t for t, _ in places]), return_inverse=True)
        return n, term, np.bincount(back, np.concatenate([c for _, c in places]), len(term)).astype(np.int64)


def item_terms(items: DataFrame, text_col: str) -> DataFrame:
    """The rows of ``items`` with a number and their distinct terms, without those that have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, TEXT):
                terms = [sorted({t for found in word_runs(text, TERMS) for t in found}) for text in part.column(TEXT).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("_item"), pa.array(terms, pa.list_(pa.binary()))], names=["_item", "_terms"])

    kind = items.schema["_item"].dataType.simpleString()
    found = items.select("_item", F.col(f"`{text_col}`").cast("string").alias(TEXT)).mapInArrow(run, f"_item {kind}, _terms array<binary>")
    return materialize(found.filter("size(_terms) > 0").withColumn("_number", F.monotonically_increasing_id()), "item-terms")


def item_blocks(items: DataFrame, block_bytes: int) -> Iterator[Block]:
    """Items in blocks of bounded size (a larger item is a block by itself)."""
    rows, size = [], 0
    for row in items.select("_number", "_terms").toLocalIterator():
        here = sum(map(len, row["_terms"])) + 8 * len(row["_terms"])
        if rows and size + here > block_bytes:
            yield Block(rows)
            rows, size = [], 0
        rows.append((row["_number"], [bytes(t) for t in row["_terms"]]))
        size += here
    if rows:
        yield Block(rows)


def collection_counts(texts: DataFrame, shared, size: int) -> tuple[int, int, np.ndarray]:
    """Documents with a term, terms in all, and documents per term of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, total, holding = shared.value, 0, 0, np.zeros(size, np.int64)
        for batch in batches:
            for part in slices(batch, TEXT):
                for text in part.column(TEXT).to_pylist():
                    n, term, _ = block.counts(text)
                    held, total = held + (n > 0), total + n
                    holding[term] += 1
        seen = np.flatnonzero(holding)
        key, value = np.concatenate([[-2, -1], seen]), np.concatenate([[held, total], holding[seen]])
        yield pa.RecordBatch.from_arrays([pa.array(key.astype("int64")), pa.array(value.astype("int64"))], names=["term", "n"])

    holding, both = np.zeros(size, np.int64), {-2: 0, -1: 0}
    for r in texts.select(TEXT).mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect():  # one row per vocabulary term
        if r["term"] < 0:
            both[r["term"]] = r["n"]
        else:
            holding[r["term"]] = r["n"]
    return both[-2], both[-1], holding


def term_weights(documents: int, holding: np.ndarray) -> np.ndarray:
    """Thousandths of the log of smoothed rarity, rounded down; never negative."""
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in holding.tolist()], np.int64)


def impacts(n: int, tf: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """Saturated occurrences of one document's terms, relative to its length; at most a million."""
    m = 100 - LENGTH_SHARE + (LENGTH_SHARE * n * documents) // terms
    return (SCALE * tf) // (1000 * tf + 8 * m)


class Tiles:
    """The items of a block in tiles with compact vocabularies, and the best documents so far."""

    def __init__(self, block: Block, weights: np.ndarray, top: int, item_tile: int = ITEM_TILE, term_tile: int = TERM_TILE):
        self.block, self.weights, self.top = block, weights, top
        # no sum of this many products reaches 2^53
        self.term_tile = max(1, min(term_tile, (2**53 - 1) // (HIGHEST_IMPACT * max(1, int(weights.max(initial=1))))))
        self.tiles = [(a, min(a + item_tile, len(block.terms))) for a in range(0, len(block.terms), item_tile)]
        n = len(block.terms)
        self.scores, self.ids = np.zeros((n, top), np.int64), np.zeros((n, top), np.int64)
        self.void = np.ones((n, top), bool)  # no id, or nothing kept yet

    def add(self, ids: np.ndarray, void: np.ndarray, doc: np.ndarray, term: np.ndarray, impact: np.ndarray) -> None:
        """One tile of documents: ids, and its impacts as (document's place, term, impact)."""
        local = np.full(len(self.weights), -1, np.int64)
        for a, z in self.tiles:
            own = np.unique(np.concatenate(self.block.terms[a:z]))
            local[own] = np.arange(len(own))
            total = np.zeros((z - a, len(ids)), np.int64)
            column = local[term]
            rows = np.repeat(np.arange(z - a), [len(t) for t in self.block.terms[a:z]])
            terms = np.concatenate(self.block.terms[a:z])
            for start in range(0, len(own), self.term_tile):
                width = min(self.term_tile, len(own) - start)
                inside = (column >= start) & (column < start + width)
                if not inside.any():
                    continue
                right = np.zeros((width, len(ids)))
                right[column[inside] - start, doc[inside]] = impact[inside]
                left = np.zeros((z - a, width))
                at = local[terms] - start
                here = (at >= 0) & (at < width)
                left[rows[here], at[here]] = self.weights[terms[here]]
                total += (left @ right).astype(np.int64)
            local[own] = -1
            self._keep(a, total, ids, void)

    def _keep(self, first: int, total: np.ndarray, ids: np.ndarray, void: np.ndarray) -> None:
        last = np.maximum(self.scores[first : first + len(total), -1], 1)
        if total.shape[1] > self.top:  # only the tile's best, with all that tie with the last of them
            last = np.maximum(last, np.partition(total, -self.top, axis=1)[:, -self.top])
        wins = total >= last[:, None]
        for i in np.flatnonzero(wins.any(axis=1)):
            at = np.flatnonzero(wins[i])
            score = np.concatenate([self.scores[first + i], total[i, at]])
            who, none = np.concatenate([self.ids[first + i], ids[at]]), np.concatenate([self.void[first + i], void[at]])
            order = np.lexsort((who, none, -score))[: self.top]
            self.scores[first + i], self.ids[first + i], self.void[first + i] = score[order], who[order], none[order]

    def result(self) -> pa.RecordBatch:
        item, rank = np.nonzero(self.scores > 0)
        ids = pa.array(self.ids[item, rank], mask=self.void[item, rank])
        return pa.RecordBatch.from_arrays([pa.array(self.block.numbers[item]), ids, pa.array(self.scores[item, rank])], names=["_number", "_doc", "score"])


def _best(texts: DataFrame, shared, counts: tuple[int, int, np.ndarray], top: int, doc_tile: int) -> DataFrame:
    """(_number, _doc, score): each task's best documents for each item of a block."""
    documents, terms, holding = counts
    weights = texts.sparkSession.sparkContext.broadcast(term_weights(documents, holding))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        tiles = Tiles(block, weights.value, top)
        held: list[tuple] = []

        def flush() -> None:
            if held:
                ids = np.array([i or 0 for i, _, _ in held], np.int64)
                void = np.array([i is None for i, _, _ in held])
                doc = np.repeat(np.arange(len(held)), [len(t) for _, t, _ in held])
                tiles.add(ids, void, doc, np.concatenate([t for _, t, _ in held]), np.concatenate([x for _, _, x in held]))
                held.clear()

        for batch in batches:
            for part in slices(batch, TEXT):
                for i, text in zip(part.column("_doc").to_pylist(), part.column(TEXT).to_pylist()):
                    n, term, tf = block.counts(text)
                    if len(term):
                        held.append((i, term, impacts(n, tf, documents, terms)))
                        if len(held) == doc_tile:
                            flush()
        flush()
        yield tiles.result()

    return texts.mapInArrow(run, "_number bigint, _doc bigint, score bigint")


def search(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
    top: int = TOP, block_bytes: int = BLOCK_BYTES, doc_tile: int = DOC_TILE,
) -> DataFrame:
    """(item, rank, id, score): the ``top`` best documents of every item."""
    context = docs.sparkSession.sparkContext
    texts = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("_doc"), F.col(f"`{text_col}`").cast("string").alias(TEXT))
    wanted = item_terms(items.select(F.col(f"`{item_col}`").alias("_item"), F.col(f"`{item_text}`").alias(TEXT)), TEXT)
    found = None
    for block in item_blocks(wanted, block_bytes):
        shared = context.broadcast(block)  # at most ``block_bytes`` of terms, or one item
        counts = collection_counts(texts, shared, len(block.vocabulary))
        best = _best(texts, shared, counts, top, doc_tile)
        found = best if found is None else found.unionByName(best)
    if found is None:
        found = docs.sparkSession.createDataFrame([], "_number bigint, _doc bigint, score bigint")
    order = [F.desc("score"), F.asc_nulls_last("_doc")]
    salted = found.withColumn("_salt", F.spark_partition_id() % SALTS)
    first = salted.withColumn("_r", F.row_number().over(Window.partitionBy("_number", "_salt").orderBy(*order))).filter(F.col("_r") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("_number").orderBy(*order))).filter(F.col("rank") <= top)
    named = ranked.join(wanted.select("_number", "_item"), "_number")
    return named.select(F.col("_item").alias(item_col), "rank", F.col("_doc").alias(id_col), "score")
