"""SimHash near-duplicates by a Gray-order hierarchical index over bit patterns.

Copies share a fingerprint and are collapsed first. The index is a tree over the
distinct fingerprints. A node is a masked bit pattern that all fingerprints below it
share. The upper nodes are the same for every input: the bits are cut into
``max_bits + 1`` blocks, and a node fixes one block, so two fingerprints within
``max_bits`` meet in at least one node. A node with more than ``leaf_rows`` fingerprints
gets children that fix a block of the remaining bits, and so on; the deepest nodes leave
so few free bits that their size is bounded by the bits alone. Nodes are dealt to tasks
by their pattern. Inside a node the fingerprints are sorted by Gray rank, so that
neighbours differ in few bits; runs of them form lower nodes that keep only the bits all
members share, and a search adds up the differences from shared patterns on the way
down and drops whole groups once the sum exceeds ``max_bits``.

A search keeps one link for each fingerprint of a local group, never all pairs, and the
links of all nodes are joined to components by :mod:`stayflow.llm.components`.

Defined cases: null and empty texts have fingerprint zero and link like others; ties in
a bit's vote give 0; a very long text is hashed run by run, so that only its bits' counts are
held; repeated rows each get a row; an empty table gives no rows; the
smallest id of a group ignores null ids and is null where all are; only the two named
columns are read, so others do not matter.
"""
from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stayflow.llm.components import components
from stayflow.llm.terms import WORDS, gram_runs
from stayflow.llm.text import append_columns, free_name
from stayflow.session import materialize

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
LEAF_ROWS = 4096
DEPTH = 4
BITS = 64

_GROUP = 16  # fingerprints or lower nodes below one node of the local tree
_QUERIES = 512  # fingerprints that search the local tree at once


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """Majority bits of the XXH64 values of all word shingles, repeats included."""
    import xxhash

    digest, total, n = xxhash.xxh64_digest, np.zeros(BITS, np.int64), 0
    for grams in gram_runs(text, WORDS, words):
        for i in range(0, len(grams), 65536):
            part = grams[i : i + 65536]
            raw = np.frombuffer(b"".join([digest(s, SEED) for s in part]), np.uint8).reshape(-1, 8)
            total += np.unpackbits(raw, axis=1).sum(axis=0, dtype=np.int64)
        n += len(grams)
    return int.from_bytes(np.packbits(2 * total > n).tobytes(), "big") if n else 0


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in the reflected Gray sequence."""
    rank = codes.astype(np.uint64).copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def signed(value: int) -> int:
    return value - (1 << BITS) if value >= 1 << (BITS - 1) else value


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """(id, fp): the 64 bits as a signed long."""

    def make():
        return lambda texts: {"fp": [signed(fingerprint(t, words)) for t in texts]}

    return append_columns(docs, text_col, make, "fp long", [id_col])


def child_masks(mask: int, parts: int) -> list[int]:
    """``mask`` with one of ``parts`` blocks of its free bits fixed in addition."""
    free = [b for b in range(BITS) if not mask >> b & 1]
    edges = [len(free) * i // parts for i in range(parts + 1)]
    return [mask | sum(1 << b for b in free[a:z]) for a, z in zip(edges, edges[1:]) if z > a]


def mask_levels(max_bits: int, depth: int = DEPTH) -> list[dict[int, list[int]]]:
    """For each level of upper nodes: the masks above and the masks they are refined to."""
    levels, above = [], [0]
    for _ in range(depth):
        level = {m: child_masks(m, max_bits + 1) for m in above}
        levels.append({m: c for m, c in level.items() if c})
        above = [c for children in level.values() for c in children]
    return levels


def _refine(nodes: DataFrame, level: dict[int, list[int]]) -> DataFrame:
    """(mask, pattern, fp) of the children of each row's node."""
    longs = lambda masks: F.array(*(F.lit(signed(m)).cast("long") for m in masks))
    if list(level) == [0]:
        masks = longs(level[0])
    else:
        masks = None
        for above, below in level.items():
            here = F.col("mask") == F.lit(signed(above))
            masks = F.when(here, longs(below)) if masks is None else masks.when(here, longs(below))
    return nodes.select("fp", F.explode(masks).alias("mask")).select("mask", F.col("mask").bitwiseAND(F.col("fp")).alias("pattern"), "fp")


def index_leaves(codes: DataFrame, max_bits: int = MAX_BITS, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """(mask, pattern, fp): every fingerprint below each lowest upper node it belongs to."""
    levels = mask_levels(max_bits)
    nodes, leaves = _refine(codes, levels[0]), None
    for depth, level in enumerate(levels):
        last = depth + 1 == len(levels)
        if last:
            here = nodes
        else:
            large = materialize(nodes.groupBy("mask", "pattern").count().filter(F.col("count") > leaf_rows).select("mask", "pattern"), "large-nodes")
            here = nodes.join(large, ["mask", "pattern"], "left_anti")
        leaves = here if leaves is None else leaves.unionByName(here)
        if last or large.isEmpty():
            return leaves
        nodes = _refine(nodes.join(large, ["mask", "pattern"], "left_semi"), levels[depth + 1])


class GrayIndex:
    """The lower part of the tree over the sorted, distinct fingerprints of one node.

    ``masks[k]`` and ``shared[k]`` hold for level k the bits that all members of a group
    share and that no group above has already fixed, with their values.
    """

    def __init__(self, codes: np.ndarray):
        self.codes = codes[np.argsort(gray_rank(codes), kind="stable")]
        ones, zeros = self.codes, ~self.codes
        same: list[tuple[np.ndarray, np.ndarray]] = []
        while len(ones) > _GROUP:
            starts = np.arange(0, len(ones), _GROUP)
            ones, zeros = np.bitwise_and.reduceat(ones, starts), np.bitwise_and.reduceat(zeros, starts)
            same.append((ones | zeros, ones))
        self.masks, self.shared = [], []
        above = np.zeros(0, np.uint64)
        for mask, value in reversed(same):
            parents = above[np.arange(len(mask)) // _GROUP] if len(above) else np.zeros(len(mask), np.uint64)
            self.masks.append(mask & ~parents)
            self.shared.append(value & mask & ~parents)
            above = mask
        last = above[np.arange(len(self.codes)) // _GROUP] if len(above) else np.zeros(len(self.codes), np.uint64)
        self.masks.append(~last)
        self.shared.append(self.codes & ~last)

    def links(self, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Blocks of positions (i, j), i < j, of fingerprints within ``max_bits``."""
        n = len(self.codes)
        for start in range(0, n, _QUERIES):
            query = np.arange(start, min(start + _QUERIES, n))
            node = np.arange(len(self.masks[0]))
            who, node = np.repeat(query, len(node)), np.tile(node, len(query))
            spent = np.zeros(len(who), np.int64)
            for level, (mask, shared) in enumerate(zip(self.masks, self.shared)):
                if level:
                    children = (node[:, None] * _GROUP + np.arange(_GROUP)).ravel()
                    who, spent = np.repeat(who, _GROUP), np.repeat(spent, _GROUP)
                    real = children < len(mask)
                    who, spent, node = who[real], spent[real], children[real]
                # only later fingerprints are wanted: a group that ends before the query is dropped
                reach = _GROUP ** (len(self.masks) - 1 - level)
                spent = spent + np.bitwise_count((self.codes[who] & mask[node]) ^ shared[node])
                alive = (spent <= max_bits) & ((node + 1) * reach > who)
                who, node, spent = who[alive], node[alive], spent[alive]
            later = node > who
            yield who[later], node[later]


def roots(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For each position the smallest position it is linked with."""
    root = np.arange(n)
    for a, b in pairs:
        while len(a):
            ra, rb = root[a], root[b]
            high, low = np.maximum(ra, rb), np.minimum(ra, rb)
            open_ = high != low
            if not open_.any():
                break
            a, b = a[open_], b[open_]
            np.minimum.at(root, high[open_], low[open_])
            while True:
                up = root[root]
                if np.array_equal(up, root):
                    break
                root = up
    return root


def _node_links(codes: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (fp, root fp) that hold together each local group of one node."""
    index = GrayIndex(codes)
    root = roots(len(index.codes), index.links(max_bits))
    moved = root != np.arange(len(root))
    return index.codes[moved], index.codes[root[moved]]


def _run_links(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Links of all nodes of a sorted partition; at most one node is held beyond a batch."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def out(links: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        a = np.concatenate([x for x, _ in links]).view(np.int64) if links else np.zeros(0, np.int64)
        b = np.concatenate([y for _, y in links]).view(np.int64) if links else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    def work(mask, pattern, fp, ends) -> list[tuple[np.ndarray, np.ndarray]]:
        starts = np.concatenate([[0], ends[:-1]])
        links = []
        # nodes of a few fingerprints are single groups: their members are compared directly, all nodes at once
        small = ends - starts <= _GROUP
        of = np.repeat(np.arange(len(ends)), ends - starts)
        inner = small[of]
        code, of = fp[inner], of[inner]
        for d in range(1, _GROUP):
            if len(code) <= d:
                break
            near = (of[d:] == of[:-d]) & (np.bitwise_count(code[d:] ^ code[:-d]) <= max_bits)
            if near.any():
                links.append((code[d:][near], code[:-d][near]))
        for i in np.flatnonzero(~small):
            links.append(_node_links(fp[starts[i] : ends[i]], max_bits))
        return links

    for batch in batches:
        if not batch.num_rows:
            continue
        mask, pattern, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        held.append((mask, pattern, fp.view(np.uint64)))
        if mask[0] == mask[-1] and pattern[0] == pattern[-1] and (len(held) == 1 or (held[0][0][-1] == mask[0] and held[0][1][-1] == pattern[0])):
            if held[0][0][0] == mask[0] and held[0][1][0] == pattern[0]:
                continue  # still the same node
        mask, pattern, fp = (np.concatenate(x) for x in zip(*held))
        ends = np.flatnonzero((mask[1:] != mask[:-1]) | (pattern[1:] != pattern[:-1])) + 1
        done = ends[-1] if len(ends) else 0
        held = [(mask[done:], pattern[done:], fp[done:])]
        if done:
            yield out(work(mask[:done], pattern[:done], fp[:done], ends))
    if held:
        mask, pattern, fp = (np.concatenate(x) for x in zip(*held))
        ends = np.concatenate([np.flatnonzero((mask[1:] != mask[:-1]) | (pattern[1:] != pattern[:-1])) + 1, [len(mask)]])
        yield out(work(mask, pattern, fp, ends))


def fingerprint_links(codes: DataFrame, max_bits: int = MAX_BITS, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """Links (a, b) between distinct fingerprints; their components are those of all pairs within ``max_bits``."""
    leaves = index_leaves(codes, max_bits, leaf_rows)
    dealt = leaves.repartition("mask", "pattern").sortWithinPartitions("mask", "pattern")
    return dealt.mapInArrow(partial(_run_links, max_bits=max_bits), "a long, b long").distinct()


def group_codes(found: DataFrame, id_col: str = "doc_id", max_bits: int = MAX_BITS, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """(fp, root, component_id) of the distinct fingerprints of ``found`` (id, fp)."""
    codes = materialize(found.groupBy("fp").agg(F.min(id_col).alias("first_id")), "codes")
    links = materialize(fingerprint_links(codes.select("fp"), max_bits, leaf_rows), "code-links")
    root = components(links).withColumnRenamed("node", "fp")
    rooted = codes.join(root, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "first_id")
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rooted.select("fp", "root").join(smallest, "root")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """(id, fingerprint, component_id) of every document."""
    found = materialize(fingerprints(docs, id_col, text_col, words), "fingerprints")
    groups = group_codes(found, id_col, max_bits, leaf_rows).select("fp", "component_id")
    return found.join(groups, "fp").select(id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each group, with all its columns: the one with the smallest id.

    Rows that share an id, or have none, are the rare case: of those that could stay for
    a group exactly one does. A group whose rows all lack an id keeps one of them.
    """
    found = materialize(fingerprints(docs, id_col, text_col, words), "fingerprints")
    groups = materialize(group_codes(found, id_col, max_bits), "groups")
    placed = found.join(groups.select("fp", "component_id"), "fp")
    other = free_name("__id", docs.columns)
    repeated = found.groupBy(id_col).count().filter((F.col("count") > 1) | F.col(id_col).isNull()).select(F.col(id_col).alias(other))
    gone = placed.filter(~F.col(id_col).eqNullSafe(F.col("component_id"))).select(F.col(id_col).alias(other))
    repeated = materialize(repeated, "repeated-ids")
    out = docs.filter(F.col(id_col).isNotNull()).join(gone.unionByName(repeated), F.col(id_col) == F.col(other), "left_anti")
    if repeated.isEmpty():
        return out
    again = docs.join(repeated, F.col(id_col).eqNullSafe(F.col(other)), "left_semi")
    return out.unionByName(_one_of_repeated(again, groups, id_col, text_col, words))


def _one_of_repeated(rows: DataFrame, groups: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    names = rows.columns
    whole = rows.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").alias("__body"))

    def make():
        return lambda texts: {"fp": [signed(fingerprint(t, words)) for t in texts]}

    placed = append_columns(whole, "__body", make, "fp long", ["row", "__id"]).join(groups, "fp")
    heads = placed.filter(F.col("__id").eqNullSafe(F.col("component_id")))
    return heads.groupBy("root").agg(F.first("row").alias("row")).select("row.*")
