"""Jaccard join of word n-gram sets by signature trees.

A document is the set of the 64-bit hashes of its word n-grams; equal sets are one class
and are joined as one. Sets that overlap enough differ in few members, and their sizes
alone say in how many at most. So the members are dealt by their hash to one part more
than that (and a few to spare): two linked classes have a part in which they agree. Parts
are keyed by their whole content, a handful of members, so that unrelated texts do not meet
over a common phrase. The number of parts belongs to a range of sizes; a set is keyed for
its own range and, as the smaller partner, for the next one. Empty parts count only for
sets with more of them than there are parts to spare. Classes that share a key, directly or
over others, form a cluster: every link lies inside one.

A cluster is searched by signature trees. Its classes are sorted by size and cut into
blocks of bounded content; a task takes one block and the first one, or in the second round
a pair of blocks. A tree's leaves are bitmaps of the sets, its nodes hold the OR of the
bitmaps below, the range of the sizes and the most members that share a bit. Two nodes
cannot hold a link if their sizes are too far apart or if the common bits, and what may
hide behind them, are fewer than the least overlap of such sizes; the traversal goes down
both sides at once and drops such pairs. Leaves that are left are compared member by
member, unless they are joined already: only links that hold a group together are kept,
never all pairs. A task gives them as stars around the smallest class, so a cluster of one
block has its groups at once; only groups of larger clusters are joined over tasks. Blocks
that the first round has joined into one are not paired again.

Sets and classes are compared by 64-bit hashes.

Defined cases: texts without words have an empty set and are linked with nothing; texts of
fewer words than an n-gram have one member; repeated rows each get a row; the smallest id
of a group ignores null ids and is null where all are; an empty table gives no rows; a very
long text is hashed run by run and is a block by itself; ties of size need no
order; only the two named columns are read, others do not matter.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stayflow.llm.components import components
from stayflow.llm.terms import WORDS, gram_runs
from stayflow.llm.text import append_columns
from stayflow.operators.ordered import running_totals
from stayflow.session import materialize

SHINGLE_WORDS = 3
PERCENT = 90
SEED = 42
BLOCK_COST = 2 << 20  # members of the sets in a block, and MEMBER_COST for each set
MEMBER_COST = 256
FILTER_WORDS = 1 << 18  # 64-bit words of the bit tables that keep rows without a partner from being moved

_GROUP = 16
_WIDEST = 1 << 15  # bits of a bitmap
_WORDS_AT_ONCE = 1 << 20  # 64-bit words of bitmaps compared at once


def members(text: str | None, words: int = SHINGLE_WORDS) -> np.ndarray:
    """The sorted, distinct hashes of a text's word n-grams."""
    import xxhash

    digest, found = xxhash.xxh64_digest, []
    for grams in gram_runs(text, WORDS, words):
        found.append(np.unique(np.frombuffer(b"".join([digest(g, SEED) for g in grams]), ">u8").astype(np.uint64)))
    return np.unique(np.concatenate(found)) if len(found) > 1 else found[0] if found else np.zeros(0, np.uint64)


def code_of(found: np.ndarray) -> int:
    """One signed number for a set."""
    import xxhash

    return int(np.uint64(xxhash.xxh64_intdigest(found.tobytes(), SEED)).astype(np.int64))


def next_end(end: int, percent: int) -> int:
    """The upper end of the range of sizes behind ``end``: wide enough that no partner of a set lies beyond it."""
    return max(end + 1, end * max(150, 10_000 // percent + 1) // 100)


def size_ranges(percent: int, upto: int) -> list[int]:
    """The upper ends of the ranges of sizes: sets of linked classes lie in the same or in neighbouring ranges."""
    ends = [1]
    while ends[-1] < upto:
        ends.append(next_end(ends[-1], percent))
    return ends


def parts_of(end: int, percent: int) -> tuple[int, int]:
    """For sets of up to ``end`` members: the number of parts, and how many of them may be spared.

    Linked sets differ in at most ``2 * end * (100 - percent) / (100 + percent)`` members;
    where that is none, equal sets alone are linked, and there are no parts.
    """
    apart = 2 * end * (100 - percent) // (100 + percent)
    if not apart:
        return 0, 0
    spare = 3 + apart // 25
    return apart + 1 + spare, spare


_MIX = np.uint64(0x9E3779B97F4A7C15)


def part_keys(found: np.ndarray, percent: int) -> np.ndarray:
    """The keys of a set: one for each of its parts in its own range of sizes, and in the next if a partner may lie there."""
    n = len(found)
    if not n:
        return np.zeros(0, np.int64)
    ends = size_ranges(percent, n)
    out = []
    for place, end in ((len(ends), ends[-1]), (len(ends) + 1, next_end(ends[-1], percent))):
        parts, spare = parts_of(end, percent)
        if not parts or (place > len(ends) and n * 100 // percent <= ends[-1]):
            continue
        at = ((found >> np.uint64(17)) % np.uint64(parts)).astype(np.int64)
        content, size = np.zeros(parts, np.uint64), np.bincount(at, minlength=parts)
        np.add.at(content, at, found)
        here = np.arange(parts)
        if (size == 0).sum() <= spare:
            here = here[size > 0]
        with np.errstate(over="ignore"):
            key = content[here] + (np.uint64(place << 32) + here.astype(np.uint64)) * _MIX
            key ^= key >> np.uint64(29)
            key *= np.uint64(0xBF58476D1CE4E5B9)
            key ^= key >> np.uint64(32)
        out.append(key)
    return np.concatenate(out).view(np.int64) if out else np.zeros(0, np.int64)


def sets_of(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> DataFrame:
    """(id, n_shingles, code, keys) of every document."""

    def make():
        def compute(texts: list) -> dict:
            sets = [members(t, words) for t in texts]
            return {"n_shingles": list(map(len, sets)), "code": list(map(code_of, sets)), "keys": [part_keys(s, percent) for s in sets]}

        return compute

    return append_columns(docs, text_col, make, "n_shingles long, code long, keys array<long>", [id_col])


class SignatureTree:
    """Bitmaps of sets, OR-combined level by level; sets are given as one array and their ends."""

    def __init__(self, values: np.ndarray, ends: np.ndarray, percent: int):
        self.percent = percent
        sizes = np.diff(ends, prepend=0)
        # neighbours in the order of the smallest members are likely to be alike
        least = np.array([values[e - n : e].min() if n else 0 for e, n in zip(ends, sizes)], np.uint64)
        self.order = np.lexsort((sizes, least))
        self.sets = [values[ends[i] - sizes[i] : ends[i]] for i in self.order]
        self.sizes = sizes[self.order]
        width = 64
        while width < min(np.median(self.sizes), _WIDEST):
            width *= 2
        bits = np.zeros((len(self.sets), width), bool)
        for row, found in zip(bits, self.sets):
            row[(found % np.uint64(width)).astype(np.int64)] = True
        level = np.packbits(bits, axis=1).view(np.uint64)
        hidden = self.sizes - np.bitwise_count(level).sum(axis=1, dtype=np.int64)
        self.levels = [(level, self.sizes, self.sizes, hidden)]
        while len(level) > _GROUP:
            starts = np.arange(0, len(level), _GROUP)
            _, low, high, hidden = self.levels[-1]
            level = np.bitwise_or.reduceat(level, starts, axis=0)
            self.levels.append((level, np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts), np.maximum.reduceat(hidden, starts)))

    def possible(self, level: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether sets below the nodes i and j of a level can overlap enough."""
        bitmaps, low, high, hidden = self.levels[level]
        p = self.percent
        alive = 100 * np.minimum(high[i], high[j]) >= p * np.maximum(low[i], low[j])
        step = max(1, _WORDS_AT_ONCE // bitmaps.shape[1])
        at = np.flatnonzero(alive)
        for start in range(0, len(at), step):
            part = at[start : start + step]
            a, b = i[part], j[part]
            common = np.bitwise_count(bitmaps[a] & bitmaps[b]).sum(axis=1, dtype=np.int64)
            most = np.minimum(common + np.minimum(hidden[a], hidden[b]), np.minimum(high[a], high[b]))
            alive[part] = (100 + p) * most >= p * (low[a] + low[b])
        return alive

    def linked(self, i: int, j: int) -> bool:
        a, b = self.sets[i], self.sets[j]
        if len(a) > len(b):
            a, b = b, a
        at = np.searchsorted(b, a)
        common = int((b[np.minimum(at, len(b) - 1)] == a).sum())
        return 100 * common >= self.percent * (len(a) + len(b) - common)

    def links(self, root: np.ndarray) -> Iterator[tuple[int, int]]:
        """Links (places in the given order) that join sets of different ``root``."""
        root = root[self.order].copy()
        top = len(self.levels) - 1
        n = len(self.levels[top][0])
        a, b = np.triu_indices(n)
        todo = [(top, a, b)]
        while todo:
            level, i, j = todo.pop()
            if level == 0:
                open_ = root[i] != root[j]
                i, j = i[open_], j[open_]
            if not len(i):
                continue
            alive = self.possible(level, i, j)
            i, j = i[alive], j[alive]
            if level == 0:
                for x, y in zip(i.tolist(), j.tolist()):
                    if root[x] != root[y] and self.linked(x, y):
                        root[root == root[y]] = root[x]
                        yield int(self.order[x]), int(self.order[y])
                continue
            below = len(self.levels[level - 1][0])
            inner = np.arange(_GROUP)
            for start in range(0, len(i), 64):  # in small steps: what one has joined, later ones skip
                x = (i[start : start + 64, None, None] * _GROUP + inner[None, :, None]) + np.zeros((1, 1, _GROUP), np.int64)
                y = (j[start : start + 64, None, None] * _GROUP + inner[None, None, :]) + np.zeros((1, _GROUP, 1), np.int64)
                x, y = x.astype(np.int64).ravel(), y.astype(np.int64).ravel()
                real = (x < below) & (y < below) & ((x < y) if level == 1 else (x <= y))
                todo.append((level - 1, x[real], y[real]))


def least_reached(links: list[tuple[int, int]], n: int) -> np.ndarray:
    """For each of ``n`` places the least one that it reaches over the links."""
    above = list(range(n))

    def top(i: int) -> int:
        while above[i] != i:
            above[i] = i = above[above[i]]
        return i

    for x, y in links:
        x, y = top(x), top(y)
        above[max(x, y)] = min(x, y)
    return np.array([top(i) for i in range(n)], np.int64)


def _tree_links(dealt: DataFrame, percent: int) -> DataFrame:
    """(a, b, whole): the groups that one tree finds for each (cluster, task) of ``dealt`` (cluster, task, code, root, whole, members).

    Each group is a star: a link from every class but the smallest to that one.
    """

    def search(table: pa.Table) -> pa.Table:
        code, first = np.unique(table.column("code").to_numpy(), return_index=True)  # a set may have come more than once
        root = np.unique(table.column("root").to_numpy()[first], return_inverse=True)[1]
        found = table.column("members").combine_chunks()
        found = found.combine_chunks() if isinstance(found, pa.ChunkedArray) else found
        ends, starts = found.offsets.to_numpy()[1:], found.offsets.to_numpy()[:-1]
        values = found.values.to_numpy(zero_copy_only=False).view(np.uint64)
        own = [values[starts[i] : ends[i]] for i in first]
        links = []
        if len(own) > 1:
            tree = SignatureTree(np.concatenate(own), np.cumsum([len(x) for x in own]), percent)
            links = list(tree.links(root))
        least = least_reached(links, len(own))
        a = np.flatnonzero(least != np.arange(len(own)))
        return pa.table({"a": code[a], "b": code[least[a]], "whole": pa.array([table.column("whole")[0].as_py()] * len(a), pa.bool_())})

    return dealt.select("cluster", "task", "code", "root", "whole", "members").groupBy("cluster", "task").applyInArrow(search, "a long, b long, whole boolean")


def _bits(values: DataFrame, column: str) -> DataFrame:
    """A bit for each hash of the values: a table of at most ``FILTER_WORDS`` rows, whatever their number."""
    at = F.pmod(F.xxhash64(column), F.lit(FILTER_WORDS * 64))
    bit = F.expr("shiftleft(1L, cast(_at & 63 as int))")
    return values.select(at.alias("_at")).groupBy(F.shiftright("_at", 6).alias("_word")).agg(F.bit_or(bit).alias("_set"))


def _sifted(df: DataFrame, column: str, bits: DataFrame) -> DataFrame:
    """The rows whose value may be among those of ``bits``; a join that follows decides. It only saves moving the others."""
    at = df.withColumn("_at", F.pmod(F.xxhash64(column), F.lit(FILTER_WORDS * 64))).withColumn("_word", F.shiftright("_at", 6))
    met = at.join(F.broadcast(bits), "_word")  # at most FILTER_WORDS rows
    return met.filter("(_set & shiftleft(1L, cast(_at & 63 as int))) <> 0").drop("_at", "_word", "_set")


def cluster_blocks(classes: DataFrame, block_cost: int) -> DataFrame:
    """(code, n, first_id, cluster, block, whole) of the classes that share a key with another; ``whole`` clusters are one block."""
    held = classes.select("code", F.explode("keys").alias("key"))
    shared = materialize(held.groupBy("key").agg(F.count(F.lit(1)).alias("classes")).filter("classes > 1").select("key"), "shared-keys")
    met = materialize(_sifted(held, "key", _bits(shared, "key")).select("key", "code"), "shared-members")
    pivots = met.groupBy("key").agg(F.min("code").alias("pivot"), F.max("code").alias("other")).filter("pivot < other").select("key", "pivot")
    edges = met.join(pivots, "key").filter("code <> pivot").select(F.col("code").alias("a"), F.col("pivot").alias("b")).distinct()
    label = materialize(components(edges), "clusters")
    label = label.unionByName(label.select(F.col("root").alias("node"), "root").distinct())
    inside = classes.select("code", "n", "first_id").join(label.select(F.col("node").alias("code"), F.col("root").alias("cluster")), "code")
    inside = materialize(inside.withColumn("cost", F.col("n") + MEMBER_COST), "clustered")
    large = inside.groupBy("cluster").agg(F.sum("cost").alias("all")).filter(F.col("all") > block_cost).select("cluster")
    large = materialize(large, "large-clusters")  # few: each has more than a block's content
    columns = ["code", "n", "first_id", "cluster"]
    small = inside.select(*columns, F.lit(0).alias("block"), F.lit(True).alias("whole"))
    if large.isEmpty():
        return small
    placed = running_totals(inside.join(F.broadcast(large), "cluster", "left_semi"), [F.col("n"), F.col("code")], ["cost"], ["cluster"])
    placed = placed.select(*columns, F.expr(f"cast(cost_before div {block_cost} as int)").alias("block"), F.lit(False).alias("whole"))
    return materialize(small.join(F.broadcast(large), "cluster", "left_anti").unionByName(placed), "blocks")


def _contents(docs: DataFrame, placed: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """``placed`` with the members of each set, read from a document that has the class's first id."""
    texts = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").cast("string").alias("_text"))
    near = _sifted(texts, "_id", _bits(placed.withColumnRenamed("first_id", "_id"), "_id"))
    wanted = near.join(placed, near["_id"].eqNullSafe(placed["first_id"]))

    def make():
        def compute(found: list) -> dict:
            sets = [members(t, words) for t in found]
            return {"found": [code_of(s) for s in sets], "members": [s.view(np.int64) for s in sets]}

        return compute

    return append_columns(wanted, "_text", make, "found long, members array<long>", ["code", "cluster", "block", "whole"]).filter("found = code").drop("found")


def _labels(links: DataFrame) -> DataFrame:
    return components(links).select(F.col("node").alias("code"), F.col("root"))


def class_roots(docs: DataFrame, classes: DataFrame, id_col: str, text_col: str, words: int, percent: int, block_cost: int) -> DataFrame:
    """(code, root) of the classes that reach a smaller one over links; root is the smallest."""
    placed = cluster_blocks(classes, block_cost)
    contents = materialize(_contents(docs, placed, id_col, text_col, words), "set-members")
    first = contents.withColumn("task", F.col("block"))
    cut = placed.filter("NOT whole")
    parted = not cut.isEmpty()
    if parted:
        several = materialize(cut.groupBy("cluster").agg(F.max("block").alias("last")).filter("last > 0"), "parted")
        # the first block goes to the tasks of all others of its cluster
        again = contents.filter("block = 0 AND NOT whole").join(several, "cluster").withColumn("task", F.explode(F.sequence(F.lit(1), "last")))
        first = first.unionByName(again.drop("last"))
    links = materialize(_tree_links(first.withColumn("root", F.col("code")), percent), "tree-links")
    done = links.filter("whole").select(F.col("a").alias("code"), F.col("b").alias("root"))
    if not parted:
        return done
    label = materialize(_labels(links.filter("NOT whole")), "first-labels")
    paired = several.filter("last > 1")
    if paired.isEmpty():
        return done.unionByName(label)
    rooted = cut.join(paired, "cluster", "left_semi").filter("block > 0").join(label, "code", "left").withColumn("root", F.coalesce("root", "code"))
    rooted = materialize(rooted, "rooted")
    blocks = rooted.groupBy("cluster", "block").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.min("root").alias("r0"), F.max("root").alias("r1"))
    other = blocks.select(*(F.col(c).alias(f"{c}_") for c in blocks.columns))
    near = (F.col("cluster") == F.col("cluster_")) & (F.col("block") < F.col("block_")) & (F.col("low_") * percent <= F.col("high") * 100)
    joined = (F.col("r0") == F.col("r1")) & (F.col("r0_") == F.col("r1_")) & (F.col("r0") == F.col("r0_"))
    pairs = materialize(blocks.join(other, near).filter(~joined).select("cluster", "block", "block_", F.monotonically_increasing_id().alias("task")), "block-pairs")
    if pairs.isEmpty():
        return done.unionByName(label)
    sides = pairs.select("cluster", "block", "task").unionByName(pairs.select("cluster", F.col("block_").alias("block"), "task"))
    second = contents.join(sides, ["cluster", "block"]).join(rooted.select("code", "root"), "code")
    more = materialize(_tree_links(second, percent), "tree-links").select("a", "b")
    return done.unionByName(_labels(more.unionByName(label.select(F.col("code").alias("a"), F.col("root").alias("b")))))


def similar_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS, percent: int = PERCENT, block_cost: int = BLOCK_COST,
) -> DataFrame:
    """(id, n_shingles, component_id) of every document."""
    found = materialize(sets_of(docs, id_col, text_col, words, percent), "sets")
    classes = found.filter("n_shingles > 0").groupBy("code").agg(F.min(id_col).alias("first_id"), F.first("n_shingles").alias("n"), F.first("keys").alias("keys"))
    classes = materialize(classes, "classes")
    roots = class_roots(docs, classes, id_col, text_col, words, percent, block_cost)
    rooted = classes.select("code", "first_id").join(roots, "code", "left").withColumn("root", F.coalesce("root", "code"))
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    label = rooted.select("code", "root").join(smallest, "root").select("code", "component_id")
    out = found.select(id_col, "n_shingles", "code").join(label, "code", "left")
    alone = F.when(F.col("n_shingles") == 0, F.col(id_col)).otherwise(F.col("component_id"))
    return out.select(id_col, "n_shingles", alone.alias("component_id"))
