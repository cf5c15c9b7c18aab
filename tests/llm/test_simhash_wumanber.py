"""SimHash groups against all pairs; contamination against plain search."""
import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from stayflow.llm import simhash, wumanber
from stayflow.llm.components import components


def brute_print(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if h and 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(prints, max_bits=2):
    """Smallest reachable position of each fingerprint."""
    group = list(range(len(prints)))
    find = lambda i: i if group[i] == i else find(group[i])
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= max_bits:
                a, b = sorted((find(i), find(j)))
                group[b] = a
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize("leaf_rows", [4096, 3])
def test_groups_equal_all_pairs(spark, odd, docs, leaf_rows):
    for frame in (odd, docs):
        rows = [(r.doc_id, brute_print(r.text) if len(r.text or "") < 50_000 else simhash.fingerprint(r.text)) for r in frame.select("doc_id", "text").collect()]
        group = brute_groups([p for _, p in rows])
        least = defaultdict(list)
        for (i, _), g in zip(rows, group):
            least[g].append(i)
        expect = sorted(((i, f"{p:016x}", min((x for x in least[g] if x is not None), default=None)) for (i, p), g in zip(rows, group)), key=str)
        assert sorted((tuple(r) for r in simhash.near_duplicates(frame, leaf_rows=leaf_rows).collect()), key=str) == expect


def test_dense_nodes(spark):
    """A node whose fingerprints differ in few bits is refined and searched without losing a link."""
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 3, dtype=np.uint64)
    codes = {int(b) ^ int(sum(1 << int(x) for x in rng.choice(24, rng.integers(0, 5), replace=False))) for b in base for _ in range(400)}
    codes = sorted(codes)
    frame = spark.createDataFrame([(simhash.signed(c),) for c in codes], "fp long")
    root = {r.node: r.root for r in components(simhash.fingerprint_links(frame, leaf_rows=50)).collect()}
    found = [root.get(simhash.signed(c), simhash.signed(c)) for c in codes]
    group = brute_groups(codes)
    assert len(set(zip(found, group))) == len(set(found)) == len(set(group))


def test_gray_neighbours_differ_in_one_bit():
    n = np.arange(1024, dtype=np.uint64)
    order = np.argsort(simhash.gray_rank(n))
    assert (np.bitwise_count(n[order][1:] ^ n[order][:-1]) == 1).all()


def test_chains_become_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000 + i, 900) for i in range(50)] + [(7, 7), (2, 1)], "a long, b long")
    root = {r.node: r.root for r in components(links).collect()}
    assert root == {**{i: 0 for i in range(1, 301)}, **{1000 + i: 900 for i in range(50)}}


def test_one_of_each_group_stays(odd, none, docs):
    for frame in (odd, docs, none):
        kept = simhash.keep_one(frame)
        assert kept.columns == frame.columns
        groups = simhash.near_duplicates(frame).select("component_id").distinct().count()
        rows = kept.collect()
        assert len(rows) == groups and {tuple(r) for r in rows} <= {tuple(r) for r in frame.collect()}
    assert {r.doc_id for r in simhash.keep_one(odd).collect()} == {1, 4, 6, 7, 8, 9, 10, 11, 12}


def brute_hits(text, items):
    word = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    w, hit, found = word(text), set(), set()
    for item, body in items:
        b = word(body)
        n = min(13, len(b))
        windows = {tuple(b[i : i + n]) for i in range(len(b) - n + 1)} if n else set()
        for i in range(len(w) - n + 1):
            if tuple(w[i : i + n]) in windows:
                hit.update(range(i, i + n))
                found.add(item)
    listed = sorted(str(i) for i in found if i is not None)
    return len(w), len(hit), len(listed), hashlib.sha256(",".join(listed).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)


@pytest.mark.parametrize("block_bytes", [8 << 20, 60])
def test_contamination_equals_plain_search(spark, odd, block_bytes):
    passage = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"
    items = [(1, passage), (1, passage), (2, "One TWO"), (3, None), (4, "..."), (None, "eggs"), (5, "日本語 spam"), (20, "spam eggs"), (3, "x" * 200_000)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    extra = [(20, f"Before, {passage.upper()}! after"), (21, "alpha " + passage[:60]), (22, " ".join([passage, "pad " * 500])), (23, (passage + " ") * 3)]
    rows = odd.select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id long, text string")).filter("doc_id <> 6")
    found = wumanber.contamination(rows, benchmark, block_bytes=block_bytes).drop("items").collect()
    expect = [(r.doc_id, *brute_hits(r.text, items)) for r in rows.collect()]
    assert sorted(map(tuple, found), key=str) == sorted(expect, key=str)
    kept = wumanber.decontaminate(rows, benchmark, block_bytes=block_bytes)
    assert kept.columns == rows.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(e[0] for e in expect if not e[-1])


def test_an_index_is_small_and_finds_every_window():
    """A full block: arrays of bounded size, the same hits as plain search."""
    import pickle
    import random

    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(30_000)]
    pieces = [(str(i), " ".join(rng.choice(vocabulary) for _ in range(300)).encode()) for i in range(1000)]
    index = wumanber.Index(pieces)
    assert len(pickle.dumps(index)) < 40 << 20
    for i in rng.sample(range(1000), 20):
        body = pieces[i][1].decode().split()
        at = rng.randrange(200)
        text = "before " + " ".join(body[at : at + 20]) + " after " + " ".join(body[at : at + 12])
        n, hit, items = index.search(text)
        assert n == 34 and items == {str(i)} and hit.tolist() == [False] + [True] * 20 + [False] * 13
    assert index.search(None)[0] == 0 and not index.search(" ".join(rng.choice(vocabulary) for _ in range(5000)))[2]


def test_no_benchmark_no_documents(spark, odd, none):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    assert not any(r.contaminated for r in wumanber.contamination(odd, benchmark).collect())
    assert wumanber.contamination(none, benchmark).count() == 0 and wumanber.decontaminate(odd, benchmark).count() == odd.count()
