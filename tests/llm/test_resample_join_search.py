"""Importance resampling, the signature-tree join and ranked search against plain versions."""
import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from stayflow.llm import importance, jaccard, lexical
from stayflow.llm.terms import TERMS, WORDS, gram_runs, word_runs
from tests_llm_words import brute_terms, brute_words, prose

TARGET = [(1, "spam eggs ham"), (2, None), (3, "..."), (1, "日本語 Spam"), (None, prose(2, 30)), (4, "spam eggs ham"), (5, "two One")]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(TARGET, "item_id long, text string")


@pytest.mark.parametrize("size", [1, 7, 1 << 20])
def test_runs_give_the_words_of_the_whole_text(size):
    for text in (None, "", " \t\n", "One", "a b", prose(4, 50), "x" * 40 + " y", "Ünï\x0bcödé ☃ 9 a-b\x00c"):
        for table, brute in ((TERMS, brute_terms), (WORDS, brute_words)):
            expect = [w.encode() for w in brute(text)]
            assert [w for run in word_runs(text, table, size) for w in run] == expect
            grams = [b" ".join(expect[i : i + 3]) for i in range(len(expect) - 2)] or ([b" ".join(expect)] if expect else [])
            assert [g for run in gram_runs(text, table, 3, size) for g in run] == grams


def brute_resample(rows, target, buckets=10_000, percent=10):
    bucket = lambda w: zlib.crc32(w.encode()) % buckets
    source, wanted = Counter(), Counter()
    for _, text in rows:
        source.update(map(bucket, brute_terms(text)))
    for _, text in target:
        wanted.update(map(bucket, brute_terms(text)))
    big_s, big_t = sum(source.values()), sum(wanted.values())
    gain = {b: math.floor(1000 * math.log((wanted[b] + 1) * (big_s + buckets) / ((source[b] + 1) * (big_t + buckets)))) for b in source}
    out = []
    for i, text in rows:
        w = brute_terms(text)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(x)] for x in w)
        out.append((i, len(w), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    may = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    drawn = Counter()
    ranks = []
    for rank, r in enumerate(may[: len(may) * percent // 100], 1):
        ranks.append((*r, rank))
        drawn[r] += 1
    for r in out:
        if drawn[r]:
            drawn[r] -= 1
        else:
            ranks.append((*r, None))
    return sorted(ranks, key=str)


def test_resampling_equals_plain_sort(spark, odd, docs, items):
    for frame in (odd, docs):
        rows = [tuple(r) for r in frame.select("doc_id", "text").collect()]
        found = importance.resample(frame, items)
        assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
        assert sorted(map(tuple, found.collect()), key=str) == brute_resample(rows, TARGET)


def test_no_documents_no_target(spark, odd, none, items):
    assert importance.resample(none, items).collect() == []
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    found = importance.resample(odd, items.limit(0), percent=50)
    assert sorted(map(tuple, found.collect()), key=str) == brute_resample(rows, [], percent=50)


def test_bracket_is_widened_until_it_holds_the_cut(spark):
    scores = spark.range(20_000).selectExpr("id as doc_id", "1L as n_features", "0L as weight", "20L as n_words", "case when id % 3 = 0 then 7L else pmod(xxhash64(id), 100000) end as score")
    plain = sorted(((r.score, r.doc_id) for r in scores.collect()), key=lambda x: (-x[0], x[1]))
    cut, tries = importance.bracket(scores.select("score"), 2000, 20_000, sketch=16, spread=1e-9)
    assert tries > 0 and cut.low <= plain[1999][0] <= cut.high and cut.above <= 2000
    for percent in (10, 80, 100):  # 80: the cut lies in scores that a third of the rows share
        drawn = importance.draw(scores, percent=percent, sketch=16, spread=1e-9).filter("rank is not null").orderBy("rank").collect()
        assert [(r.score, r.doc_id) for r in drawn] == plain[: 200 * percent] and [r["rank"] for r in drawn] == list(range(1, 200 * percent + 1))


def test_longer_runs_are_features(spark):
    frame = spark.createDataFrame([(1, "a b c"), (2, "a")], "doc_id long, text string")
    counted = {r["bucket"]: r["n"] for r in importance.bucket_counts(frame, longest=2).collect()}
    assert counted == Counter(zlib.crc32(w) % 10_000 for w in (b"a", b"b", b"c", b"a b", b"b c", b"a"))


def brute_set(text):
    w = brute_words(text)
    return frozenset(" ".join(w[i : i + 3]) for i in range(len(w) - 2)) if len(w) > 2 else frozenset([" ".join(w)] if w else [])


def brute_components(rows, percent=90):
    sets = [brute_set(t) for _, t in rows]
    group = list(range(len(rows)))
    find = lambda i: i if group[i] == i else find(group[i])
    for i in range(len(rows)):
        for j in range(i):
            small, large = sorted((len(sets[i]), len(sets[j])))
            if small and 100 * small >= percent * large:
                common = len(sets[i] & sets[j])
                if 100 * common >= percent * (small + large - common):
                    a, b = sorted((find(i), find(j)))
                    group[b] = a
    least: dict = {}
    for i, (doc, _) in enumerate(rows):
        least.setdefault(find(i), []).append(doc)
    least = {g: min((x for x in ids if x is not None), default=None) for g, ids in least.items()}
    return sorted(((doc, len(sets[i]), least[find(i)]) for i, (doc, _) in enumerate(rows)), key=str)


def family(seed: int, copies: int, length: int, edits: int) -> list[str]:
    """Copies of a text with some words replaced: near the threshold, on both sides."""
    rng = random.Random(seed)
    base = prose(seed, length).split()
    out = []
    for _ in range(copies):
        words = list(base)
        for at in rng.sample(range(length), rng.randint(0, edits)):
            words[at] = f"w{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("block_cost", [jaccard.BLOCK_COST, 3000])
def test_join_equals_all_pairs(spark, odd, block_cost):
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    passage = prose(90, 70)
    texts = [t for seed in range(4) for t in family(seed, 12, 40 + 90 * seed, 2 + 4 * seed)]
    texts += [f"{passage} {prose(200 + i, 12)}" for i in range(40)]  # much in common, but not enough
    texts += [prose(300 + i, 2) for i in range(5)] + ["a b c", "a b", "A  b", "c b a"]
    rows += [(100 + i, t) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = jaccard.similar_documents(frame, block_cost=block_cost)
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, found.collect()), key=str) == brute_components(rows)


def test_join_of_given_documents(spark, odd, none, docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert sorted(map(tuple, jaccard.similar_documents(docs).collect()), key=str) == brute_components(rows)
    assert jaccard.similar_documents(none).collect() == []


@pytest.mark.parametrize("percent", [50, 80, 90, 97])
def test_linked_sets_share_a_key(percent):
    """Sets at the threshold, of all sizes and with any difference, agree in a part."""
    rng = np.random.default_rng(percent)
    for n in [*range(1, 60), 100, 333, 2000]:
        for _ in range(6):
            base = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64) if n != 40 else rng.integers(0, 50, n, dtype=np.uint64) << np.uint64(40))
            most = int(len(base) * (100 - percent) / 100)
            less = np.sort(rng.permutation(base)[: len(base) - rng.integers(0, most + 1)])
            swap = max(0, (100 * len(less) - percent * len(base)) // (100 + percent))
            other = np.unique(np.concatenate([less[: len(less) - swap], rng.integers(0, 2**63, swap, dtype=np.uint64)]))
            common = len(np.intersect1d(base, other))
            if 100 * common >= percent * (len(base) + len(other) - common) and not np.array_equal(base, other):
                assert set(jaccard.part_keys(base, percent)) & set(jaccard.part_keys(other, percent))
    ends = jaccard.size_ranges(percent, 5000)
    place = {n: next(i for i, e in enumerate(ends) if n <= e) for n in range(1, 3000)}
    assert all(place[-(-percent * n // 100)] >= place[n] - 1 for n in place)


def test_bit_tables_let_no_partner_go(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "FILTER_WORDS", 2)
    left = spark.createDataFrame([(i,) for i in range(500)] + [(None,)], "v long")
    right = spark.createDataFrame([(i,) for i in range(0, 60, 3)] + [(None,)], "v long")
    bits = jaccard._bits(right, "v")
    assert bits.count() <= 2
    kept = {r.v for r in jaccard._sifted(left, "v", bits).collect()}
    assert {r.v for r in right.collect()} <= kept and len(kept) < 500


def test_tree_keeps_every_link():
    rng = np.random.default_rng(3)
    base = [rng.integers(0, 2**63, 300, dtype=np.uint64) for _ in range(6)]
    sets = [np.unique(np.concatenate([b[rng.random(300) > cut], rng.integers(0, 2**63, 20, dtype=np.uint64)])) for b in base for cut in np.linspace(0, 0.1, 25)]
    tree = jaccard.SignatureTree(np.concatenate(sets), np.cumsum([len(s) for s in sets]), 80)
    assert len(tree.levels) > 1
    root = list(range(len(sets)))
    find = lambda i: i if root[i] == i else find(root[i])
    for a, b in tree.links(np.arange(len(sets))):
        assert len(np.intersect1d(sets[a], sets[b])) * 180 >= 80 * (len(sets[a]) + len(sets[b]))
        root[find(a)] = find(b)
    for i in range(len(sets)):
        for j in range(i):
            common = len(np.intersect1d(sets[i], sets[j]))
            if 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
                assert find(i) == find(j)


def test_one_large_group_over_many_blocks(spark):
    """Near copies of one text, in many blocks, end as one group without the second round's pairs."""
    rows = list(enumerate(family(7, 400, 120, 2)))
    found = jaccard.similar_documents(spark.createDataFrame(rows, "doc_id long, text string"), block_cost=10_000)
    assert {r.component_id for r in found.collect()} == {0}


def brute_search(rows, items, top=10):
    terms = [brute_terms(t) for _, t in rows]
    n_docs, total = sum(bool(w) for w in terms), sum(map(len, terms))
    df = Counter(t for w in terms for t in set(w))
    out = []
    for item, text in items:
        scored = []
        for (doc, _), w in zip(rows, terms):
            if w:
                tf, m = Counter(w), 10 + 90 * len(w) * n_docs // total
                score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 8 * m)) for t in set(brute_terms(text)) if tf[t])
                if score > 0:
                    scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, doc, -score) for rank, (score, _, _, doc) in enumerate(sorted(scored, key=lambda x: x[:3])[:top], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("block_bytes", [lexical.BLOCK_BYTES, 40])
def test_search_equals_plain_scores(spark, odd, docs, items, block_bytes):
    ties = spark.createDataFrame([(500 - i, "ham and one more") for i in range(30)], "doc_id long, text string")
    for frame in (odd.select("doc_id", "text").unionByName(ties).repartition(5), docs.select("doc_id", "text")):
        rows = [tuple(r) for r in frame.collect()]
        found = lexical.search(frame, items, block_bytes=block_bytes, doc_tile=7)
        assert found.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted(map(tuple, found.collect()), key=str) == brute_search(rows, TARGET)


def test_small_tiles_add_up(spark, docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()][:60]
    items = [(i, t) for i, t in rows[:9]]
    terms = [(i, sorted({w.encode() for w in brute_terms(t)})) for i, t in items]
    block = lexical.Block(terms)
    counts = [block.counts(t) for _, t in rows]
    n_docs, total = sum(n > 0 for n, _, _ in counts), sum(n for n, _, _ in counts)
    holding = np.bincount(np.concatenate([t for _, t, _ in counts]), minlength=len(block.vocabulary))
    for item_tile, term_tile in ((2, 13), (128, 2048)):
        tiles = lexical.Tiles(block, lexical.term_weights(n_docs, holding), 4, item_tile, term_tile)
        for a in range(0, len(rows), 16):
            part = counts[a : a + 16]
            tiles.add(
                np.array([i for i, _ in rows[a : a + 16]]), np.zeros(len(part), bool), np.repeat(np.arange(len(part)), [len(t) for _, t, _ in part]),
                np.concatenate([t for _, t, _ in part]), np.concatenate([lexical.impacts(n, tf, n_docs, total) for n, _, tf in part]),
            )
        got = tiles.result()
        found = [(int(i), int(d), int(s)) for i, d, s in zip(*(c.to_pylist() for c in got.columns))]
        assert sorted(found) == sorted((i, d, s) for i, _, d, s in brute_search(rows, items, 4))


def test_nothing_to_search(spark, odd, none, items):
    assert lexical.search(none, items).collect() == [] and lexical.search(odd, items.limit(0)).collect() == []
    assert lexical.search(odd, items.filter("item_id = 3")).collect() == []
