"""Rounds of the connected components, and which links need them."""
import random

import pytest

from conftest import prose
from stayflow.llm import components as rounds, jaccard


def least_reachable(links):
    near = {}
    for a, b in links:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    out = {}
    for start in sorted(near):
        todo = [] if start in out else [start]
        while todo:
            node = todo.pop()
            if out.setdefault(node, start) == start:
                todo += [x for x in near[node] if x not in out]
    return {n: r for n, r in out.items() if n != r}


def written(monkeypatch, module):
    tags = []
    kept = module.materialize
    monkeypatch.setattr(module, "materialize", lambda df, tag: tags.append(tag) or kept(df, tag))
    return tags


def graphs():
    rng = random.Random(5)
    chain = list(range(40))
    rng.shuffle(chain)
    return {
        "stars": [(i, i % 3) for i in range(3, 30)],
        "line": [(i + 1, i) for i in range(33)],
        "shuffled": list(zip(chain, chain[1:])) + [(90, 90), (91, 90), (90, 91), (91, 90)],
        "mixed": [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(rng.randrange(100, 130), 117) for _ in range(40)] + [(-5, None), (-7, -6)],
        "none": [],
    }


@pytest.mark.parametrize("name", graphs())
def test_every_node_reaches_its_least(spark, name):
    links = graphs()[name]
    found = rounds.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert len(found) == len({r.node for r in found})
    assert {r.node: r.root for r in found} == least_reachable([(a, b) for a, b in links if b is not None and a != b])


def test_links_that_are_stars_need_no_round(spark, monkeypatch):
    tags = written(monkeypatch, rounds)
    rounds.components(spark.createDataFrame(graphs()["stars"], "a long, b long"))
    assert tags == ["star"]


def test_trees_are_shortened_by_one_join_a_round(spark, monkeypatch):
    monkeypatch.setattr(rounds, "_small_star", None)  # a node with one smaller neighbour needs no star rounds
    found = rounds.components(spark.createDataFrame(graphs()["line"], "a long, b long"))
    assert {r.node: r.root for r in found.collect()} == {i: 0 for i in range(1, 34)}


def near_texts(count):
    """Texts of which each differs from the one before in two words: the ends of the row are not alike."""
    words = prose(11, 200).lower().strip(".").split()
    out = []
    for i in range(count):
        out.append(" ".join(words))
        words[10 * i + 5] = f"changed{i}"
    return out


@pytest.mark.parametrize("block_cost, once", [(jaccard.BLOCK_COST, True), (1000, False)])
def test_groups_of_a_cluster_in_one_block_are_not_joined_over_tasks(spark, monkeypatch, block_cost, once):
    calls = []
    kept = jaccard.components
    monkeypatch.setattr(jaccard, "components", lambda links: calls.append(1) or kept(links))
    rows = [(100 - i, t) for i, t in enumerate(near_texts(12))] + [(i, prose(i, 50)) for i in range(5)]
    found = jaccard.similar_documents(spark.createDataFrame(rows, "doc_id long, text string"), block_cost=block_cost)
    assert {r.doc_id: r.component_id for r in found.collect()} == {i: i for i in range(5)} | {100 - i: 89 for i in range(12)}
    assert (len(calls) == 1) == once  # for the clusters; again only for groups over blocks


def test_stars_of_a_tree_have_the_least_place():
    assert jaccard.least_reached([(3, 2), (4, 3), (2, 1), (6, 5)], 8).tolist() == [0, 1, 1, 1, 1, 5, 5, 7]
