"""URL rules and list, perspective rotation, SQL of this package's queries, and the pipeline."""
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import oracle
from stayflow.llm import bands, langid, perspective, simhash, urlfilter, wumanber
from stayflow.llm.queries import ORACLES, QUERIES
from stayflow.llm.text import documents

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    got = oracle.run_spark(QUERIES[name](spark, SF_DIR))
    assert oracle.compare(got, oracle.run_sql(oracle.connect(SF_DIR), ORACLES[name])).startswith("ok")


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


URLS = [
    (1, "http://Example.ORG/en/123"), (2, "https://a.example.org/es/"), (3, "https://example.org"), (4, "http://x.com/de/1?q=/fr/"), (5, "http://com/fr/1"),
    (6, "http://notexample.org/es/1"), (7, None), (8, ""), (9, "mailto:me"), (10, "http://www.site.net:80/a/?utm_source=x&b=1#top"), (11, "https://site.net/a?b=1"),
    (12, "https://site.net/a?b=2"), (12, "https://site.net/a?b=2"), (None, "ftp://site.net/a?b=1"), (13, "http://u:p@h.org:8080/x"), (14, "x://"), (15, "http://site.net/" + "y" * 100_000),
]
EXPECTED = {
    1: ("example.org", "/en/123", "example.org/en/1", "block"), 2: ("a.example.org", "/es/", "example.org/es/", "block"), 3: ("example.org", "", None, "allow"),
    4: ("x.com", "/de/1", "com/de/", "block"), 5: ("com", "/fr/1", "com/fr/", "allow"), 6: ("notexample.org", "/es/1", "org/", "allow"), 7: ("", "", None, "allow"),
    8: ("", "", None, "allow"), 9: ("", "", None, "allow"), 10: ("www.site.net:80", "/a/", None, "block"), 11: ("site.net", "/a", None, "block"),
    12: ("site.net", "/a", None, "allow"), None: ("site.net", "/a", None, "block"), 13: ("u:p@h.org:8080", "/x", None, "allow"), 14: ("", "", None, "allow"),
}


@pytest.mark.parametrize("broadcast", [True, False])
def test_urls(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(urlfilter, "BROADCAST_BYTES", 0)
    pages = spark.createDataFrame([(i, u, "h", "k") for i, u in URLS], "page_id long, url string, host string, key string")
    listed = spark.createDataFrame([("https://site.net/a/?b=1&utm_medium=y",), ("http://example.org/en/9",), (None,), ("nothing",)], "url string")
    rows = urlfilter.judge_urls(pages, listed).collect()
    assert len(rows) == len(URLS)
    assert all((r.host, r.path, r.rule, r.verdict) == EXPECTED[r.page_id] for r in rows if r.page_id != 15)
    assert urlfilter.judge_urls(pages, listed.limit(0)).filter("listed").count() == 0
    assert urlfilter.judge_urls(pages.limit(0), listed).count() == 0


def test_bloom_filter_misses_nothing_and_lets_few_through(spark):
    keys = spark.range(0, 4000).selectExpr("concat('k', id) AS key")
    filter_, n = urlfilter.bloom_filter(keys, "key", 4000)
    asked = urlfilter.possible(spark.range(0, 24000).selectExpr("id", "concat('k', id) AS key"), "key", filter_, n)
    assert asked.filter("__possible AND id < 4000").count() == 4000
    assert asked.filter("__possible AND id >= 4000").count() < 200


TURNS = [
    (1, 0, "system", "Be kind"), (1, 1, "ann", "Hi <|im_end|>"), (1, 2, "bob", "Hello"), (1, 3, "cy", None), (1, 3, "ann", ""), (1, 3, "ann", ""), (1, None, "bob", "first"),
    (2, 0, "system", "alone"), (None, 5, "bob", "who"), (None, 6, None, "nobody"), (3, 1, "ann", "long " * 30_000),
]


def test_rotation_is_whole(spark):
    turns = spark.createDataFrame([(*t, "f") for t in TURNS], "conv_id long, turn long, role string, text string, form string")
    rows = perspective.rotate(turns).collect()
    by = {}
    for r in rows:
        by.setdefault((r.conv_id, r.perspective), []).append(r)
    assert set(by) == {(1, "ann"), (1, "bob"), (1, "cy"), (None, "bob"), (3, "ann")}
    for (conv, who), found in by.items():
        found.sort(key=lambda r: r.start)
        whole = "".join(r.message for r in found)
        assert len(found) == sum(t[0] == conv for t in TURNS)
        for r in found:
            assert whole[r.start : r.start + len(r.message)] == r.message
            assert (r.learn_start is not None) == (r.speaker == who) == (r.form == "assistant")
            if r.learn_start is not None:
                assert r.message.endswith(whole[r.learn_start : r.learn_start + r.learn_length])
                assert whole[: r.learn_start].endswith("assistant\n")
        assert found[0].message.startswith("<|im_start|>system") or conv != 1 or found[0].turn is None
    assert perspective.rotate(turns.limit(0)).count() == 0


def test_a_hot_conversation_is_spread(spark):
    """One conversation whose turns repeat or are null: many ranges, the same places."""
    rows = [(1, (None, 0, 1)[i % 3], ("ann", "bob")[i % 2], "same text") for i in range(6000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = perspective.rotate(frame)
    spread = found.withColumn("part", F.spark_partition_id()).filter("perspective = 'ann'").groupBy("part").count().collect()
    assert sum(r["count"] for r in spread) == 6000
    placed = sorted((r.start, len(r.message)) for r in found.filter("perspective = 'ann'").collect())
    assert placed[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(placed, placed[1:]))
    nulls = found.filter("perspective = 'ann' AND turn IS NULL").agg(F.max("start")).first()[0]
    assert nulls < found.filter("perspective = 'ann' AND turn = 0").agg(F.min("start")).first()[0]


def test_stages_are_their_operators(spark, docs, odd, none):
    """Each stage drops what its operator rejects on the stage's own input, and nothing else."""
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "language_id", "simhash_near_dedup", "benchmark_decontamination", "packing"]
    stages = dict(corpus_pipeline.STAGES)
    for frame in (docs, odd):
        benchmark = documents(spark, SF_DIR, "benchmark")
        keeps = {
            "quality_rules": lambda d: bands.compression_bands(d).filter("kept"),
            "language_id": lambda d: langid.identify(d, langid.learn(d)).filter("NOT ambiguous"),
            "simhash_near_dedup": lambda d: simhash.near_duplicates(d).filter("doc_id = component_id").dropDuplicates(["doc_id"]),
            "benchmark_decontamination": lambda d: wumanber.contamination(d, benchmark).filter("NOT contaminated"),
        }
        now = frame.filter("doc_id IS NOT NULL")
        for name, keep in keeps.items():
            after = stages[name](spark, now, SF_DIR)
            assert after.columns == frame.columns
            assert sorted(r.doc_id for r in after.collect()) == sorted(r.doc_id for r in keep(now).collect())
            now = after
    empty = none
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF_DIR)
    assert empty.count() == 0


def test_pipeline_runs(spark):
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert rows and len({r.doc_id for r in rows}) > 100
