"""Sketches, guarded writes, checked loads, reruns, bucketed tables and cohorts as text."""
import math
import random

import pytest
from pyspark.sql import functions as F

from stayflow.operators import categorical as ca, cohort as co, sketches as sk
from stayflow.session import new_folder
from stayflow.sources import files, guarded

SNAPSHOT = "chc_id long, dt int, drform string, product string, pending_drform string, vol_pend_disco string, pending_mover string, tenure int"


@pytest.fixture(scope="module")
def snapshot(spark):
    rng = random.Random(3)
    rows = [
        (c, m, rng.choice(["ACTIVE"] * 9 + ["LAPSED"]), "AB"[c % 2], None, "Y" if rng.random() < 0.1 else None, "FALSE" if rng.random() < 0.1 else None, c % 60)
        for c in range(400) for m in (201811, 201812, 201901, 201902)
    ]
    rows += [(None, 201811, "ACTIVE", "A", None, None, None, 5), (7, 201812, "ACTIVE", "B", None, "Y", None, 7)]
    return spark.createDataFrame(rows, SNAPSHOT)


RULES = co.CohortRules(products=("A", "B"), product_col="product")


def test_merged_sketches_describe_the_whole(spark):
    rng = random.Random(1)
    rows = [(m, rng.choice("ab"), None if rng.random() < 0.1 else float("nan") if rng.random() < 0.05 else rng.gauss(1e9, 1), None) for m in range(6) for _ in range(3000)]
    df = spark.createDataFrame(rows, "dt int, grp string, x double, void double")
    found = {r["grp"]: r for r in sk.describe_sketches(sk.number_sketches(df, ["x", "void"], ["dt", "grp"], 512), ["grp"]).filter("feature = 'x'").collect()}
    for g in "ab":
        values = sorted(x for _, k, x, _ in rows if k == g and x is not None and not math.isnan(x))
        mean = sum(values) / len(values)
        sd = math.sqrt(sum((v - mean) ** 2 for v in values) / (len(values) - 1))
        assert found[g]["n"] == len(values) and found[g]["min"] == values[0] and found[g]["max"] == values[-1]
        assert abs(found[g]["mean"] - mean) < 1e-6 and abs(found[g]["sd"] - sd) < 1e-6
        for name, p in sk.DESCRIBE.items():
            rank = sum(v <= found[g][name] for v in values) / len(values)
            assert abs(rank - p) < 4 * sk.rank_error(512)
    void = sk.describe_sketches(sk.number_sketches(df, ["void"])).first()
    assert void["n"] == 0 and void["p50"] is None and void["missing_pct"] == 100 and void["mean"] is None
    assert sk.describe_sketches(sk.number_sketches(df.limit(0), ["x"], ["grp"]), ["grp"]).collect() == []


def test_sketches_take_no_values_through_a_shuffle(spark):
    df = spark.range(1000).selectExpr("cast(id % 3 as int) as dt", "cast(id as double) as x").repartition(4)
    plan = sk.number_sketches(df, ["x"], ["dt"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_kll_sketch_agg_double" in plan and plan.count("Exchange hashpartitioning") == 1


def test_small_groups_are_exact_and_rank_errors_told(spark):
    df = spark.createDataFrame([(float(i % 7),) for i in range(100)], "x double")
    found = sk.describe_sketches(sk.number_sketches(df, ["x"]))
    assert sk.rank_errors(df, found, ["x"]).agg(F.max("error")).first()[0] == 0
    wrong = found.withColumn("p50", F.lit(6.0))
    told = {r["p"]: r["error"] for r in sk.rank_errors(df, wrong, ["x"]).collect()}
    assert told["p50"] == pytest.approx(0.36)  # 86 of 100 values lie below the sixes


def test_cohort_sizes_from_key_sketches(spark, snapshot):
    conditions = {"eligible": "drform = 'ACTIVE' AND product IN ('A','B')", "left": RULES.leaves, "clean": f"({RULES.clean}) AND drform = 'ACTIVE'"}
    stored = sk.key_sketches(snapshot, "chc_id", conditions)
    got = {r["measure"]: r["customers"] for r in sk.cohort_estimates(stored, 201811, [201812, 201901, 201902]).collect()}
    known = snapshot.filter("chc_id IS NOT NULL")
    assert got["left"] == co.positives(known, 201811, RULES).count() and got["stayed"] == co.negatives(known, 201811, RULES).count()
    assert got["eligible"] == co.eligible(known, 201811, RULES).count() and got["lost_sight_of"] + got["left"] == got["eligible"]
    nobody = {r["measure"]: r["customers"] for r in sk.cohort_estimates(stored, 201811, [201903]).collect()}
    assert nobody["left"] == 0 and nobody["stayed"] == 0 and nobody["lost_sight_of"] == got["eligible"]


def test_cohorts_as_text_equal_cohorts_as_frames(spark, snapshot):
    from stayflow.operators import cohort_text as ct

    snapshot.createOrReplaceTempView("stayflow_text_test")
    for made, kept in ((ct.train_cohort, co.train_cohort), (ct.holdout_cohort, co.holdout_cohort), (ct.score_cohort, co.score_cohort)):
        for atts, segment in ((["tenure", "product"], "tenure > 10"), ("*", None), ((), None)):
            text, frame = made(spark, "stayflow_text_test", 201811, RULES, atts, segment), kept(snapshot, 201811, RULES, atts, segment)
            assert text.columns == frame.columns
            assert sorted(map(str, text.collect())) == sorted(map(str, frame.collect()))
    tricky = co.CohortRules(products=("A' OR 1=1 --",), product_col="product")
    assert ct.score_cohort(spark, "stayflow_text_test", 201811, tricky, ()).count() == 0


def test_guards_are_part_of_the_write(spark, snapshot):
    cohort = snapshot.filter("dt = 201811")
    spark.sparkContext.setJobGroup("guarded", "one write")
    metrics = guarded.write_guarded(cohort, new_folder(spark, "guard"), ["chc_id"])
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("guarded")
    spark.sparkContext.setJobGroup("rest", "")
    assert metrics == {"rows": 401, "duplicates": 0, "missing_keys": 1}
    assert len(jobs) <= 2  # the shuffle's stage may be a job of its own under adaptive execution
    with pytest.raises(guarded.GuardError, match="duplicate keys") as caught:
        guarded.write_guarded(snapshot, new_folder(spark, "guard"), ["chc_id", "dt"])
    assert caught.value.metrics["duplicates"] == 1
    with pytest.raises(guarded.GuardError, match="empty"):
        guarded.write_guarded(cohort.limit(0), new_folder(spark, "guard"))


def test_rerun_replaces_its_parts_only(spark):
    path = new_folder(spark, "parts")
    first = spark.createDataFrame([(1, "a", 10), (1, "b", 11), (2, "a", 12)], "dt int, run string, v int")
    files.replace_parts(first, path, ["dt", "run"])
    for _ in range(2):
        files.replace_parts(spark.createDataFrame([(1, "a", 20)], first.schema), path, ["dt", "run"])
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == [11, 12, 20]


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_good_and_quarantined_rows_are_all_lines(spark, fmt):
    lines = {
        "csv": ["k,v,when", "1,2.5,2020-01-01", "2,oops,2020-01-01", "x,1,2020-01-01", "3,,", "4,1,2020-13-40", "5,1", "6,1,2020-01-02,extra", '7,"1",2020-02-02'],
        "json": ['{"k":1,"v":2.5,"when":"2020-01-01"}', '{"k":2,"v":"oops"}', '{"k":"x"}', '{"k":3}', '{"k":4,"when":"2020-13-40"}', '{"k":5', "[]x", '{"k":7,"v":1,"other":3}'],
    }[fmt]
    source = new_folder(spark, "source")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(source)
    schema = files.schema_of({"k": "INT64", "v": "FLOAT64", "when": "DATE"})
    good, bad = files.load_checked(spark, source, schema, new_folder(spark, "target"), fmt)
    assert good.columns == ["k", "v", "when"] and sorted(r["k"] for r in good.collect()) == [1, 3, 7]
    assert {r["line"] for r in bad.collect()} == {x for x in lines if x[:1] != "k" and not any(x.startswith(p) for p in ("1,", "3,", "7,", '{"k":1', '{"k":3', '{"k":7'))}
    report = {r["part"]: r["rows"] for r in files.quarantine_report(good, bad).collect()}
    assert sum(report.values()) == len(lines) - (fmt == "csv")


def test_bucketed_cohort_joins_without_a_shuffle(spark, snapshot):
    table = guarded.store_bucketed(snapshot, "stayflow_bucket_test", new_folder(spark, "bucketed"), "chc_id", "dt", 4)
    found = co.negatives(table, 201811, RULES)
    assert sorted(map(str, found.select(snapshot.columns).collect())) == sorted(map(str, co.negatives(snapshot, 201811, RULES).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = co.negatives(table, 201811, RULES)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    guarded.drop_stored(spark, "stayflow_bucket_test")


def test_no_group_aggregate_reaches_the_threshold(spark):
    rows = [(i, i % 2, "g" + str(i % 3), float(i), "xy"[i % 2]) for i in range(60)]
    df = spark.createDataFrame(rows, "chc_id long, status int, g string, v double, t string")
    none = ca.fit_group_features(df, ["g"], ["v"], ["t"], correlation_threshold=2.0)
    assert none == []
    cells = ca.group_feature_cells(df, none, ["chc_id"])
    assert cells.dtypes == [("chc_id", "bigint"), ("name", "string"), ("value", "double")] and cells.count() == 0
    wide = ca.group_aggregate_features(df, df, ["g"], ["v"], ["t"], correlation_threshold=2.0)
    assert wide.columns == ["chc_id"] and wide.count() == 60
