"""Planted signals, seeds, halving, racing and the monthly run."""
import random

import pytest
from pyspark.sql import functions as F

from stayflow.operators import cohort as co, evaluate
from stayflow.plans import models as mo, monthly, search
from stayflow.session import new_folder

TEXTS, NUMBERS = ["area"], ["x0", "x1", "x2", "x3"]


@pytest.fixture(scope="module")
def planted(spark):
    """x0 and area say much, x1 a little, x2 and x3 nothing."""
    rng = random.Random(8)
    rows = []
    for i in range(600):
        x = [rng.gauss(0, 1) for _ in range(4)]
        area = rng.choice("abc")
        p = 1 / (1 + 2.7 ** -(2.5 * x[0] + 0.6 * x[1] + (1.5 if area == "a" else -0.5)))
        rows.append((i, int(rng.random() < p), area if i % 50 else None, *(v if i % 60 or j != 1 else None for j, v in enumerate(x))))
    return spark.createDataFrame(rows, "chc_id long, status int, area string, x0 double, x1 double, x2 double, x3 double").repartition(2).cache()


@pytest.fixture(scope="module")
def model(planted):
    return mo.train_gbt(planted, TEXTS, NUMBERS, maxIter=5, maxDepth=3)


def test_scores_find_the_signal(planted, model):
    scored = mo.score(model, planted, TEXTS, NUMBERS, ["chc_id", "status"])
    low, high, half = scored.agg(F.min("p1"), F.max("p1"), F.min("prediction_probability")).first()
    assert 0 <= low < high <= 1 and half >= 0.5 and scored.filter("predicted_label <> cast(p1 >= 0.5 as int)").count() == 0
    assert evaluate.roc_auc(scored, "p1", "status").first()["auc"] > 0.8
    again = mo.score(mo.train_gbt(planted, TEXTS, NUMBERS, maxIter=5, maxDepth=3), planted, TEXTS, NUMBERS, ["chc_id", "status"])
    assert {r["chc_id"]: r["p1"] for r in scored.collect()} == {r["chc_id"]: r["p1"] for r in again.collect()}


def test_gains_sum_to_one_and_rank_the_signal_first(planted, model):
    rows = mo.feature_importance(model, planted, TEXTS, NUMBERS).orderBy("ranking").collect()
    assert sum(r["gain"] for r in rows) == pytest.approx(1) and rows[0]["feature"] == "x0"
    assert [r["ranking"] for r in rows] == list(range(1, len(rows) + 1)) and [r["gain"] for r in rows] == sorted((r["gain"] for r in rows), reverse=True)


def test_mean_gains_over_folds(planted):
    mean = mo.kfold_importance(planted, TEXTS, NUMBERS, k=2, maxIter=3, maxDepth=2).collect()
    assert sum(r["ranking_metric_gain"] for r in mean) == pytest.approx(1) and mean[0]["feature"] == "x0"


def test_every_split_is_scored(planted):
    from stayflow.operators.sampling import stratified_split

    found = {r["scored_on"]: r["auc"] for r in mo.split_metrics(mo.score_splits(stratified_split(planted), TEXTS, NUMBERS, maxIter=3, maxDepth=3)).collect()}
    assert set(found) == {"sample", "train", "test", "all"} and all(0.7 < a <= 1 for a in found.values())


def test_segments_partition_the_customers(planted):
    fitted, leaves, rules = mo.segment_tree(planted, TEXTS, NUMBERS, depth=3)
    rows = leaves.collect()
    assert sum(r["n"] for r in rows) == 600 and 2 <= len(rows) <= 8 and "If" in rules
    assert max(r["rate"] for r in rows) - min(r["rate"] for r in rows) > 0.4


def test_full_sizes_of_the_searches():
    assert len(search.grid_settings()) == 768 == len({search._spelled(s) for s in search.grid_settings()})
    drawn = search.drawn_settings(draws=50, seed=3)
    assert len({search._spelled(s) for s in drawn}) == 50 and drawn == search.drawn_settings(draws=50, seed=3)


def test_halving_goes_on_where_it_stopped(spark, planted, monkeypatch):
    settings = search.grid_settings({"maxDepth": [1, 3], "maxIter": [3, 6], "stepSize": [0.001, 0.3]})
    log = new_folder(spark, "log")
    best, table = search.halving_search(planted, TEXTS, NUMBERS, settings, budgets=(2, None), keep=0.5, k=2, log=log)
    rows = table.collect()
    assert sorted(r["rung"] for r in rows).count(0) == 4  # equal under two trees: one trial for both numbers of trees
    assert len(rows) == 4 + 4 and all(0 <= r["auc"] <= 1 for r in rows) and rows[0]["rung"] == 1
    assert evaluate.roc_auc(mo.score(best, planted, TEXTS, NUMBERS, ["chc_id", "status"]), "p1", "status").first()["auc"] > 0.75
    assert spark.read.parquet(log).count() == 8
    monkeypatch.setattr(search.TrialLog, "add", lambda *a: pytest.fail("a trial ran again"))
    _, again = search.halving_search(planted, TEXTS, NUMBERS, settings, budgets=(2, None), keep=0.5, k=2, log=log)
    assert [tuple(r) for r in again.collect()] == [tuple(r) for r in rows]


def test_racing_equals_the_full_loop(spark, planted):
    kw = dict(smallest=2, largest=3, k=2, maxIter=2, maxDepth=2)
    full = [tuple(r) for r in mo.backward_selection(planted, NUMBERS, **kw).collect()]
    race = [tuple(r) for r in search.racing_selection(planted, NUMBERS, **kw).collect()]
    assert [r[:2] for r in race] == [r[:2] for r in full] and all(a[2] == pytest.approx(b[2]) for a, b in zip(race, full))
    log = new_folder(spark, "race")
    quick = search.racing_selection(planted, NUMBERS, reach=0.02, log=log, **kw).collect()
    assert [r["n_features"] for r in quick] == [3, 2] and all("x0" in r["features"] for r in quick)
    assert spark.read.parquet(log).count() < 4 * 2 + 3 * 2 + 2  # those out of reach were not run to the end


@pytest.fixture(scope="module")
def months(spark):
    rng = random.Random(5)
    rows = []
    for c in range(500):
        risk = rng.random()
        for m in (202001, 202002, 202003, 202004, 202005, 202006, 202007):
            leaves = rng.random() < 0.25 * risk
            rows.append((c, m, "ACTIVE", "A", "VOLUNTARY" if leaves and m > 202001 and rng.random() < 0.5 else None, "Y" if leaves else None, None, risk * 100 + rng.gauss(0, 5), "abc"[c % 3]))
    return spark.createDataFrame(rows, "chc_id long, dt int, drform string, product string, pending_drform string, vol_pend_disco string, pending_mover string, use double, area string").cache()


RULES = co.CohortRules(products=("A",), product_col="product")


def test_monthly_run_from_stored_artefacts(spark, months):
    stored, out = new_folder(spark, "stored"), new_folder(spark, "out")
    metrics = monthly.store_model(months, 202001, RULES, ["area"], ["use"], stored, maxIter=4, maxDepth=2)
    assert metrics["duplicates"] == 0 and metrics["rows"] > 100
    for month, run in ((202003, "r1"), (202004, "r1"), (202003, "r1"), (202003, "r2")):
        monthly.run_month(months, month, RULES, stored, out, "0701", run, "2020-03-01", n=40)
    scores, targets = spark.read.parquet(f"{out}/scores"), spark.read.parquet(f"{out}/targets")
    per_run = {(r["run_month"], r["run_id"]): r["n"] for r in scores.groupBy("run_month", "run_id").agg(F.count("*").alias("n")).collect()}
    eligible = {m: co.eligible(months, m, RULES).count() for m in (202003, 202004)}
    assert per_run == {(202003, "r1"): eligible[202003], (202004, "r1"): eligible[202004], (202003, "r2"): eligible[202003]}
    assert scores.filter("trained_on <> 202001 OR length(corp_house_cust) <> 12").count() == 0
    listed = targets.filter("run_month = 202003 AND run_id = 'r1'")
    assert 0 < listed.count() <= 40 and listed.select("corp_house_cust").distinct().count() == listed.count()
    top = scores.filter("run_month = 202003 AND run_id = 'r1' AND predicted_label = 1").orderBy(F.desc("prediction_probability"), "chc_id").limit(40)
    assert {r["corp_house_cust"] for r in listed.collect()} == {r["corp_house_cust"] for r in top.collect()}


def test_lift_on_a_later_month(spark, months):
    stored = new_folder(spark, "stored")
    monthly.store_model(months, 202001, RULES, ["area"], ["use"], stored, maxIter=4, maxDepth=2)
    scored, lift = monthly.out_of_time(months, 202004, RULES, stored)
    assert scored.count() == co.eligible(months, 202004, RULES).count()
    assert evaluate.roc_auc(evaluate.flip_probability(scored)).first()["auc"] > 0.6
    assert lift.count() > 1


def test_tails_of_the_feature_tests():
    """Closed forms against numerical integration of the densities."""
    import math

    import numpy as np

    from stayflow.operators import screening as sc

    for dof in (1, 4, 30, 600):
        t = np.linspace(0, 400, 4_000_001)
        density = np.exp(math.lgamma((dof + 1) / 2) - math.lgamma(dof / 2)) / math.sqrt(dof * math.pi) * (1 + t * t / dof) ** (-(dof + 1) / 2)
        for f in (0.1, 1.0, 3.84, 12.0):
            inside = np.trapezoid(density[t <= math.sqrt(f)], t[t <= math.sqrt(f)])
            assert sc._beta_tail(dof / (dof + f), dof / 2, 0.5) == pytest.approx(1 - 2 * inside, abs=2e-4)
    assert math.erfc(math.sqrt(3.841458820694124 / 2)) == pytest.approx(0.05)


def test_p_values_belong_to_their_statistics(planted):
    from stayflow.operators import screening as sc

    rows = {r["feature"]: r for r in sc.anova_f(planted, ["x0", "x2", "x3"], p_values=True).collect()}
    assert rows["x0"]["pval_anova"] < 1e-6 < 0.001 < rows["x2"]["pval_anova"] <= 1 and rows["x0"]["ranking_anova"] == 1
    for r in rows.values():
        assert r["pval_anova"] == pytest.approx(sc._beta_tail(598 / (598 + r["anova"]), 299, 0.5))


def test_trees_give_the_rate_of_their_leaves(planted):
    from stayflow.operators import trees
    from stayflow.operators.sampling import stratified_folds

    folded = stratified_folds(planted.select("chc_id", "status", "x0", "x2"), 3)
    fitted = trees.tree_stage(trees.fit_trees(folded, ["x0", "x2"], corr_threshold=0.2))
    assert list(fitted.outputs) == ["x0"]  # x2 says nothing
    rows = fitted.apply(planted, ["status"]).groupBy("x0").agg(F.avg("status").alias("rate"), F.count("*").alias("n")).collect()
    assert 2 <= len(rows) <= 64 and all(r["x0"] == pytest.approx(r["rate"]) for r in rows) and min(r["n"] for r in rows) >= 3
    assert max(r["x0"] for r in rows) - min(r["x0"] for r in rows) > 0.5
