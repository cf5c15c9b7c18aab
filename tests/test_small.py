"""Hand-made frames: nulls, ties, unseen levels, constants, one class, duplicate keys."""
import math
import statistics

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stayflow.catalog import Catalog
from stayflow.functions import columns as fc, keys, months
from stayflow.operators import categorical as ca, cohort as co, columns as pc, evaluate as ev, numeric as nu, prep, quantiles, rules, sampling as sa, screening as sc, stats as st, trees
from stayflow.operators.ordered import global_rank, running_totals
from stayflow.plans import models


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_december_rolls_over(spark):
    assert months.next_months(201812) == [201901, 201902, 201903, 201904, 201905, 201906]
    df = spark.createDataFrame([(201812,), (201901,)], "ym int")
    assert rows(df.select(months.shift_month(F.col("ym"), 1), months.shift_month(F.col("ym"), -1))) == [(201901, 201811), (201902, 201812)]


def test_key_of_zeros(spark):
    df = spark.createDataFrame([("070100000000",), ("070100123405",)], "k string")
    parts = keys.split_key(F.col("k"))
    assert rows(df.select(*parts.values())) == [("0701", "0", "0"), ("0701", "1234", "5")]
    assert rows(df.select(keys.build_key(F.lit("0701"), F.lit(1234), F.lit(5))).limit(1)) == [("070100123405",)]


def test_pct2_rounds_half_up(spark):
    df = spark.createDataFrame([(1, 800), (1, 3), (0, 5), (1, 0)], "a long, b long")
    assert rows(df.select(fc.pct2(F.col("a"), F.col("b")))) == [(0.13,), (33.33,), (0.0,), (None,)]


def test_cut_is_right_closed_and_keeps_null(spark):
    df = spark.createDataFrame([(12.0,), (12.5,), (13.0,), (96.0,), (97.0,), (None,)], "x double")
    got = rows(df.select(fc.cut(F.col("x"), *ca.step_bins(12, 96, 1, "Months", "Under 12 Months"))))
    assert [g[0] for g in got] == ["Under 12 Months", "13 Months", "13 Months", "96 Months", "97 Months", None]


@pytest.mark.parametrize("edges_labels", [ca.step_bins(12, 96, 3, "Months", "low"), ca.change_bins(50, 5, "Dollars"), ca.change_bins(50, 10, "Dollars", 5), ca.payment_bins(25), ca.call_bins(True), ca.call_bins(False)])
def test_cut_matches_pandas(spark, edges_labels):
    edges, labels = edges_labels
    finite = [float(e) for e in edges if not math.isinf(e)]
    values = sorted({v for e in finite for v in (e, math.nextafter(e, -9e9), math.nextafter(e, 9e9), e + 0.5)})
    want = pd.cut(pd.Series(values), bins=edges, labels=labels).astype(object).where(lambda s: s.notna(), None).tolist()
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
    got = [r[1] for r in sorted(rows(df.select("i", fc.cut(F.col("x"), edges, labels))))]
    assert got == want


def test_duplicate_key_is_reported(spark):
    df = spark.createDataFrame([(1,), (2,), (2,)], "chc_id long")
    assert rows(co.duplicate_keys(df)) == [(2, 2)]
    with pytest.raises(ValueError):
        co.require_unique(df)
    with pytest.raises(ValueError):
        co.require_rows(df.filter("false"), "empty")


SNAP = "chc_id long, dt int, drform string, products string, pending_drform string, vol_pend_disco string, pending_mover string"


def test_cohort_labels(spark):
    base = [(k, 201810, "ACTIVE", "P", None, None, None) for k in (1, 2, 3, 4)] + [(5, 201810, "ACTIVE", "P", "VOLUNTARY", None, None), (None, 201811, "ACTIVE", "P", "VOLUNTARY", "Y", None)]
    future = []
    for m in (201811, 201812, 201901):
        future += [(1, m, "ACTIVE", "P", None, None, None), (2, m, "ACTIVE", "P", None, "Y" if m == 201812 else None, None)]
    future += [(3, 201811, "ACTIVE", "P", None, None, None), (4, 201901, "ACTIVE", "P", None, None, "FALSE")]
    df = spark.createDataFrame(base + future, SNAP)
    rules_ = co.CohortRules(products=["P"])
    # 3 is missing in two months: neither a leaver nor a stayer
    assert sorted(rows(co.train_cohort(df, 201810, rules_))) == [(0, 1), (1, 2), (1, 4)]
    # the null key among the leavers must not empty the negatives
    assert sorted(r[0] for r in rows(co.negatives_test(df, 201810, rules_).select("chc_id"))) == [1, 2, 3]
    assert sorted(rows(co.holdout_cohort(df, 201810, rules_))) == [(0, 1), (0, 2), (0, 3), (1, 4)]


def test_union_semantics_keep_a_key_in_both_classes(spark):
    df = spark.createDataFrame(
        [(1, 201810, "ACTIVE", "P", None, None, None)]
        + [(1, m, "ACTIVE", "P", None, None, None) for m in (201811, 201812, 201901)]
        + [(1, 201811, "ACTIVE", "P", None, "Y", None)],
        SNAP,
    )
    assert sorted(rows(co.train_cohort(df, 201810, co.CohortRules(products=["P"])))) == [(0, 1), (1, 1)]


def test_global_rank_and_totals_with_a_hot_value(spark):
    n = 3000
    df = spark.range(n).select(F.col("id"), F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.col("id") / n).alias("p"), (F.col("id") % 2).alias("w"))
    got = global_rank(df, [F.desc("p"), F.asc("id")], "r", "n").toPandas().sort_values("r")
    want = df.toPandas().sort_values(["p", "id"], ascending=[False, True])
    assert got["id"].tolist() == want["id"].tolist() and got["r"].tolist() == list(range(1, n + 1)) and set(got["n"]) == {n}
    g = running_totals(df.withColumn("g", F.lit("a")), [F.col("p"), F.col("id")], ["w"], ["g"], totals=True).toPandas().sort_values(["p", "id"])
    assert g["w_before"].tolist() == (g["w"].cumsum() - g["w"]).tolist() and set(g["w_total"]) == {n // 2}


@pytest.mark.parametrize("limit", [10, 10**6])
def test_exact_quantiles_by_narrowing(spark, limit):
    rng = np.random.default_rng(0)
    x = np.round(rng.normal(size=5000), 3)
    x[:1800] = 0.25  # one value holds over a third of the rows
    pdf = pd.DataFrame({"x": x, "y": rng.integers(0, 7, 5000).astype(float), "z": np.nan})
    probs = [0.0, 0.01, 0.1, 1 / 3, 0.5, 0.995, 1.0]
    got = quantiles.exact_quantiles(spark.createDataFrame(pdf), ["x", "y", "z"], probs, limit=limit)
    assert got["x"] == pytest.approx(np.quantile(x, probs).tolist()) and got["y"] == pytest.approx(np.quantile(pdf["y"], probs).tolist())
    assert got["z"] == [None] * len(probs)


def test_group_quantiles(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b", "hot", "hot", "hot"], 2000), "v": np.round(rng.normal(size=2000), 2)})
    got = quantiles.group_quantiles(spark.createDataFrame(pdf), ["g"], "v", {"q1": 0.25, "q5": 0.5, "q9": 0.95}).toPandas().set_index("g").sort_index()
    want = pdf.groupby("g")["v"].quantile([0.25, 0.5, 0.95]).unstack().sort_index()
    assert np.allclose(got[["q1", "q5", "q9"]].to_numpy(float), want.to_numpy())


def test_pair_correlations_match_pandas(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame(rng.normal(size=(400, 5)) * [1, 1e6, 1, 1e-4, 1] + [0, 1e9, 5, 0, 0], columns=list("abcde"))
    pdf.loc[rng.random(400) < 0.3, "a"] = np.nan
    pdf.loc[rng.random(400) < 0.2, "c"] = np.nan
    pdf["e"] = 7.0
    pdf["g"] = rng.choice(["x", "y"], 400)
    df = spark.createDataFrame(pdf)
    for part, got in [(pdf, st.pair_correlations(df, list("abcde")))] + [(pdf[pdf.g == g], st.pair_correlations(df, list("abcde"), ["g"]).filter(F.col("g") == g)) for g in "xy"]:
        want = part[list("abcde")].corr()
        for r in got.collect():
            w = want.loc[r["col_a"], r["col_b"]]
            assert (r["corr"] is None) if math.isnan(w) else r["corr"] == pytest.approx(w, abs=1e-9)
    assert got.count() == 10


def test_constant_and_all_null_columns(spark):
    df = spark.createDataFrame([(i, i % 2, 1.0, None, float(i)) for i in range(5)], "chc_id long, status int, one double, nothing double, x double")
    assert prep.drop_missing(df).dropped == ["nothing"]
    # the all-null column has no value at all, yet too much is missing for the constant rule
    assert prep.drop_constant(df).dropped == ["one"]
    assert prep.drop_zero_variance(df).dropped == ["one"]
    corr = {r["feature"]: r["corr"] for r in st.target_correlation(df, ["one", "nothing", "x"]).collect()}
    assert corr["one"] is None and corr["nothing"] is None
    assert rows(nu.standard(df, ["one", "x"]).apply(df, ["chc_id"]))[0][1] == 0.0


def test_correlation_rule_counts_dropped_columns_too():
    pairs = {frozenset("ab"): 0.95, frozenset("bc"): 0.95, frozenset("ac"): 0.5}
    assert [(d, e) for d, e, _ in prep.collinear(["a", "b", "c"], pairs, 0.9)] == [("b", "a"), ("c", "b")]
    with pytest.raises(ValueError):
        prep.drop_missing(None, 2.0)


def test_duplicate_columns(spark):
    df = spark.createDataFrame([(1, "a", "a", "b", 1.0, 1.0), (2, None, None, "b", 2.0, 2.0)], "chc_id long, p string, q string, r string, x double, y double")
    assert prep.drop_duplicate_columns(df).dropped == ["q"]
    assert prep.drop_duplicate_columns(df, numbers=True).dropped == ["q", "y"]


def test_impute_and_types(spark):
    df = spark.createDataFrame([(1, " ", "7", None), (2, "x", "bad", 3)], "chc_id long, t string, n string, c int")
    cat = Catalog({"t": "CAT", "n": "NUM", "c": "CAT"}, {"t": "UNKNOWN", "n": -1.0, "c": "none"})
    assert sorted(rows(prep.impute(df, cat))) == [(1, "UNKNOWN", 7.0, "none"), (2, "x", -1.0, "3")]


@pytest.mark.parametrize("method,seen,unseen", [("pct", 0.75, 0.0), ("count", 3.0, 0.0), ("ordinal", 0.0, 0.0), ("y_mean", 1 / 3, 0.0), ("y_log_ratio", math.log(0.5), math.log(1e-5 / (1 - 1e-5))), ("y_ratio", 0.5, 0.0)])
def test_unseen_level(spark, method, seen, unseen):
    train = spark.createDataFrame([(1, "a", 1), (2, "a", 0), (3, "a", 0), (4, "b", 1)], "chc_id long, f string, status int")
    test = spark.createDataFrame([(1, "a"), (2, "c"), (3, None)], "chc_id long, f string")
    got = dict(rows(ca.encode(test, train, ["f"], method, "status").select("chc_id", "f")))
    assert got[1] == pytest.approx(seen) and got[2] == pytest.approx(unseen) and got[3] == pytest.approx(unseen)


def test_long_code_lists_are_joined(spark, monkeypatch):
    monkeypatch.setattr(ca, "LITERAL_LEVELS", 1)
    train = spark.createDataFrame([(1, "a", 1), (2, "a", 0), (3, "b", 1)], "chc_id long, f string, status int")
    test = spark.createDataFrame([(1, "a"), (2, "c"), (3, None)], "chc_id long, f string")
    assert sorted(rows(ca.encode(test, train, ["f"], "count").select("chc_id", "f"))) == [(1, 2.0), (2, 0.0), (3, 0.0)]
    assert sorted(rows(ca.clamp_levels(test, train, ["f"]).select("chc_id", "f"))) == [(1, "a"), (2, "ALL_OTHER"), (3, "ALL_OTHER")]


def test_rare_levels(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate("aaaaabbbc")] + [(9, None)], "chc_id long, f string")
    assert {r[1] for r in rows(ca.reduce_rare(df, df, ["f"], 0.2, 20))} == {"a", "b", "all_other"}
    assert {r[1] for r in rows(ca.reduce_rare(df, df, ["f"], 0.0, 1, "common"))} == {"a"}


def test_interactions_once_per_pair():
    assert [n for n, _, _ in ca.interaction_names(["x", "y"], ["x", "y", "z"])] == ["X-y", "X-z", "Y-z"]


def test_one_class_gives_zero(spark):
    df = spark.createDataFrame([(1, 0, 0, 0.9), (2, 0, 0, 0.8)], "chc_id long, original_labels int, predicted_label int, prediction_probability double")
    r = ev.rates(ev.confusion(df)).first()
    assert (r["tpr"], r["tnr"], r["fpr"], r["accuracy"]) == (0.0, 1.0, 0.0, 1.0)
    assert ev.class_metrics(ev.confusion(df)).first()["mcc"] == 0.0
    assert ev.roc_auc(df).first()["auc"] is None


def test_ties_on_quantile_edges(spark):
    scores = [0.1] * 8 + [0.2] * 4 + [0.3] * 4 + [0.4] * 2 + [0.5] * 2
    df = spark.createDataFrame([(i, i % 2, p) for i, p in enumerate(scores)], "chc_id long, original_labels int, p double")
    want = (pd.qcut(pd.Series(scores), 10, labels=False, duplicates="drop") + 1).tolist()
    got = [r["decile"] for r in ev.with_decile(df, "p").orderBy("chc_id").collect()]
    assert got == want


def test_slices_follow_the_bounds(spark):
    for n in (23, 100, 107):
        df = spark.range(n).select(F.col("id").alias("chc_id"), (F.col("id") % 2).cast("int").alias("original_labels"), (-F.col("id")).cast("double").alias("p"))
        for k in (10, 20):
            bounds = [int(j * (n + 1) / k) for j in range(k + 1)]
            want = [len(range(n)[a:b]) for a, b in zip(bounds, bounds[1:])]
            got = {r["slice"]: r["subs"] for r in ev.lift_slices(df, k, "p").collect()}
            assert [got.get(j, 0) for j in range(k)] == want


def test_samples_are_repeatable_and_balanced(spark):
    df = spark.range(1000).select(F.col("id").alias("chc_id"), (F.col("id") % 10 == 0).cast("int").alias("status"))
    a, b = sa.downsample(df, seed=3), sa.downsample(df.repartition(5), seed=3)
    assert sorted(rows(a.select("chc_id"))) == sorted(rows(b.select("chc_id")))
    assert dict(rows(a.groupBy("status").count())) == {0: 100, 1: 100}
    folds = sa.stratified_folds(df, 3).groupBy("status", "fold").count().toPandas()
    assert folds.groupby("status")["count"].agg(lambda s: s.max() - s.min()).max() <= 1
    splits = sa.shuffle_splits(df, 2)
    assert splits.agg(F.sum("train_0"), F.sum("train_1")).first() == (800, 800)
    assert splits.filter("train_0 <> train_1").count() > 0


def test_tree_finds_a_planted_step(spark):
    rng = np.random.default_rng(5)
    x = rng.uniform(0, 10, 3000)
    y = (rng.random(3000) < np.where(x > 6, 0.8, 0.1)).astype(int)
    df = sa.stratified_folds(spark.createDataFrame(pd.DataFrame({"chc_id": range(3000), "status": y, "x": x, "noise": rng.normal(size=3000)})), 3)
    fitted = trees.tree_stage(trees.fit_trees(df, ["x", "noise"], corr_threshold=0.1, max_depth=2))
    out = fitted.apply(df.withColumnRenamed("x", "raw").withColumn("x", F.col("raw")), ["raw"]).toPandas()
    assert list(fitted.outputs) == ["x"] and out[out.raw > 6.2]["x"].min() > 0.5 > out[out.raw < 5.8]["x"].max()


def test_univariate_auc_of_signal_and_noise(spark):
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame({"chc_id": range(4000), "signal": rng.integers(0, 5, 4000), "noise": rng.integers(0, 5, 4000)})
    pdf["status"] = (rng.random(4000) < pdf["signal"] / 6).astype(int)
    df = spark.createDataFrame(pdf)
    got = {r["feature"]: r["roc_auc"] for r in sc.univariate_auc(df.filter("chc_id < 2000"), df.filter("chc_id >= 2000"), ["signal", "noise"]).collect()}
    assert got["signal"] > 0.7 and abs(got["noise"] - 0.5) < 0.05


def test_p_values(spark):
    df = spark.createDataFrame([(i, i % 2, float(i % 2) + (i % 7) / 10, float(i % 5)) for i in range(200)], "chc_id long, status int, x double, n double")
    got = {r["feature"]: r for r in sc.anova_f(df, ["x", "n"], p_values=True).collect()}
    assert got["x"]["pval_anova"] < 1e-10 and got["n"]["pval_anova"] > 0.5
    # F(1, 10) = 4.9646 is the 5 % point
    assert sc._beta_tail(10 / (10 + 4.964602743730), 5.0, 0.5) == pytest.approx(0.05, abs=1e-6)


def test_competition_and_rules(spark):
    df = spark.createDataFrame([(1, 0, "OPTIC 400/40-MBPS", "3GBPS"), (0, None, "None", None)], "f int, c int, s string, g string")
    r = df.select(
        rules.competition_label({"FIBER": F.col("f"), "COAX": F.col("c")}).alias("comp"),
        rules.parse_speed(F.col("s"), [("OPTIC ", ""), *rules.SPEED_TEXT]).alias("s"), rules.parse_speed(F.col("g")).alias("g"),
    ).collect()
    assert [tuple(x) for x in r] == [("FIBER", 400.0, 3000.0), ("NONE", 0.0, None)]


RULE_INPUT = {
    **{c: "None" for c in ["ebill_status_desc", "agent_last_dept", "ivr_last_dept", "ivr_last_interactionReason", "ivr_last_ivrInteractionEndResult", "cust_equip_class", "product_class_desc", "ecohort_income_range_desc", "metro_area_desc"]},
    **{f"ivr_repeat_{k}_{w}": "None" for k in (1, 2, 3) for w in ("prevInteractionReason", "prevDept")},
    **{f"agent_repeat_{k}_prevDept": "None" for k in (1, 2, 3)},
    **{f"service_visit_{k}_tc_{w}_code_desc": "None" for k in (1, 2, 3) for w in ("problem", "fix")},
    **{f"speed_m{k}": "200" for k in range(5)},
    **{f"{p}_m{k}": "None" for p in ("curr_video_tier_desc", "curr_ov_tier_desc", "ool_offer_group_v2_desc", "ov_offer_group_v2_desc", "video_offer_group_desc") for k in range(5)},
    **{f"{p}_m{k}": "N" for p in ("max_svod", "hbo_svod_new", "stz_enc_svod") for k in (1, 2, 3)},
    **{f"baserev_m{k}": 50.0 for k in range(7)},
    **{c: 0 for c in ["FAILSTAT_OFFLINEEVT", "FAILSTAT_DHCP_MACADDR", "FAILSTAT_WIFI_REBOOT_COUNT", "FAILSTAT_WIFI_QOE_HOME_30", "promo_rolloff_count_60day", "rate_event_count_60day"]},
    "cust_tenure_days": "400",
}


def test_rule_block(spark):
    second = dict(RULE_INPUT) | {
        "agent_last_dept": "Retention and Sales", "agent_repeat_1_prevDept": "Billing", "speed_m0": "1GBPS/35", "max_svod_m1": "y", "baserev_m0": 60.0, "rate_event_count_60day": 2,
        "curr_video_tier_desc_m0": "Core TV", "curr_video_tier_desc_m3": "Premier pack", "service_visit_1_tc_problem_code_desc": "No signal", "FAILSTAT_OFFLINEEVT": 3,
        "cust_tenure_days": None, "video_offer_group_desc_m1": "No Offer", "curr_ov_tier_desc_m2": "X", "promo_rolloff_count_60day": 4, "ivr_last_interactionReason": "Weather",
    }
    df = spark.createDataFrame([RULE_INPUT, second])
    a, b = rules.rule_block(df).orderBy("baserev_change_m6m0").collect()
    assert (a["speed_m0"], a["speed_change_m4m0"], a["video_tier_change_m4m0"], a["cust_tenure"], a["max_svod_change_m3m1"]) == ("200", "same", "same", "12_24mon", "same")
    assert (b["agent_last_dept"], b["speed_m0"], b["speed_change_m4m0"], b["max_svod_change_m3m1"], b["baserev_change_m6m0"]) == ("Retention", "1000", "higher", "up", "up")
    assert (b["curr_video_tier_desc_m0"], b["video_tier_change_m4m0"], b["ov_tier_change_m4m0"], b["cust_tenure"]) == ("CORE", "lower", 1, "nan")
    assert (b["agentcall_and_repeat1"], b["agentcall_and_repeat2"], b["servicevisit_once"], b["agentcall_servicevisit"], b["rateevent_baserevchange"]) == (1, 0, 1, 1, 1)
    assert (b["agentlastdep_OFFLINEdistress"], b["tenure_income"], b["video_offer_group_desc_m1"], b["promo_rolloff_count_60day"]) == ("Retention_1", "nan_None", 0, 1)
    assert b["ivr_last_interactionReason"] == "ALL_OTHER" and "baserev_m0" not in b.asDict() and "speed_m1" not in b.asDict()


def test_names(spark):
    assert pc.clean_name("products_2: Video/A+B") == "products2SPACEVideoAPLUSB"
    df, names = pc.clean_names(spark.createDataFrame([(1, 2)], "`a b` int, `c+d` int"))
    assert df.columns == ["aSPACEb", "cPLUSd"] and names.count() == 2
    with pytest.raises(ValueError):
        pc.clean_names(spark.createDataFrame([(1, 2)], "`a-b` int, ab int"))


def test_scalers_match_numpy(spark):
    rng = np.random.default_rng(9)
    x = np.round(rng.normal(3, 2, 500), 2)
    df = spark.createDataFrame(pd.DataFrame({"chc_id": range(500), "x": x}))
    got = lambda f: np.array([r[1] for r in sorted(rows(f.apply(df, ["chc_id"])))])
    assert np.allclose(got(nu.standard(df, ["x"])), (x - x.mean()) / x.std())
    q = np.quantile(x, [0.25, 0.5, 0.75])
    assert np.allclose(got(nu.robust(df, ["x"])), (x - q[1]) / (q[2] - q[0]))
    marks, refs = np.quantile(x, np.linspace(0, 1, 11)), np.linspace(0, 1, 11)
    want = 0.5 * (np.interp(x, marks, refs) - np.interp(-x, -marks[::-1], -refs[::-1]))
    assert np.allclose(got(nu.quantile(df, ["x"], 11)), np.where(x == x.min(), 0, np.where(x == x.max(), 1, want)))
    assert statistics.fmean(got(nu.power(df, ["x"]))) == pytest.approx(0, abs=1e-9)


def test_plans_stay_distributed(spark):
    """No product of two tables, and no window over all rows of a table."""
    from stayflow import fixtures as fx
    from stayflow.operators.cohort import CohortRules

    sf = "/root/testdata/sf0.001"
    v1 = fx.cust_month(spark, sf)
    cohort = co.train_cohort(v1, 200003, CohortRules(products=("A", "B"), product_col="product"), ["tenure"])
    for df in (v1, cohort, ev.with_rank(fx.scored(spark, sf), ev.PROB), ev.curve_points(fx.scored(spark, sf))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    scan = spark.read.parquet(f"{sf}/orders.parquet").filter("o_totalprice > 5").select("o_orderkey")
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,5.0)]" in plan


def test_many_narrow_intervals(spark):
    """Hundreds of wanted ranks, narrowed: the plan must not grow with them."""
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({f"c{j}": np.round(rng.normal(size=4000), 2 + j) for j in range(6)})
    pdf.loc[:900, "c0"] = 0.25  # a hot value
    pdf.loc[::7, "c1"] = np.nan
    probs = [k / 100 for k in range(101)]
    got = quantiles.exact_quantiles(spark.createDataFrame(pdf), list(pdf), probs, limit=500)
    for c in pdf:
        assert got[c] == pytest.approx(list(pdf[c].dropna().quantile(probs)), abs=1e-12)


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(float(i), i % 2) for i in range(100)] + [(float("nan"), 1), (None, 0)], "x double, status int")
    for fitted in (nu.standard(df, ["x"]), nu.minmax(df, ["x"]), nu.maxabs(df, ["x"]), nu.robust(df, ["x"]), nu.binarize(["x"], 50.0)):
        out = [r[0] for r in fitted.apply(df).collect()]
        assert out.count(None) == 2 and not any(math.isnan(v) for v in out if v is not None)
    assert sorted({v for v in (r[0] for r in nu.minmax(df, ["x"]).apply(df).collect()) if v is not None})[-1] == 1.0
    for n in (64, 65):  # the two forms of a bucket search agree
        got = [r[0] for r in df.select(nu.bucket_index(F.col("x"), [float(k) for k in range(n)])).collect()]
        assert got.count(None) == 2 and max(v for v in got if v is not None) == n
    wide = spark.createDataFrame([(1.0, float("nan"), None), (float("nan"), None, None)], "a double, b double, c double")
    assert [r[0] for r in wide.select(fc.row_max([F.col(c) for c in "abc"])).collect()] == [1.0, None]


def test_code_forms_agree_on_a_level_without_labels(spark, monkeypatch):
    train = spark.createDataFrame([(1, "a", 1), (2, "b", None), (3, "c", 0)], "chc_id long, f string, status int")
    forms = []
    for limit in (500, 1):
        monkeypatch.setattr(ca, "LITERAL_LEVELS", limit)
        forms.append(sorted(rows(ca.encode(train, train, ["f"], "y_mean", "status").select("chc_id", "f"))))
    assert forms[0] == forms[1] == [(1, 1.0), (2, 0.0), (3, 0.0)]


def test_any_number_of_levels(spark):
    df = spark.range(1500).select(F.col("id").alias("chc_id"), F.concat(F.lit("v"), "id").alias("f"), F.lit("k").alias("g"))
    assert len(prep.level_lists(df, ["f"])["f"]) == 1500
    more = df.limit(3).unionByName(spark.createDataFrame([(9999, "new", None)], "chc_id long, f string, g string"))
    got = {r.chc_id: r.levels for r in prep.sparse_levels(more, df, ["f", "g"], ["chc_id"]).collect()}
    assert len(got[0]) == 1501 and got[0].numNonzeros() == 2 and got[9999].numNonzeros() == 0


def test_key_parts_are_not_cut(spark):
    df = spark.range(1)
    assert rows(df.select(keys.build_key(F.lit("0701"), F.lit(999999), F.lit(5)))) == [("070199999905",)]
    with pytest.raises(Exception, match="key part longer than 6"):
        df.select(keys.build_key(F.lit("0701"), F.lit(1234567), F.lit(1))).collect()


def test_stitched_splits_always_have_twelve_rows(spark):
    scored = [(i, i % 2, i / 100, "big") for i in range(60)] + [(100 + i, 1, i / 10, "small") for i in range(5)]
    df = spark.createDataFrame(scored, f"chc_id long, {ev.LABEL} int, {ev.PROB} double, split string")
    assert [r.bucket for r in ev.stitched_splits(df, "split").collect()].__len__() == 12


def test_draws_end_with_repeated_values():
    class Model:
        getParam = staticmethod(str)

    assert len(models.random_draws(Model, {"a": [1, 1, 2], "b": [3, 3]}, 50, 0)) == 2


def test_fits_survive_storage(spark, tmp_path):
    """Every numeric kind and every level encoder is applied from its file, without its training table."""
    from stayflow.operators.stage import load_fitted, union

    df = spark.createDataFrame([(i, float(i % 13), float(i) ** 2, "ab"[i % 2]) for i in range(60)] + [(60, None, float("nan"), None)], "chc_id long, x double, y double, f string")
    cols = ["x", "y"]
    kinds = {
        "Original": nu.passthrough(cols), "Standard": nu.standard(df, cols), "Robust": nu.robust(df, cols), "Quantile": nu.quantile(df, cols, 11), "Binary": nu.binarize(cols, 5.0),
        "MinMax": nu.minmax(df, cols, (1.0, 3.0)), "MaxAbs": nu.maxabs(df, cols), "Norm": nu.normalize(cols, "l1"), "KBin": nu.kbins(df, cols, 4, "ordinal"),
        "Power": nu.power(df, cols), "Log1p": nu.log1p(cols), "Sqrt": nu.sqrt(cols), "Reciprocal": nu.reciprocal(cols),
    }
    made = union(*[f.renamed(prefix=n) for n, f in kinds.items()])
    chosen = made.only([n for n in made.outputs if n != "Sqrt_y"])
    chosen.save(spark, str(tmp_path / "numbers"))
    again = load_fitted(spark, str(tmp_path / "numbers"))
    assert list(again.outputs) == list(chosen.outputs)
    assert sorted(map(repr, again.apply(df, ["chc_id"]).collect())) == sorted(map(repr, chosen.apply(df, ["chc_id"]).collect()))
    for i, fit in enumerate((ca.fit_encoder(df, ["f"], "count", prefix="n"), ca.fit_rare(df, ["f"], 0.6, method="common"), ca.fit_clamp(df.filter("f = 'a'"), ["f"]))):
        fit.save(str(tmp_path / f"levels{i}"))
        stored = ca.LevelCodes.load(spark, str(tmp_path / f"levels{i}"))
        assert sorted(map(repr, stored.apply(df).collect())) == sorted(map(repr, fit.apply(df).collect()))
    with pytest.raises(ValueError):
        nu.universal(cols, F.abs).save(spark, str(tmp_path / "none"))


def test_a_cohort_reads_its_months_only(spark, capsys):
    from stayflow import fixtures as fx
    from stayflow.queries.cohorts import MONTH, RULES

    df = fx.snapshot(spark, "/root/testdata/sf0.001")
    co.eligible(df, MONTH, RULES).explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(dt" in plan and f"= {MONTH})" in plan


def test_lift_counts_the_scores_once(spark):
    """Weighted edges equal plain quantiles; nulls are left out."""
    p = [0.1, 0.1, 0.1, 0.2, 0.5, 0.9, 0.9, 1.0, None]
    df = spark.createDataFrame([(v, i % 2) for i, v in enumerate(p)], f"{ev.PROB} double, {ev.LABEL} int")
    probs = [k / 10 for k in range(11)]
    edges = ev.score_edges(ev.score_table(df), probs)
    assert edges == pytest.approx(np.quantile(np.array(p[:-1], float), probs).tolist())
    assert ev.score_edges(ev.score_table(df.filter("1 = 0")), probs) is None
