"""Feature screening, training and scoring."""
from pyspark.sql import functions as F

from stayflow import fixtures as fx
from stayflow.operators import prep, sampling as sa, screening as sc
from stayflow.plans import models as mo, monthly
from stayflow.queries.cohorts import MONTH, RULES
from stayflow.queries.registry import query
from stayflow.queries.statistics import TRAIN_TEST, corr_target_sql, pairs_sql, r, split
from stayflow.queries.views import long_numbers, with_views
from stayflow.session import materialize

COLS = ["price", "mon", "acctbal_gap"]
BINS = 256


def _cuts_sql(src="tr", cols=COLS, bins=BINS):
    """Cut points per feature: its distinct inner quantiles."""
    parts = []
    for c in cols:
        inner = ",".join(repr(k / bins) for k in range(1, bins))
        parts.append(
            f"c_{c} AS (SELECT list_distinct(quantile_cont(CAST({c} AS DOUBLE), [{inner}])) AS cuts FROM {src})"
        )
    return parts


def _bins_sql(src: str, out: str, cols=COLS):
    rows = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, len(list_filter(cuts, lambda e: e < CAST({c} AS DOUBLE))) AS bin, status AS y FROM {src}, c_{c} WHERE {c} IS NOT NULL" for c in cols
    )
    return f"{out} AS (SELECT feature, bin, count(*) AS n, CAST(sum(y) AS BIGINT) AS y FROM ({rows}) GROUP BY feature, bin)"


_AUC_CTES = [
    TRAIN_TEST,
    f"fa AS (SELECT feature, value, sum(status)/count(*) AS rate FROM ({long_numbers('tr', COLS, 'status')}) WHERE value IS NOT NULL GROUP BY 1,2)",
    f"fb AS (SELECT feature, value, sum(status) AS pos, count(*)-sum(status) AS neg FROM ({long_numbers('te', COLS, 'status')}) WHERE value IS NOT NULL GROUP BY 1,2)",
    # the nearest training value; half way between two, the smaller one
    """sc AS (SELECT fb.feature, CASE WHEN lo.value IS NOT NULL AND (hi.value IS NULL OR fb.value <= (lo.value+hi.value)/2) THEN lo.rate ELSE coalesce(hi.rate, (SELECT avg(status) FROM tr)) END AS s,
  sum(pos) AS pos, sum(neg) AS neg FROM fb ASOF LEFT JOIN fa lo ON lo.feature=fb.feature AND fb.value >= lo.value ASOF LEFT JOIN fa hi ON hi.feature=fb.feature AND fb.value <= hi.value GROUP BY 1,2)""",
    "w AS (SELECT feature, pos*(coalesce(sum(neg) OVER (PARTITION BY feature ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),0)+neg/2.0) AS w, pos, neg FROM sc)",
    "auc AS (SELECT feature, sum(w)/(CAST(sum(pos) AS DOUBLE)*sum(neg)) AS roc_auc FROM w GROUP BY feature)",
]
query("univariate_auc", with_views("v5", *_AUC_CTES, select="SELECT feature, round(roc_auc,6) AS roc_auc, row_number() OVER (ORDER BY roc_auc DESC, feature) AS ranking_tree FROM auc"))(
    lambda s, sf: r(sc.univariate_auc(*split(s, sf), COLS))
)


def _anova_sql(src="v5"):
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, (n0*(m0-g)*(m0-g)+n1*(m1-g)*(m1-g))/((n0*v0+n1*v1)/(n0+n1-2)) AS anova FROM (SELECT count({c}) FILTER (status=0) AS n0, count({c}) FILTER (status=1) AS n1,
  avg(CAST({c} AS DOUBLE)) FILTER (status=0) AS m0, avg(CAST({c} AS DOUBLE)) FILTER (status=1) AS m1, var_pop({c}) FILTER (status=0) AS v0, var_pop({c}) FILTER (status=1) AS v1, avg(CAST({c} AS DOUBLE)) AS g FROM {src})""" for c in COLS
    )


def _chi2_sql(src="v5", cols=("mon", "yr")):
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, (o0-t*(1-p))*(o0-t*(1-p))/(t*(1-p))+(o1-t*p)*(o1-t*p)/(t*p) AS chi2 FROM (SELECT CAST(sum({c}) FILTER (status=0) AS DOUBLE) AS o0, CAST(sum({c}) FILTER (status=1) AS DOUBLE) AS o1,
  CAST(sum({c}) AS DOUBLE) AS t, avg(status) AS p FROM {src})""" for c in cols
    )


def _mi_ctes(src="v5", out="mi"):
    return [
        *_cuts_sql(src), _bins_sql(src, f"{out}_b"),
        f"{out}_t AS (SELECT *, sum(n) OVER (PARTITION BY feature) AS tn, sum(y) OVER (PARTITION BY feature) AS ty FROM {out}_b)",
        f"{out} AS (SELECT feature, sum(CASE WHEN y>0 THEN y/tn*ln(CAST(y AS DOUBLE)*tn/(CAST(n AS DOUBLE)*ty)) ELSE 0 END + CASE WHEN n>y THEN (n-y)/tn*ln(CAST(n-y AS DOUBLE)*tn/(CAST(n AS DOUBLE)*(tn-ty))) ELSE 0 END) AS mi FROM {out}_t GROUP BY feature)",
    ]


query("anova_f", with_views("v5", f"a AS ({_anova_sql()})", select="SELECT feature, round(anova,6) AS anova, row_number() OVER (ORDER BY anova DESC, feature) AS ranking_anova FROM a"))(
    lambda s, sf: r(sc.anova_f(fx.wide(s, sf), COLS))
)
query("chi2_score", with_views("v5", f"a AS ({_chi2_sql()})", select="SELECT feature, round(chi2,6) AS chi2, row_number() OVER (ORDER BY chi2 DESC, feature) AS ranking_chi2 FROM a"))(
    lambda s, sf: r(sc.chi2_score(fx.wide(s, sf), ["mon", "yr"]))
)
query("test_p_values")(
    lambda s, sf: sc.anova_f(fx.wide(s, sf), ["price", "mon", "yr"], p_values=True).join(sc.chi2_score(fx.wide(s, sf), ["mon", "yr"], p_values=True), "feature", "left")
)
query("mutual_information", with_views("v5", *_mi_ctes(), select="SELECT feature, round(mi,9) AS mi, row_number() OVER (ORDER BY mi DESC, feature) AS ranking_mi FROM mi"))(
    lambda s, sf: r(sc.mutual_information(fx.wide(s, sf), COLS, bins=BINS), 9)
)
query(
    "feature_test_summary",
    with_views(
        "v5", *_AUC_CTES, *_mi_ctes("tr"), f"an AS ({_anova_sql('tr')})", f"ch AS ({_chi2_sql('tr', ('mon',))})",
        f"ca AS ({corr_target_sql(COLS, 'tr')})", f"cb AS ({corr_target_sql(COLS, 'te')})", f"p AS ({pairs_sql(COLS, 'tr')})",
        "d AS (SELECT col_a AS feature, col_b AS partner, corr FROM p UNION ALL SELECT col_b, col_a, corr FROM p)",
        "k AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY abs(corr) DESC, partner) AS k FROM d)",
        "k5 AS (SELECT feature, " + ", ".join(f"max(partner) FILTER (k={i}) AS feature_{i}, round(max(corr) FILTER (k={i}),6) AS corr_{i}" for i in range(1, 6)) + " FROM k GROUP BY feature)",
        select="""SELECT auc.feature, round(roc_auc,6) AS roc_auc, row_number() OVER (ORDER BY roc_auc DESC, auc.feature) AS ranking_tree, round(ca.corr,6) AS corr_train, round(cb.corr,6) AS corr_test,
  row_number() OVER (ORDER BY abs(round(ca.corr,9)) DESC, auc.feature) AS ranking_corr, round(mi,6) AS mi, row_number() OVER (ORDER BY mi DESC, auc.feature) AS ranking_mi,
  round(anova,6) AS anova, row_number() OVER (ORDER BY anova DESC, auc.feature) AS ranking_anova, round(chi2,6) AS chi2, CASE WHEN chi2 IS NOT NULL THEN 1 END AS ranking_chi2, k5.* EXCLUDE (feature)
  FROM auc JOIN ca USING (feature) JOIN cb USING (feature) JOIN mi USING (feature) JOIN an USING (feature) LEFT JOIN ch USING (feature) JOIN k5 USING (feature)""",
    ),
)(lambda s, sf: r(sc.feature_tests(*split(s, sf), COLS, ["mon"], bins=BINS)))
query(
    "feature_rank",
    with_views("v5", f"a AS ({corr_target_sql(['price', 'mon', 'yr', 'acctbal_gap'])})", select="SELECT feature, round(corr,6) AS corr, row_number() OVER (ORDER BY abs(round(corr,9)) DESC, feature) AS ranking FROM a"),
)(
    lambda s, sf: r(sc.ranked(sc.target_correlation(fx.wide(s, sf), ["price", "mon", "yr", "acctbal_gap"]), F.abs(F.round("corr", 9)).desc_nulls_last(), "ranking"))
)
query(
    "top_features",
    with_views("v5", f"l AS ({long_numbers('v5', ['price', 'mon', 'acctbal_gap'], 'nation')})", "g AS (SELECT nation, max(value) AS gain FROM l GROUP BY nation, feature)", select="SELECT nation AS attribute, max(gain) AS gain FROM g GROUP BY nation ORDER BY gain DESC, attribute LIMIT 10"),
)(lambda s, sf: _top_features(fx.wide(s, sf)))


def _top_features(df):
    from stayflow.operators.stats import long_numbers as ln

    gains = ln(df, ["price", "mon", "acctbal_gap"], [F.col("nation").alias("attribute")]).groupBy("attribute", "feature").agg(F.max("value").alias("gain"))
    return sc.top_features(gains, 10)


# --- models: fitted on the labelled cohort of one month ---

TEXTS, NUMBERS = ["product", "segment", "nation"], ["tenure", "rev_m0", "orders_6m", "acctbal"]


def _cohort(s, sf):
    from stayflow.queries.cohorts import train

    return materialize(prep.blanks_to_null(train(s, sf)), "cohort")


def _train_gbt(s, sf):
    rows = _cohort(s, sf)
    model = mo.train_gbt(rows, TEXTS, NUMBERS)
    return mo.score(model, rows, TEXTS, NUMBERS, ["chc_id", "status"])


def _batch_score(s, sf):
    from stayflow.functions.keys import build_key
    from stayflow.operators import cohort as co

    model = mo.train_gbt(_cohort(s, sf), TEXTS, NUMBERS)
    month = prep.blanks_to_null(co.score_cohort(fx.snapshot(s, sf), 200006, RULES, [*TEXTS, *NUMBERS]))
    keyed = month.withColumn("corp_house_cust", build_key(F.lit("0701"), F.col("chc_id"), F.col("chc_id") % 100, grow=True))
    return mo.batch_score(model, keyed, TEXTS, NUMBERS, 200006, f"gbt_train_{MONTH}_infer_200006", composite="corp_house_cust")


def _model_roundtrip(s, sf):
    from pyspark.ml import PipelineModel

    from stayflow.session import new_folder

    rows, path = _cohort(s, sf), new_folder(s, "model")
    mo.train_gbt(rows, TEXTS, NUMBERS).write().overwrite().save(path)
    return mo.score(PipelineModel.load(path), rows, TEXTS, NUMBERS, ["chc_id", "status"])


query("train_gbt")(_train_gbt)
query("batch_score")(_batch_score)
query("model_roundtrip")(_model_roundtrip)
query("feature_importance")(lambda s, sf: (lambda rows: mo.feature_importance(mo.train_gbt(rows, TEXTS, NUMBERS), rows, TEXTS, NUMBERS))(_cohort(s, sf)))
query("kfold_importance")(lambda s, sf: mo.kfold_importance(_cohort(s, sf), TEXTS, NUMBERS))
query("grid_search")(lambda s, sf: mo.grid_search(_cohort(s, sf), TEXTS, NUMBERS, {"maxDepth": [2, 3], "maxIter": [3]}, k=2)[1])
query("random_search")(lambda s, sf: mo.random_search(_cohort(s, sf), TEXTS, NUMBERS, {"maxDepth": [2, 3, 4], "maxIter": [2, 3, 4]}, draws=2, k=2)[1])
query("backward_selection")(lambda s, sf: mo.backward_selection(_cohort(s, sf), NUMBERS, smallest=3, largest=4, k=2, maxDepth=2, maxIter=2))
query("score_splits")(lambda s, sf: mo.split_metrics(mo.score_splits(sa.stratified_split(_cohort(s, sf)), TEXTS, NUMBERS)))
query("segment_tree")(lambda s, sf: mo.segment_tree(_cohort(s, sf), TEXTS, NUMBERS)[1])


# --- a month from stored artefacts, and the stored model on a later month ---


def _stored_model(s, sf):
    from stayflow.session import new_folder

    path = new_folder(s, "monthly")
    monthly.store_model(fx.snapshot(s, sf), MONTH, RULES, TEXTS, NUMBERS, f"{path}/model")
    return path


def _monthly_list(s, sf):
    """Stored model, cohort of June, scores and list; the run is repeated and replaces itself."""
    path = _stored_model(s, sf)
    for _ in range(2):
        monthly.run_month(fx.snapshot(s, sf), 200006, RULES, f"{path}/model", f"{path}/out", "0701", "list", "2000-06-30")
    return s.read.parquet(f"{path}/out/targets")


query("monthly_list")(_monthly_list)
query("out_of_time_lift")(lambda s, sf: monthly.out_of_time(fx.snapshot(s, sf), 200006, RULES, f"{_stored_model(s, sf)}/model")[1])
