"""Feature screening: one shuffle of counts or one aggregate serves all features."""
from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from stayflow.functions.columns import ratio
from stayflow.operators.ordered import nearest_known, running_totals
from stayflow.operators.stats import long_numbers, pair_correlations, per_column, target_correlation, top_partners
from stayflow.operators.trees import BINS, bin_counts, feature_cuts


def ranked(df: DataFrame, by: Column, name: str) -> DataFrame:
    """Adds a 1-based rank; the frame has one row per feature."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(by, F.asc("feature"))))


def univariate_auc(train: DataFrame, test: DataFrame, cols: Sequence[str], label: str = "status") -> DataFrame:
    """Test AUC of a one-feature tree fitted on train, for all features at once.

    A full tree on one feature predicts the mean outcome of each training value, and a
    test value goes to the nearest one; that is what is computed, at any number of values.
    Rows are reduced to counts per value on the map side, then spread by feature and value.
    Rows without a value or a label are left out.
    """
    scored = nearest_known(_value_counts(train, test, cols, label), ["feature"], "value", ratio(F.col("fit_y"), F.col("fit_n")), "score").filter("n > 0")
    base = train.agg(F.avg(label).alias("b")).scalar()
    steps = scored.groupBy("feature", F.coalesce("score", base).alias("score")).agg(F.sum("y").alias("pos"), (F.sum("n") - F.sum("y")).alias("neg"))
    wins = F.col("pos") * (F.col("neg_before") + F.col("neg") / 2)
    auc = running_totals(steps, [F.col("score")], ["neg"], ["feature"]).withColumn("w", wins).groupBy("feature").agg(
        F.coalesce(ratio(F.sum("w"), F.sum("pos").cast("double") * F.sum("neg")), F.lit(0.5)).alias("roc_auc")
    )
    return ranked(auc, F.desc("roc_auc"), "ranking_tree")


def _value_counts(train: DataFrame, test: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """(feature, value, fit_n, fit_y, n, y): rows and positives of train and of test for each value."""
    none, one = F.lit(None).cast("bigint"), F.lit(1).cast("bigint")
    fit = long_numbers(train, cols, [F.col(label).cast("bigint").alias("_y")]).select("feature", "value", one.alias("fit_n"), F.col("_y").alias("fit_y"), none.alias("n"), none.alias("y"))
    seen = long_numbers(test, cols, [F.col(label).cast("bigint").alias("_y")]).select("feature", "value", none.alias("fit_n"), none.alias("fit_y"), one.alias("n"), F.col("_y").alias("y"))
    rows = fit.unionByName(seen).filter("value IS NOT NULL AND coalesce(fit_y, y) IS NOT NULL")
    return rows.groupBy("feature", "value").agg(*(F.sum(c).alias(c) for c in ("fit_n", "fit_y", "n", "y")))


def anova_f(df: DataFrame, cols: Sequence[str], label: str = "status", p_values: bool = False) -> DataFrame:
    """One-way F of every feature over the two classes, from class sizes, means and variances."""
    y = F.col(label)

    def f_value(x: Column) -> Column:
        x = x.cast("double")
        n = {k: F.count(F.when(y == k, x)).cast("double") for k in (0, 1)}
        m = {k: F.avg(F.when(y == k, x)) for k in (0, 1)}
        v = {k: F.var_pop(F.when(y == k, x)) for k in (0, 1)}
        total = n[0] + n[1]
        grand = F.avg(x)
        between = n[0] * (m[0] - grand) * (m[0] - grand) + n[1] * (m[1] - grand) * (m[1] - grand)
        within = n[0] * v[0] + n[1] * v[1]
        return ratio(between, ratio(within, total - 2))

    out = ranked(per_column(df, cols, {"anova": f_value}), F.desc_nulls_last("anova"), "ranking_anova")
    if not p_values:
        return out
    n = per_column(df, cols, {"_n": F.count})
    return out.join(n, "feature").withColumn("pval_anova", _f_tail("anova", F.col("_n").cast("double") - 2)).drop("_n")


def _beta_tail(x: float, a: float, b: float) -> float:
    """Regularised incomplete beta function by its continued fraction (Lentz)."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1.0 - _beta_tail(1 - x, b, a)
    front = math.exp(a * math.log(x) + b * math.log1p(-x) + math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)) / a
    c, d = 1.0, 1.0 / (1.0 - (a + b) * x / (a + 1) or 1e-300)
    total = d
    for m in range(1, 500):
        for step in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 / ((1.0 + step * d) or 1e-300)
            c = (1.0 + step / c) or 1e-300
            total *= d * c
        if abs(d * c - 1.0) < 1e-14:
            break
    return front * total


@F.pandas_udf(T.DoubleType())
def _f_tail(f: pd.Series, dof: pd.Series) -> pd.Series:
    """Upper tail of F with (1, dof) degrees of freedom; one value per feature."""
    ok = f.notna() & (dof > 0)
    return pd.Series([_beta_tail(d / (d + v), d / 2, 0.5) if k else None for v, d, k in zip(f, dof, ok)], index=f.index, dtype="float64")


@F.pandas_udf(T.DoubleType())
def _chi2_tail(x: pd.Series) -> pd.Series:
    """Upper tail of chi-square with one degree of freedom."""
    return x.map(lambda v: math.erfc(math.sqrt(v / 2)) if v is not None and v == v else None)


def chi2_score(df: DataFrame, cols: Sequence[str], label: str = "status", p_values: bool = False) -> DataFrame:
    """Chi-square of non-negative coded features: class sums against their expectation."""
    y = F.col(label)
    n, n1 = F.count(F.lit(1)).cast("double"), F.count(F.when(y == 1, 1)).cast("double")

    def score(x: Column) -> Column:
        x = x.cast("double")
        seen = {k: F.coalesce(F.sum(F.when(y == k, x)), F.lit(0.0)) for k in (0, 1)}
        total = seen[0] + seen[1]
        want = {1: total * n1 / n, 0: total * (n - n1) / n}
        return ratio((seen[0] - want[0]) * (seen[0] - want[0]), want[0]) + ratio((seen[1] - want[1]) * (seen[1] - want[1]), want[1])

    out = ranked(per_column(df, cols, {"chi2": score}), F.desc_nulls_last("chi2"), "ranking_chi2")
    return out.withColumn("pval_chi2", _chi2_tail("chi2")) if p_values else out


def correlation_ranks(train: DataFrame, test: DataFrame, cols: Sequence[str], label: str = "status") -> DataFrame:
    both = target_correlation(train, cols, label, "corr_train").join(target_correlation(test, cols, label, "corr_test"), "feature")
    return ranked(both, F.abs(F.round("corr_train", 9)).desc_nulls_last(), "ranking_corr")


def mutual_information(df: DataFrame, cols: Sequence[str], label: str = "status", bins: int = BINS) -> DataFrame:
    """Mutual information with the label from joint counts per quantile bin, in nats."""
    whole = Window.partitionBy("feature")  # at most ``bins`` rows
    counts = bin_counts(df, feature_cuts(df, cols, bins), label).select(
        "feature",
        F.col("n").cast("double").alias("n"),
        F.col("y").cast("double").alias("y"),
        F.sum("n").over(whole).cast("double").alias("rows"),
        F.sum("y").over(whole).cast("double").alias("ones"),
    )
    n, y, total, ones = (F.col(c) for c in ("n", "y", "rows", "ones"))

    def term(joint: Column, marginal: Column) -> Column:
        return F.when(joint > 0, joint / total * F.log(ratio(joint * total, n * marginal))).otherwise(0.0)

    mi = counts.groupBy("feature").agg(F.sum(term(y, ones) + term(n - y, total - ones)).alias("mi"))
    return ranked(mi, F.desc("mi"), "ranking_mi")


def feature_tests(train: DataFrame, test: DataFrame, cols: Sequence[str], coded: Sequence[str], label: str = "status", bins: int = BINS, importance: DataFrame | None = None) -> DataFrame:
    """All tests side by side, one row per feature, with its five closest partners."""
    parts = [
        univariate_auc(train, test, cols, label),
        correlation_ranks(train, test, cols, label),
        mutual_information(train, cols, label, bins),
        anova_f(train, cols, label),
        chi2_score(train, coded, label),
        top_partners(pair_correlations(train, cols)),
    ]
    out = importance if importance is not None else parts.pop(0)
    for p in parts:
        out = out.join(p, "feature", "left")  # one row per feature on both sides
    return out


def top_features(ranking: DataFrame, n: int, attribute: str = "attribute", metric: str = "gain") -> DataFrame:
    """The ``n`` best distinct attributes, each at the rank of its best entry."""
    best = ranking.groupBy(attribute).agg(F.max(metric).alias(metric))
    return best.orderBy(F.desc(metric), F.asc(attribute)).limit(n)
