"""Single-feature decision trees grown on class counts per bin.

A tree on one feature only needs, for each bin of the feature, how many customers and
how many leavers it holds. Those counts come from one aggregate over the table for
all features and folds together; growing the tree then touches at most ``bins`` rows
per feature, and Spark spreads the features over the tasks.
"""
from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from stayflow.operators.numeric import right_closed_index
from stayflow.operators.quantiles import exact_quantiles
from stayflow.operators.stage import Fitted
from stayflow.operators.stats import target_correlation

BINS = 256


def feature_cuts(df: DataFrame, cols: Sequence[str], bins: int = BINS) -> dict[str, list[float]]:
    """Cut points per feature: its distinct inner quantiles, by one rule at every size.

    A value on a cut belongs to the left, so every value held by more than one row in
    ``bins`` ends a bin of its own.
    """
    found = exact_quantiles(df, list(cols), [k / bins for k in range(1, bins)])
    return {c: sorted({e for e in found[c] if e is not None}) for c in cols}


def bin_counts(df: DataFrame, cuts: dict[str, list[float]], label: str, keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., feature, bin, n, y, lo, hi): one row per occupied bin."""
    items = F.array(
        *[
            F.struct(F.lit(c).alias("feature"), right_closed_index(F.col(c).cast("double"), q).alias("bin"), F.col(c).cast("double").alias("value"))
            for c, q in cuts.items()
        ]
    )
    rows = df.select(*keep, F.col(label).alias("_y"), F.inline(items)).filter("bin IS NOT NULL")
    return rows.groupBy(*keep, "feature", "bin").agg(
        F.count(F.lit(1)).alias("n"), F.sum("_y").alias("y"), F.min("value").alias("lo"), F.max("value").alias("hi")
    )


def grow(n: np.ndarray, y: np.ndarray, depth: int, min_leaf: float) -> np.ndarray:
    """Leaf number of each bin for a Gini tree of the given depth on ordered bins."""
    leaf = np.zeros(len(n), dtype=int)
    stack, made = [(0, len(n), depth)], 0
    while stack:
        a, b, left = stack.pop()
        cut = best_cut(n[a:b], y[a:b], min_leaf) if left else None
        if cut is None:
            leaf[a:b] = made
            made += 1
        else:
            stack += [(a + cut, b, left - 1), (a, a + cut, left - 1)]
    return leaf


def best_cut(n: np.ndarray, y: np.ndarray, min_leaf: float) -> int | None:
    """The split with the lowest weighted Gini impurity, None when no split is allowed."""
    total, ones = n.sum(), y.sum()
    if ones == 0 or ones == total or len(n) < 2:
        return None
    nl, yl = np.cumsum(n)[:-1], np.cumsum(y)[:-1]
    nr, yr = total - nl, ones - yl
    allowed = (nl >= min_leaf) & (nr >= min_leaf)
    if not allowed.any():
        return None
    impurity = yl * (nl - yl) / np.maximum(nl, 1) + yr * (nr - yr) / np.maximum(nr, 1)
    return int(np.argmin(np.where(allowed, impurity, np.inf))) + 1


def rank_auc(score: np.ndarray, n: np.ndarray, y: np.ndarray) -> float:
    """ROC AUC from counts per score; ties count half."""
    levels, at = np.unique(score, return_inverse=True)
    pos, neg = np.bincount(at, y, len(levels)), np.bincount(at, n - y, len(levels))
    below = np.cumsum(neg) - neg
    pairs = pos.sum() * neg.sum()
    return float((pos * (below + neg / 2)).sum() / pairs) if pairs else 0.5


def _leaf_rates(n: np.ndarray, y: np.ndarray, leaf: np.ndarray) -> np.ndarray:
    size, ones = np.bincount(leaf, n), np.bincount(leaf, y)
    return (ones / np.maximum(size, 1))[leaf]


def fit_trees(
    df: DataFrame,
    cols: Sequence[str],
    label: str = "status",
    fold: str = "fold",
    corr_threshold: float = 0.005,
    max_depth: int = 6,
    min_node_size: float = 0.005,
    bins: int = BINS,
) -> DataFrame:
    """(feature, bin, lo, hi, depth, leaf, rate): the tree of each feature that is
    correlated enough, at the depth with the best cross-validated AUC.

    ``fold`` is a column with the fold number of each row.
    """
    if not 0 <= corr_threshold <= 1 or not 0 <= min_node_size <= 1:
        raise ValueError("thresholds must lie in [0, 1]")
    if not 1 <= max_depth <= 10:
        raise ValueError("max_depth must lie in 1..10")
    corr = {r["feature"]: r["corr"] for r in target_correlation(df, list(cols), label).collect()}
    strong = sorted(c for c, r in corr.items() if r is not None and abs(r) >= corr_threshold)
    counts = bin_counts(df, feature_cuts(df, strong, bins), label, [F.col(fold).alias("fold")])

    def one_feature(pdf: pd.DataFrame) -> pd.DataFrame:
        at = np.sort(pdf["bin"].unique())
        folds = np.sort(pdf["fold"].unique())
        n = pdf.pivot_table(index="fold", columns="bin", values="n", fill_value=0, aggfunc="sum").reindex(folds)[at].to_numpy(float)
        y = pdf.pivot_table(index="fold", columns="bin", values="y", fill_value=0, aggfunc="sum").reindex(folds)[at].to_numpy(float)
        best, best_auc = 1, -1.0
        for depth in range(1, max_depth + 1):
            aucs = []
            for k in range(len(folds)):
                tn, ty = n.sum(0) - n[k], y.sum(0) - y[k]
                leaf = grow(tn, ty, depth, np.ceil(min_node_size * tn.sum()))
                aucs.append(rank_auc(_leaf_rates(tn, ty, leaf), n[k], y[k]))
            if np.mean(aucs) > best_auc:
                best, best_auc = depth, float(np.mean(aucs))
        tn, ty = n.sum(0), y.sum(0)
        leaf = grow(tn, ty, best, np.ceil(min_node_size * tn.sum()))
        ends = pdf.groupby("bin").agg(lo=("lo", "min"), hi=("hi", "max")).loc[at]
        return pd.DataFrame(
            {
                "feature": pdf["feature"].iloc[0], "bin": at, "lo": ends["lo"].to_numpy(), "hi": ends["hi"].to_numpy(),
                "depth": best, "leaf": leaf, "rate": _leaf_rates(tn, ty, leaf),
            }
        )

    return counts.groupBy("feature").applyInPandas(
        one_feature, "feature string, bin int, lo double, hi double, depth int, leaf int, rate double"
    )


def tree_stage(trees: DataFrame, suffix: str | None = None) -> Fitted:
    """Feature values replaced by the rate of their leaf.

    ``trees`` holds at most ``bins`` rows per feature; a leaf ends half way to the
    first value of the next one.
    """
    steps: dict[str, list[tuple[float, float, int, float]]] = {}
    for r in trees.orderBy("feature", "bin").collect():
        steps.setdefault(r["feature"], []).append((r["lo"], r["hi"], r["leaf"], r["rate"]))
    out = {}
    for c, rows in steps.items():
        x = F.col(c).cast("double")
        chain = None
        for a, b in zip(rows, rows[1:]):
            if a[2] != b[2]:
                cond = x <= F.lit((a[1] + b[0]) / 2)
                chain = F.when(cond, F.lit(a[3])) if chain is None else chain.when(cond, F.lit(a[3]))
        last = F.when(x.isNotNull(), F.lit(rows[-1][3]))
        out[c] = last if chain is None else chain.otherwise(last)
    return Fitted(out).renamed(suffix=suffix)


def leaf_ranges(df: DataFrame, cols: Sequence[str], label: str = "status", depth: int = 2, min_share: float = 0.02, bins: int = BINS) -> DataFrame:
    """(feature, leaf, lo, hi, range, n, y): shallow trees that bin numbers for profiles."""
    counts = bin_counts(df, feature_cuts(df, list(cols), bins), label)

    def one_feature(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("bin")
        n, y = pdf["n"].to_numpy(float), pdf["y"].to_numpy(float)
        pdf["leaf"] = grow(n, y, depth, np.floor(min_share * n.sum()))
        out = pdf.groupby("leaf", as_index=False).agg(lo=("lo", "min"), hi=("hi", "max"), n=("n", "sum"), y=("y", "sum"))
        out.insert(0, "feature", pdf["feature"].iloc[0])
        return out

    leaves = counts.groupBy("feature").applyInPandas(one_feature, "feature string, leaf int, lo double, hi double, n bigint, y bigint")
    return leaves.withColumn("range", F.concat_ws("_", F.col("lo").cast("string"), F.col("hi").cast("string")))


def range_stage(leaves: DataFrame) -> Fitted:
    """Each number replaced by the range label of its leaf."""
    steps: dict[str, list] = {}
    for r in leaves.orderBy("feature", "leaf").collect():  # a few leaves per feature
        steps.setdefault(r["feature"], []).append(r)
    out = {}
    for c, rows in steps.items():
        x = F.col(c).cast("double")
        chain = None
        for a, b in zip(rows, rows[1:]):
            cond = x <= F.lit((a["hi"] + b["lo"]) / 2)
            chain = F.when(cond, F.lit(a["range"])) if chain is None else chain.when(cond, F.lit(a["range"]))
        last = F.when(x.isNotNull(), F.lit(rows[-1]["range"]))
        out[f"{c}_range"] = last if chain is None else chain.otherwise(last)
    return Fitted(out)
