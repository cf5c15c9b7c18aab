"""Model evaluation: confusion metrics, ROC/PR, lift and gain tables.

The score tables can hold billions of rows, so curves and ranks come from counts per
distinct score with sliced running totals, never from one sorted task.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from stayflow.functions.columns import ratio, ratio_or_zero
from stayflow.operators.numeric import qcut
from stayflow.operators.ordered import global_rank, rank_slice, running_totals, slice_of
from stayflow.operators.quantiles import exact_quantiles
from stayflow.session import materialize

LABEL, PREDICTED, PROB = "original_labels", "predicted_label", "prediction_probability"


def flip_probability(df: DataFrame, prob: str = PROB, predicted: str = PREDICTED) -> DataFrame:
    """Confidence in the predicted label turned into the probability of leaving."""
    p = F.col(prob)
    return df.withColumn(prob, F.when(F.col(predicted) == 0, 1 - p).otherwise(p))


def confidence(p1: Column) -> Column:
    return F.greatest(p1, 1 - p1)


def confusion(df: DataFrame, label: str = LABEL, predicted: str = PREDICTED, by: Sequence[str] = ()) -> DataFrame:
    def cell(y: int, p: int) -> Column:
        return F.count(F.when((F.col(label) == y) & (F.col(predicted) == p), 1))

    return df.groupBy(*by).agg(
        cell(1, 1).alias("tp"), cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn")
    )


def rate_columns() -> dict[str, Column]:
    """Rates from the confusion counts tp, tn, fp, fn; 0 where a class is absent."""
    tp, tn, fp, fn = (F.col(x) for x in ("tp", "tn", "fp", "fn"))
    tpr, tnr = ratio_or_zero(tp, tp + fn), ratio_or_zero(tn, tn + fp)
    return {
        "tpr": tpr,
        "tnr": tnr,
        "fpr": ratio_or_zero(fp, tn + fp),
        "accuracy": ratio_or_zero(tp + tn, tp + tn + fp + fn),
        "balanced_accuracy": (tpr + tnr) / 2,
    }


def class_metric_columns() -> dict[str, Column]:
    """Precision, recall and F1 per class and weighted by support, and MCC."""
    tp, tn, fp, fn = (F.col(x).cast("double") for x in ("tp", "tn", "fp", "fn"))
    p1, r1 = ratio_or_zero(tp, tp + fp), ratio_or_zero(tp, tp + fn)
    p0, r0 = ratio_or_zero(tn, tn + fn), ratio_or_zero(tn, tn + fp)
    f1, f0 = ratio_or_zero(2 * tp, 2 * tp + fp + fn), ratio_or_zero(2 * tn, 2 * tn + fp + fn)
    n1, n0 = tp + fn, tn + fp

    def weighted(a: Column, b: Column) -> Column:
        return ratio_or_zero(a * n1 + b * n0, n1 + n0)

    spread = F.sqrt(tp + fp) * F.sqrt(tp + fn) * F.sqrt(tn + fp) * F.sqrt(tn + fn)
    return {
        "precision_1": p1, "recall_1": r1, "f1_1": f1,
        "precision_0": p0, "recall_0": r0, "f1_0": f0,
        "precision_weighted": weighted(p1, p0), "recall_weighted": weighted(r1, r0), "f1_weighted": weighted(f1, f0),
        "mcc": ratio_or_zero(tp * tn - fp * fn, spread),
    }


def rates(c: DataFrame) -> DataFrame:
    return c.select("*", *[v.alias(k) for k, v in rate_columns().items()])


def class_metrics(c: DataFrame) -> DataFrame:
    return c.select(*[v.alias(k) for k, v in class_metric_columns().items()])


def threshold_sweep(df: DataFrame, thresholds: Sequence[float], prob: str = PROB, label: str = LABEL) -> DataFrame:
    """Confusion counts and rates at each threshold: all thresholds in one aggregate."""
    p, y = F.col(prob), F.col(label)
    cells = [
        F.struct(
            F.lit(float(t)).alias("threshold"),
            F.count(F.when((y == 1) & (p >= t), 1)).alias("tp"),
            F.count(F.when((y == 0) & (p < t), 1)).alias("tn"),
            F.count(F.when((y == 0) & (p >= t), 1)).alias("fp"),
            F.count(F.when((y == 1) & (p < t), 1)).alias("fn"),
        )
        for t in thresholds
    ]
    return rates(df.agg(F.array(*cells).alias("_rows")).select(F.inline("_rows")))


def _score_counts(df: DataFrame, prob: str, label: str) -> DataFrame:
    y = F.col(label)
    return df.groupBy(F.col(prob).alias("score")).agg(
        F.count(F.when(y == 1, 1)).alias("pos"), F.count(F.when(y == 0, 1)).alias("neg")
    )


def roc_auc(df: DataFrame, prob: str = PROB, label: str = LABEL) -> DataFrame:
    """Exact rank statistic, ties count half; null when a class is absent."""
    ranked = running_totals(_score_counts(df, prob, label), [F.col("score")], ["neg"])
    wins = F.col("pos").cast("decimal(20,0)") * (2 * F.col("neg_before") + F.col("neg")).cast("decimal(20,0)")
    return ranked.agg(ratio(F.sum(wins), 2 * F.sum("pos").cast("double") * F.sum("neg")).alias("auc"))


def curve_points(df: DataFrame, prob: str = PROB, label: str = LABEL) -> DataFrame:
    """Per distinct score, the rates of calling everything at or above it a leaver."""
    counts = _score_counts(df, prob, label)
    ranked = running_totals(counts, [F.col("score").desc()], ["pos", "neg"], totals=True)
    tp, fp = F.col("pos_before") + F.col("pos"), F.col("neg_before") + F.col("neg")
    return ranked.select(
        "score",
        tp.alias("tp"),
        fp.alias("fp"),
        ratio(tp, F.col("pos_total")).alias("tpr"),
        ratio(fp, F.col("neg_total")).alias("fpr"),
        ratio(tp, tp + fp).alias("precision"),
    )


def roc_points(df: DataFrame, prob: str = PROB, label: str = LABEL) -> DataFrame:
    return curve_points(df, prob, label).select("score", "fpr", "tpr")


def pr_points(df: DataFrame, prob: str = PROB, label: str = LABEL) -> DataFrame:
    return curve_points(df, prob, label).select("score", "precision", F.col("tpr").alias("recall"))


def score_table(df: DataFrame, prob: str = PROB, label: str = LABEL) -> DataFrame:
    """(score, leavers, subs) per distinct score, written once: all that deciles, lift and gain need."""
    counts = df.groupBy(F.col(prob).cast("double").alias("score")).agg(F.sum(label).cast("bigint").alias("leavers"), F.count(F.lit(1)).alias("subs"))
    return materialize(counts.filter("score IS NOT NULL"), "scores")


def score_edges(scores: DataFrame, probs: Sequence[float]) -> list[float] | None:
    """Exact interpolated quantiles of the scores from their counts; None without scores."""
    ranked = running_totals(scores, [F.col("score")], ["subs"])
    n = scores.agg(F.sum("subs")).scalar()
    first, last = F.col("subs_before"), F.col("subs_before") + F.col("subs") - 1
    spots = [F.lit(float(p)) * (n - 1) for p in probs]
    ends = [F.max(F.when((f(s) >= first) & (f(s) <= last), F.col("score"))).alias(f"{name}{i}") for i, s in enumerate(spots) for name, f in (("lo", F.floor), ("hi", F.ceil))]
    parts = [F.max(s - F.floor(s)).alias(f"at{i}") for i, s in enumerate(spots)]
    found = ranked.agg(*ends, *parts).first()
    if found is None or found["lo0"] is None:
        return None
    return [found[f"lo{i}"] + (found[f"hi{i}"] - found[f"lo{i}"]) * found[f"at{i}"] for i in range(len(probs))]


def with_decile(df: DataFrame, prob: str = PROB, k: int = 10, name: str = "decile") -> DataFrame:
    """Value quantile bins 1..k, lowest first; customers with one score share a bin."""
    edges = exact_quantiles(df, [prob], [j / k for j in range(k + 1)])[prob]
    if edges[0] is None:
        return df.withColumn(name, F.lit(None).cast("int"))
    return df.withColumn(name, qcut(F.col(prob), edges))


def lift_table(df: DataFrame, prob: str = PROB, label: str = LABEL, k: int = 10) -> DataFrame:
    """Rates, lift, gain and cumulative lift per decile, best decile first.

    The table is read once, for the counts per score; edges and rows follow from them.
    The running sums are windows over the ten rows of the decile aggregate.
    """
    decile = "decile"
    scores = score_table(df, prob, label)
    edges = score_edges(scores, [j / k for j in range(k + 1)])
    binned = scores.withColumn(decile, qcut(F.col("score"), edges) if edges else F.lit(None).cast("int"))
    by = binned.groupBy(decile).agg(
        F.min("score").alias("min_prob"),
        F.max("score").alias("max_prob"),
        F.sum("leavers").alias("count_leavers"),
        F.sum("subs").alias("count_subs"),
    )
    everyone = Window.partitionBy(F.lit(0))
    sofar = everyone.orderBy(F.desc("max_prob")).rowsBetween(Window.unboundedPreceding, 0)
    leavers, subs = F.sum("count_leavers").over(everyone), F.sum("count_subs").over(everyone)
    t = by.select(
        "*",
        F.sum("count_leavers").over(sofar).alias("cumu_leavers"),
        F.sum("count_subs").over(sofar).alias("cumu_subs"),
        leavers.alias("_c"),
        subs.alias("_s"),
    )
    rate, overall = ratio(100 * F.col("count_leavers"), F.col("count_subs")), ratio(100 * F.col("_c"), F.col("_s"))
    gain, reach = ratio(100 * F.col("cumu_leavers"), F.col("_c")), ratio(100 * F.col("cumu_subs"), F.col("_s"))
    return t.select(
        decile, "min_prob", "max_prob", "count_leavers", "count_subs", "cumu_leavers", "cumu_subs",
        rate.alias("conv_3m"), overall.alias("avg_leaver_rate"), ratio(rate, overall).alias("lift"),
        gain.alias("gain"), reach.alias("cumu_subs_pct"), ratio(gain, reach).alias("cumu_lift"),
    )


def lift_all(df: DataFrame) -> DataFrame:
    return lift_table(flip_probability(df))


def lift_top_decile(df: DataFrame) -> DataFrame:
    """The best decile cut into deciles again."""
    top = with_decile(flip_probability(df)).filter("decile = 10").drop("decile")
    return lift_table(top)


def top_n(df: DataFrame, n: int, prob: str = PROB, key: str = "chc_id") -> DataFrame:
    return df.orderBy(F.desc(prob), F.asc(key)).limit(n)


def lift_top_n(df: DataFrame, n: int = 10_000, key: str = "chc_id") -> DataFrame:
    """Deciles of the best ``n`` predicted leavers, all of them when there are fewer."""
    top = top_n(df.filter(F.col(PREDICTED) == 1), n, key=key)
    base = df.agg(F.avg(LABEL).alias("base")).scalar()
    t = with_decile(top).groupBy("decile").agg(
        F.min(PROB).alias("min_prob"), F.max(PROB).alias("max_prob"), F.avg(LABEL).alias("conv_3m"), F.count(F.lit(1)).alias("count_subs")
    )
    return t.withColumn("avg_leaver_rate", base).withColumn("lift", ratio(F.col("conv_3m"), F.col("avg_leaver_rate")))


def with_rank(df: DataFrame, prob: str, key: str = "chc_id") -> DataFrame:
    """Adds ``rank_no`` 1..n, best score first, key on ties, and ``n``."""
    return global_rank(df, [F.desc(prob), F.asc(key)], "rank_no", "n")


def with_percentile(df: DataFrame, prob: str, key: str = "chc_id", name: str = "Rank") -> DataFrame:
    """Percentile 1..100 of the score, best first."""
    ranked = with_rank(df, prob, key)
    return ranked.withColumn(name, rank_slice(F.col("rank_no"), F.col("n"), 100)).drop("rank_no", "n")


def lift_slices(df: DataFrame, k: int, prob: str = PROB, label: str = LABEL, key: str = "chc_id", ranked: DataFrame | None = None) -> DataFrame:
    """Lift and leavers of ``k`` equal slices of the ranked customers."""
    rows = ranked if ranked is not None else with_rank(df.select(key, prob, label), prob, key)
    s = rows.withColumn("slice", slice_of(F.col("rank_no"), F.col("n"), k))
    by = s.groupBy("slice").agg(F.sum(label).cast("bigint").alias("leavers"), F.count(F.lit(1)).alias("subs"))
    everyone = Window.partitionBy(F.lit(0))  # k rows
    c, n = F.sum("leavers").over(everyone), F.sum("subs").over(everyone)
    width = 100 // k
    label_text = F.format_string("%d%% - %d%%", F.col("slice") * width, (F.col("slice") + 1) * width)
    return by.select(
        "slice",
        label_text.alias("bucket"),
        "subs",
        "leavers",
        ratio(ratio(F.col("leavers"), F.col("subs")), ratio(c, n)).alias("lift"),
        ratio(F.col("leavers"), c).alias("leaver_share"),
    )


def lift_stitched(df: DataFrame, prob: str = PROB, label: str = LABEL, key: str = "chc_id") -> DataFrame:
    """Four 5 % rows on top of eight 10 % rows; the ranking is shared by both."""
    ranked = with_rank(df.select(key, prob, label), prob, key)
    fine = lift_slices(df, 20, prob, label, key, ranked).filter("slice < 4")
    coarse = lift_slices(df, 10, prob, label, key, ranked).filter("slice >= 2")
    return fine.unionByName(coarse)


#: buckets of the stitched table: four of 5 %, then eight of 10 %
STITCHED = tuple([f"{5 * k}% - {5 * k + 5}%" for k in range(4)] + [f"{10 * k}% - {10 * k + 10}%" for k in range(2, 10)])


def stitched_splits(df: DataFrame, split: str, prob: str = PROB, label: str = LABEL, key: str = "chc_id") -> DataFrame:
    """Stitched lift of each split and of all customers side by side, twelve rows always.

    A split too small to fill a bucket has nulls there.
    """
    names = [r[0] for r in df.select(split).distinct().collect()]  # train, test
    out = df.sparkSession.createDataFrame([(b,) for b in STITCHED], "bucket string")
    for name in [*sorted(names), "all"]:
        part = df if name == "all" else df.filter(F.col(split) == name)
        t = lift_stitched(part, prob, label, key).select(
            "bucket", F.col("lift").alias(f"{name}_lift"), F.col("leavers").alias(f"{name}_leavers"), F.col("leaver_share").alias(f"{name}_share")
        )
        out = out.join(F.broadcast(t), "bucket", "left")  # twelve rows
    return out
