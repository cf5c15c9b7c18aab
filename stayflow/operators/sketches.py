"""Statistics that are stored by month and merged, so that no report reads old rows again.

Number columns keep, for each month and group, their counts, moments and a KLL quantile
sketch; customers keep a theta sketch for each condition, and levels an HLL sketch. One
pass over a month makes its rows, a rerun replaces them, and any span of months is
described by merging a few rows for each month. Values never move: only sketches of
bounded size are shuffled.

Errors: the rank of a quantile is off by at most :func:`rank_error` of all values with 99 %
confidence, whatever was merged, and a group of at most ``k`` values is exact. A theta
sketch is off by about ``2 / sqrt(2 ** size)`` of the larger set, an HLL sketch by about
``1.04 / sqrt(2 ** size)``; up to its size a theta sketch is exact.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from stayflow.functions.columns import ratio
from stayflow.operators.stats import CHUNK, DESCRIBE, long_levels, per_column
from stayflow.sources.files import replace_parts

#: size of a quantile sketch, in values kept at each level
K = 2048
#: log2 of the hashes a theta sketch keeps, and of the registers of an HLL sketch
THETA_SIZE = 16
HLL_SIZE = 14


def rank_error(k: int = K) -> float:
    """Normalised rank error of one quantile, with 99 % confidence."""
    return 2.296 / k**0.9723  # fixed values: the published fit for KLL sketches


# --- numbers ---


def _clean(c: Column) -> Column:
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))


def number_sketches(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), k: int = K, chunk: int = CHUNK) -> DataFrame:
    """(by..., feature, rows, n, mean, m2, min, max, sketch), one pass per chunk of columns."""
    measures = {
        "rows": lambda c: F.count(F.lit(1)),
        "n": lambda c: F.count(_clean(c)),
        "mean": lambda c: F.avg(_clean(c)),
        "m2": lambda c: F.var_pop(_clean(c)) * F.count(_clean(c)),
        "min": lambda c: F.min(_clean(c)),
        "max": lambda c: F.max(_clean(c)),
        "sketch": lambda c: F.kll_sketch_agg_double(_clean(c), F.lit(k)),
    }
    return per_column(df, cols, measures, by, chunk)


def merge_numbers(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The rows of :func:`number_sketches` merged to one per feature and group of ``by``."""
    keys = [*by, "feature"]
    held = sketches.filter("n > 0")
    means = held.groupBy(*keys).agg((F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("_mean"))
    # deviations from the merged mean: raw squares of large values would lose digits
    gap = F.col("mean") - F.col("_mean")
    merged = held.join(means, keys).groupBy(*keys).agg(
        F.sum("n").alias("n"), F.max("_mean").alias("mean"), F.sum(F.col("m2") + F.col("n") * gap * gap).alias("m2"),
        F.min("min").alias("min"), F.max("max").alias("max"), F.kll_merge_agg_double("sketch").alias("sketch"),
    )
    sizes = sketches.groupBy(*keys).agg(F.sum("rows").alias("rows"))
    return sizes.join(merged, keys, "left").withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))


def describe_sketches(sketches: DataFrame, by: Sequence[str] = (), probs: Mapping[str, float] = DESCRIBE) -> DataFrame:
    """The describe report from stored sketches: exact but for the percentiles."""
    merged = merge_numbers(sketches, by)
    at = F.kll_sketch_get_quantile_double("sketch", F.array(*(F.lit(float(p)) for p in probs.values())))
    merged = merged.withColumn("_q", F.when(F.col("n") > 0, at))
    sd = F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1)))
    missing = ratio(100 * (F.col("rows") - F.col("n")), F.col("rows"))
    return merged.select(
        *by, "feature", "n", "mean", sd.alias("sd"), "min", "max", missing.alias("missing_pct"), *(F.col("_q")[i].alias(p) for i, p in enumerate(probs))
    )


def group_number_sketches(df: DataFrame, group: str, cols: Sequence[str], k: int = K) -> DataFrame:
    """Count, mean, median, max, min, sd and sum of each feature per group; the median by sketch."""
    rows = df.filter(F.col(group).isNotNull()).withColumn("grp", F.col(group).cast("string"))
    merged = describe_sketches(number_sketches(rows, cols, ["grp"], k), ["grp"], {"median": 0.5})
    total = F.coalesce(F.col("n") * F.col("mean"), F.lit(0.0))
    return merged.select("grp", "feature", F.col("n").alias("count"), "mean", "max", "min", F.col("sd").alias("std"), total.alias("sum"), "median")


def summarize_sketches(df: DataFrame, cols: Sequence[str], label: str | None = None, k: int = K) -> DataFrame:
    """Describe rows, quartiles by sketch, and the outcome rate among customers that have a value."""
    base = describe_sketches(number_sketches(df, cols, (), k), (), {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    base = base.withColumn("missing_pct", F.col("missing_pct") / 100)
    if label is None:
        return base
    rate = per_column(df, cols, {"rate": lambda c: F.avg(F.when(_clean(c).isNotNull(), F.col(label)))})
    return base.join(rate.select("feature", F.round("rate", 4).alias("rate")), "feature")


def store_numbers(df: DataFrame, path: str, cols: Sequence[str], month: str = "dt", by: Sequence[str] = (), k: int = K) -> None:
    """Sketches of the months in ``df``, stored by month; months that are there already are replaced."""
    replace_parts(number_sketches(df, cols, [month, *by], k), path, [month])


def rank_errors(df: DataFrame, described: DataFrame, cols: Sequence[str], by: Sequence[str] = (), probs: Mapping[str, float] = DESCRIBE) -> DataFrame:
    """(by..., feature, p, error): how far the true rank of each reported percentile is off.

    One pass that counts, for each column, the values below and up to its percentiles;
    a value that fills a range of ranks is off by its distance to the nearest of them.
    """
    names = list(probs)
    points = described.select(*by, "feature", F.array(*names).alias("_points"))
    long = df.select(*by, F.inline(F.array(*(F.struct(F.lit(c).alias("feature"), _clean(F.col(c)).alias("value")) for c in cols)))).filter("value IS NOT NULL")
    counted = long.join(F.broadcast(points), [*by, "feature"])  # one row per group and column of a report
    below = [F.count_if(F.col("value") < F.col("_points")[i]).alias(f"b{i}") for i in range(len(names))]
    upto = [F.count_if(F.col("value") <= F.col("_points")[i]).alias(f"u{i}") for i in range(len(names))]
    sums = counted.groupBy(*by, "feature").agg(F.count(F.lit(1)).alias("n"), *below, *upto)
    cells = []
    for i, name in enumerate(names):
        low, high, p = F.col(f"b{i}") / F.col("n"), F.col(f"u{i}") / F.col("n"), F.lit(float(probs[name]))
        cells.append(F.struct(F.lit(name).alias("p"), F.greatest(low - p, p - high, F.lit(0.0)).alias("error")))
    return sums.select(*by, "feature", F.inline(F.array(*cells)))


# --- customers and levels ---


def key_sketches(df: DataFrame, key: str, conditions: Mapping[str, str], by: Sequence[str] = ("dt",), size: int = THETA_SIZE) -> DataFrame:
    """(by..., condition, customers): theta sketches of the keys that meet each SQL condition."""
    met = F.array_compact(F.array(*(F.when(F.coalesce(F.expr(f"({sql})"), F.lit(False)), F.lit(name)) for name, sql in conditions.items())))
    rows = df.select(*by, F.col(key).alias("_key"), F.explode(met).alias("condition")).filter("_key IS NOT NULL")
    return rows.groupBy(*by, "condition").agg(F.theta_sketch_agg("_key", F.lit(size)).alias("customers"))


def level_sketches(df: DataFrame, cols: Sequence[str], key: str, by: Sequence[str] = ("dt",), size: int = HLL_SIZE) -> DataFrame:
    """(by..., feature, level, customers): HLL sketches of the keys with each level."""
    rows = long_levels(df, cols, [*by, F.col(key).alias("_key")]).filter("level IS NOT NULL")
    return rows.groupBy(*by, "feature", "level").agg(F.hll_sketch_agg("_key", F.lit(size)).alias("customers"))


def distinct_customers(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by..., customers) of HLL sketches, merged over all other columns."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("customers")).alias("customers"))


def _merged(sketches: DataFrame, month: str, wanted: Mapping[str, tuple[str, Sequence[int]]]) -> DataFrame:
    """One row with, for each (name, (condition, months)), a column ``name_<place>`` per month; no customers give an empty sketch."""
    cells = []
    for name, (condition, months) in wanted.items():
        for i, m in enumerate(months):
            here = (F.col("condition") == condition) & (F.col(month) == m)
            cells.append(F.theta_union_agg(F.when(here, F.col("customers"))).alias(f"{name}_{i}"))
    return sketches.agg(*cells)


def cohort_estimates(sketches: DataFrame, at: int, window: Sequence[int], month: str = "dt", base: str = "eligible", left: str = "left", clean: str = "clean") -> DataFrame:
    """(measure, customers): eligible at ``at``, of those leaving in any and clean in every month of ``window``.

    ``sketches`` are those of :func:`key_sketches` with the three conditions; no row of the
    snapshot is read.
    """
    window = list(window)
    one = _merged(sketches, month, {"base": (base, [at]), "left": (left, window), "clean": (clean, window)})
    over = lambda name, merge: reduce(merge, [F.col(f"{name}_{i}") for i in range(len(window))])
    now, gone, stayed = F.col("base_0"), over("left", F.theta_union), over("clean", F.theta_intersection)
    sets = {"eligible": now, "left": F.theta_intersection(now, gone), "stayed": F.theta_intersection(now, stayed), "lost_sight_of": F.theta_difference(now, gone)}
    rows = [F.struct(F.lit(n).alias("measure"), F.theta_sketch_estimate(c).cast("bigint").alias("customers")) for n, c in sets.items()]
    return one.select(F.inline(F.array(*rows)))
