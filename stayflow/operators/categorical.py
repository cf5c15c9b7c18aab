"""Categorical features: grouping columns, level statistics, encoders, interactions."""
from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from stayflow.functions.columns import bins, just_above, label_at, map_levels, ratio, row_argmax, row_max, row_mean, row_sum
from stayflow.operators.levels import ROW, numbered
from stayflow.operators.ordered import running_totals
from stayflow.operators.stage import Fitted, load_state, save_state
from stayflow.operators.stats import group_level_shares, group_number_stats, long_levels
from stayflow.session import materialize

#: level maps up to this many entries become expressions, larger ones a join
LITERAL_LEVELS = 500

_INF = float("inf")

# --- grouping features (bins) ---

# Income bands and their midpoints in dollars; UNKNOWN gets the commonest band.
INCOME_MIDPOINT = {
    "a.$1-$14,999": 8000, "b.$15k-$24": 20000, "c.$25k-$34": 30000, "d.$35k-$49": 43000,
    "e.$50k-$74": 63000, "f.$75k-$99": 88000, "g.$100k-$124": 113000, "h.$125k-$149": 138000,
    "i.$150k-$174": 163000, "j.$175k-$199": 188000, "k.$200k-$249": 225000, "l.$250k+": 300000,
    "UNKNOWN": 63000,
}

# Edges and labels of the payment-to-income bins, in percent.
INCOME_SHARE_EDGES = (-1, 1, 2, 3, 4, 5, 7, 10, 15, 20, _INF)
INCOME_SHARE_LABELS = (
    "Under 1 pct", "1 ~ 1.99 pct", "2 ~ 2.99 pct", "3 ~ 3.99 pct", "4 ~ 4.99 pct", "5 ~ 6.99 pct",
    "7 ~ 9.99 pct", "10 ~ 14.99 pct", "15 ~ 19.99 pct", "Over 20 pct",
)


def step_bins(start: int, stop: int, step: int, unit: str, first: str) -> tuple[list[float], list[str]]:
    """Open below ``start`` and above the last edge; edges every ``step`` up to ``stop``."""
    edges = list(range(start, stop + 1, step))
    span = (lambda e: f"{e + 1} {unit}") if step == 1 else (lambda e: f"{e + 1} ~ {e + step} {unit}")
    return [-_INF, *edges, _INF], [first, *[span(e) for e in edges]]


def change_bins(limit: int, step: int, unit: str, last: int | None = None) -> tuple[list[float], list[str]]:
    """Bins of a signed change: losses, exactly zero (above -0.001), gains.

    ``last`` is the first gain edge when the gains start off the step grid.
    """
    losses = list(range(-limit, 0, step))
    gains = list(range(last or step, limit + 1, step))
    zero = "0 Dollar" if unit == "Dollars" else "0 Pct"
    edges = [-_INF, *losses, -0.001, 0, *gains, _INF]
    labels = [
        f"Under -{limit} {unit}",
        *[f"{e} ~ {e + step - 1} {unit}" for e in losses],
        zero,
        *[f"{e + 1} ~ {e + step} {unit}" for e in range(0, limit, step)],
        f"Over {limit} {unit}",
    ]
    return edges, labels


def call_bins(wide: bool) -> tuple[list[float], list[str]]:
    """Call totals: pairs up to 10 when ``wide``, single calls up to 4 otherwise."""
    if wide:
        return [-2, 0, 2, 4, 6, 8, 10, _INF], ["0 Call", *[f"{e + 1} ~ {e + 2} Calls" for e in range(0, 9, 2)], "10+ Calls"]
    return [-1, 0, 1, 2, 3, 4, _INF], ["0 Call", *[f"{e + 1} Calls" for e in range(4)], "4+ Calls"]


def payment_bins(step: int) -> tuple[list[float], list[str]]:
    # the edge that closes the last full step stays open, as labels and edges must pair up
    edges = list(range(50, 250, step))
    return [-_INF, *edges, _INF], ["Under 50 Dollars", *[f"{e + 1} ~ {e + step} Dollars" for e in edges]]


def payment_income_ratio(payments: Sequence[Column], income: Column) -> Column:
    """Annualised mean payment as a percentage of the income midpoint."""
    return ratio(F.lit(100 * 12) * row_mean(payments), map_levels(income, INCOME_MIDPOINT))


def make_group_features(
    tenure: str = "kom_tenure",
    methods: Sequence[str] = ("autpay", "credit", "debit", "cash", "center", "check"),
    method_suffix: str = "_payments_6m",
    payments: Sequence[str] = tuple(f"revenue_m{k}" for k in range(1, 7)),
    change: str = "ttl_rev_abs_change_6m",
    change_pct: str = "ttl_rev_perc_change_6m",
    income: str = "income_demos",
    calls: Mapping[str, tuple[Sequence[str], bool]] | None = None,
) -> Fitted:
    """Sixteen grouping features; what several of them share is projected first."""
    paid = [F.col(c) for c in payments]
    if calls is None:
        calls = {
            "csc": ([f"csc_m{k}" for k in range(1, 7)], True),
            "bill": ([f"bill_m{k}" for k in range(1, 7)], False),
            "csr": ([f"csr_no_of_calls_m{k}" for k in range(1, 7)], True),
            "tsr": ([f"tsr_no_of_calls_m{k}" for k in range(1, 7)], False),
        }
    helpers = {
        "_top": row_max([F.col(n + method_suffix) for n in methods]),
        "_paid": row_mean(paid),
        "_share": payment_income_ratio(paid, F.col(income)),
        **{f"_calls_{n}": row_sum([F.col(c) for c in cs]) for n, (cs, _) in calls.items()},
    }
    binned: dict[str, tuple[str, tuple]] = {
        **{f"grp_tenure_{k}m": (tenure, step_bins(12, 96, k, "Months", "Under 12 Months")) for k in (3, 1, 6)},
        **{f"grp_payment_{k}dollar": ("_paid", payment_bins(k)) for k in (25, 10)},
        "grp_payment_change_5dollar": (change, change_bins(50, 5, "Dollars")),
        "grp_payment_change_10dollar": (change, change_bins(50, 10, "Dollars", last=5)),
        "grp_payment_change_2pct": (change_pct, change_bins(20, 2, "Pct")),
        "grp_payment_change_5pct": (change_pct, change_bins(30, 5, "Pct")),
        "grp_payment_income": ("_share", (INCOME_SHARE_EDGES, INCOME_SHARE_LABELS)),
        **{f"grp_call_{n}": (f"_calls_{n}", call_bins(w)) for n, (_, w) in calls.items()},
    }
    out = {
        "grp_payment_method": row_argmax({n.upper(): F.col(n + method_suffix) for n in methods}, F.col("_top")),
        "ratio_payment_income": F.col("_share"),
    }
    buckets = {}
    for name, (column, (edges, labels)) in binned.items():
        cuts, names = bins(edges, labels)
        buckets[f"_{name}"] = (column, just_above(cuts))
        index = F.col(f"_{name}")  # the bucket after the last one holds NaN
        out[name] = label_at(index, names)
    return Fitted(out, helpers=helpers, buckets=buckets)


# --- level statistics and encoders ---


def level_stats(df: DataFrame, cols: Sequence[str], label: str | None = None) -> DataFrame:
    """(feature, level, n, share, y_mean): the encoders' numbers in one shuffle of counts.

    Rows are counted on the map side before anything moves, so a level shared by a
    third of the customers is a handful of partial counts. The totals come from a
    second aggregate and not a window, as a feature may have any number of levels.
    """
    rows = long_levels(df, cols, [F.col(label).cast("double").alias("_y")] if label else []).filter("level IS NOT NULL")
    y = [F.sum("_y").alias("y")] if label else []
    counts = rows.groupBy("feature", "level").agg(F.count(F.lit(1)).alias("n"), *y)
    totals = counts.groupBy("feature").agg(F.sum("n").alias("_total"))
    out = counts.join(F.broadcast(totals), "feature").withColumn("share", ratio(F.col("n"), F.col("_total"))).drop("_total")
    return out.withColumn("y_mean", ratio(F.col("y"), F.col("n"))).drop("y") if label else out


def level_order(stats: DataFrame) -> DataFrame:
    """Adds ``rate_place``, the 0-based place of a level by mean outcome, level on ties."""
    one = stats.withColumn("_one", F.lit(1).cast("bigint"))
    ranked = running_totals(one, [F.col("y_mean"), F.col("level")], ["_one"], ["feature"])
    return ranked.withColumnRenamed("_one_before", "rate_place").drop("_one")


# The floor put in place of zero odds.
ODDS_FLOOR = 0.00001


def encoder_values(stats: DataFrame, method: str) -> tuple[DataFrame, float]:
    """(feature, level, code) and the value of a level never seen in training."""
    p1, p0 = F.col("y_mean"), 1 - F.col("y_mean") if "y_mean" in stats.columns else None
    floor = lambda p: F.when(p <= 0, F.lit(ODDS_FLOOR)).otherwise(p)
    codes = {
        "pct": lambda: F.col("share"),
        "count": lambda: F.col("n").cast("double"),
        "ordinal": lambda: F.col("rate_place").cast("double"),
        "y_mean": lambda: p1,
        "y_log_ratio": lambda: F.log(floor(p1) / floor(p0)),
        "y_ratio": lambda: p1 / floor(p0),
    }
    if method not in codes:
        raise ValueError(f"unknown encoding {method!r}")
    if method == "ordinal":
        stats = level_order(stats)
    unseen = math.log(ODDS_FLOOR / (1 - ODDS_FLOOR)) if method == "y_log_ratio" else 0.0
    return stats.select("feature", "level", codes[method]().alias("code")), unseen


def apply_codes(df: DataFrame, cols: Sequence[str], codes: DataFrame, default: Column | Mapping[str, Column], out=lambda c: c) -> DataFrame:
    """Replace each level by its code; ``default``, one for all or one for each column,
    stands for levels not listed and for codes that are null.

    The codes are written once. A short list becomes plain expressions; a long one is
    joined once for all columns, and the join strategy is left to the size Spark sees at run
    time. Both forms give the same values.
    """
    missing = default if isinstance(default, Mapping) else {c: default for c in cols}
    codes = materialize(codes, "codes")  # a fit is computed once
    rows = codes.limit(LITERAL_LEVELS + 1).collect()
    if len(rows) <= LITERAL_LEVELS:
        maps: dict[str, dict] = {c: {} for c in cols}
        for r in rows:
            if r["feature"] in maps:
                maps[r["feature"]][r["level"]] = r["code"]
        return df.withColumns({out(c): F.coalesce(map_levels(F.col(c).cast("string"), maps[c], missing[c]), missing[c]) for c in cols})
    # one join for all columns: rows as (row, column, level), gathered to one row of codes again
    rows = numbered(df)
    found = long_levels(rows, cols, [ROW]).join(codes.select("feature", "level", "code"), ["feature", "level"])
    wide = found.groupBy(ROW).agg(*(F.max(F.when(F.col("feature") == c, F.col("code"))).alias(f"_code_{i}") for i, c in enumerate(cols)))
    joined = rows.join(wide, ROW, "left")
    named = {out(c): F.coalesce(F.col(f"_code_{i}"), missing[c]) for i, c in enumerate(cols)}
    return joined.withColumns(named).drop(ROW, *(f"_code_{i}" for i in range(len(cols))))


@dataclass(frozen=True)
class LevelCodes:
    """A fitted encoder: (feature, level, code), and the value of other levels by column.

    Stored and loaded as two small tables, and applied without the training table.
    """

    codes: DataFrame
    defaults: Mapping[str, object]
    prefix: str | None = None

    def apply(self, df: DataFrame) -> DataFrame:
        kind = self.codes.schema["code"].dataType
        missing = {c: F.lit(v).cast(kind) for c, v in self.defaults.items()}
        return apply_codes(df, list(missing), self.codes, missing, lambda c: f"{self.prefix}_{c}" if self.prefix else c)

    def save(self, path: str) -> None:
        self.codes.write.mode("overwrite").parquet(f"{path}/codes")
        save_state(self.codes.sparkSession, {"defaults": dict(self.defaults), "prefix": self.prefix}, f"{path}/defaults")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "LevelCodes":
        kept = load_state(spark, f"{path}/defaults")
        return cls(spark.read.parquet(f"{path}/codes"), kept["defaults"], kept["prefix"])


def fit_encoder(train: DataFrame, cols: Sequence[str], method: str, label: str | None = None, prefix: str | None = None) -> LevelCodes:
    codes, unseen = encoder_values(level_stats(train, cols, label), method)
    return LevelCodes(codes, {c: unseen for c in cols}, prefix)


def encode(df: DataFrame, train: DataFrame, cols: Sequence[str], method: str, label: str | None = None, prefix: str | None = None) -> DataFrame:
    """Fit on ``train``, apply to ``df``; adds or replaces one column per feature."""
    return fit_encoder(train, cols, method, label, prefix).apply(df)


def kept_levels(stats: DataFrame, min_pct: float = 0.01, max_count: int = 20) -> DataFrame:
    """The ``max_count`` commonest levels of each feature that also reach ``min_pct``.

    ``place`` ranks them by count. The rank limit is applied before the shuffle, so a
    feature with very many levels still sends few of them.
    """
    by_size = Window.partitionBy("feature").orderBy(F.desc("n"), F.asc("level"))
    ranked = stats.withColumn("place", F.row_number().over(by_size)).filter(F.col("place") <= max_count)
    return ranked.filter(F.col("share") >= min_pct)


def reduce_rare(df: DataFrame, train: DataFrame, cols: Sequence[str], min_pct: float = 0.01, max_count: int = 20, method: str | None = None, other: str = "all_other") -> DataFrame:
    """Rare and missing levels become ``other``, or the commonest level for 'common'."""
    return fit_rare(train, cols, min_pct, max_count, method, other).apply(df)


def fit_rare(train: DataFrame, cols: Sequence[str], min_pct: float = 0.01, max_count: int = 20, method: str | None = None, other: str = "all_other") -> LevelCodes:
    kept = kept_levels(level_stats(train, cols), min_pct, max_count)
    if method is None:
        return LevelCodes(kept.select("feature", "level", F.col("level").alias("code")), {c: other for c in cols})
    if method != "common":
        raise ValueError("method is None or 'common'")
    kept = materialize(kept, "kept-levels")  # read for the commonest levels and again as codes
    top = {r["feature"]: r["level"] for r in kept.filter("place = 1").collect()}  # one per feature
    codes = kept.select("feature", "level", F.col("level").alias("code"))
    return LevelCodes(codes, {c: top.get(c) for c in cols})


def clamp_levels(df: DataFrame, train: DataFrame, cols: Sequence[str], other: str = "ALL_OTHER") -> DataFrame:
    """Levels not present in training become ``other``; missing counts as not present."""
    return fit_clamp(train, cols, other).apply(df)


def fit_clamp(train: DataFrame, cols: Sequence[str], other: str = "ALL_OTHER") -> LevelCodes:
    seen = long_levels(train, cols).filter("level IS NOT NULL").distinct()
    return LevelCodes(seen.select("feature", "level", F.col("level").alias("code")), {c: other for c in cols})


def interaction_names(first: Sequence[str], second: Sequence[str]) -> list[tuple[str, str, str]]:
    """(name, a, b) for each unordered pair once, the first list's member in front."""
    out: list[tuple[str, str, str]] = []
    taken: set[str] = set()
    for a in sorted(first):
        for b in sorted(second):
            if a != b and f"{b.upper()}-{a}" not in taken:
                taken.add(f"{a.upper()}-{b}")
                out.append((f"{a.upper()}-{b}", a, b))
    return out


def interactions(first: Sequence[str], second: Sequence[str], missing: str = "None") -> Fitted:
    """Pair levels joined by ``___``; a missing side reads as ``'None'``."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(missing))
    return Fitted({n: F.concat(text(a), F.lit("___"), text(b)) for n, a, b in interaction_names(first, second)})


# --- group aggregates ---


def group_aggregates(train: DataFrame, group: str, numbers: Sequence[str], texts: Sequence[str], max_levels: int = 31) -> DataFrame:
    """Long form (grp, name, value) of all number statistics and level shares per group."""
    stats = ["count", "mean", "median", "max", "min", "std", "sum"]
    tag = f"{group.upper()}__*__"
    wide = group_number_stats(train, group, numbers)
    cells = F.array(*[F.struct(F.concat(F.lit(tag), "feature", F.lit(f"__*__{s}")).alias("name"), F.col(s).cast("double").alias("value")) for s in stats])
    out = wide.select("grp", F.inline(cells))
    if texts:
        shares = group_level_shares(train, group, texts, max_levels)
        out = out.unionByName(
            shares.select("grp", F.concat(F.lit(tag), "feature", F.lit("__*__"), "level").alias("name"), F.col("share").alias("value"))
        )
    return out


def group_feature_correlation(aggregates: DataFrame, train: DataFrame, group: str, label: str = "status") -> DataFrame:
    """Correlation with the target of each aggregate as a row-level feature.

    The feature is constant inside a group, so group sizes and outcome sums are all
    the row data it needs: nothing is joined back to find out what to keep.
    """
    sizes = (
        train.groupBy(F.col(group).cast("string").alias("grp"))
        .agg(F.count(label).alias("n"), F.sum(label).cast("double").alias("y"))
        .filter("grp IS NOT NULL")
    )
    j = aggregates.filter("value IS NOT NULL").join(sizes, "grp")
    # centre each feature first: raw squares of large values would lose digits
    means = j.groupBy("name").agg((F.sum(F.col("n") * F.col("value")) / F.sum("n")).alias("m"))
    d = j.join(means, "name").withColumn("d", F.col("value") - F.col("m"))
    sums = d.groupBy("name").agg(
        F.sum("n").alias("n"),
        F.sum("y").alias("y"),
        F.sum(F.col("n") * F.col("d") * F.col("d")).alias("dd"),
        F.sum(F.col("d") * F.col("y")).alias("dy"),
    )
    spread = F.sqrt(F.col("dd") * (F.col("y") - F.col("y") * F.col("y") / F.col("n")))
    return sums.select("name", ratio(F.col("dy"), spread).alias("corr"))


@dataclass(frozen=True)
class GroupFeatures:
    """Aggregates worth keeping of one group column: (grp, one column per name)."""

    group: str
    names: list[str]
    values: DataFrame


def fit_group_features(
    train: DataFrame, groups: Sequence[str], numbers: Sequence[str], texts: Sequence[str], label: str = "status",
    correlation_threshold: float = 0.01, max_levels: int = 31, values_of: DataFrame | None = None,
) -> list[GroupFeatures]:
    """The aggregates of each group whose correlation with the target reaches the threshold.

    They are found once and written; ``values_of`` gives other rows to take the values from.
    """
    out = []
    for g in sorted(groups):
        nums, txts = [c for c in numbers if c != g], [c for c in texts if c != g]
        aggs = materialize(group_aggregates(train, g, nums, txts, max_levels), "group-aggregates")
        strong = group_feature_correlation(aggs, train, g, label).filter(F.abs("corr") >= correlation_threshold)
        kept = sorted(r["name"] for r in strong.collect())  # feature names
        if kept:
            values = aggs if values_of is None else group_aggregates(values_of, g, nums, txts, max_levels)
            out.append(GroupFeatures(g, kept, values.filter(F.col("name").isin(kept)).groupBy("grp").pivot("name", kept).agg(F.first("value"))))
    return out


def join_group_features(df: DataFrame, fitted: Sequence[GroupFeatures], keep: Sequence[str | Column]) -> DataFrame:
    """``keep`` and the aggregates of each row's groups; 0 where a group is not known."""
    for f in fitted:
        df = df.join(f.values, F.col(f.group).cast("string") == F.col("grp"), "left").drop("grp")
    return df.select(*keep, *[F.coalesce(F.col(f"`{n}`"), F.lit(0.0)).alias(n) for f in fitted for n in f.names])


def group_feature_cells(df: DataFrame, fitted: Sequence[GroupFeatures], keep: Sequence[str]) -> DataFrame:
    """(keep..., name, value): the kept aggregates in long form; no rows where none was kept."""
    cells = "array<struct<name:string,value:double>>"
    wide = join_group_features(df, fitted, keep)
    pairs = [F.struct(F.lit(n).alias("name"), F.col(f"`{n}`").cast("double").alias("value")) for f in fitted for n in f.names]
    return wide.select(*keep, F.inline(F.array(*pairs).cast(cells)))


def group_aggregate_features(
    df: DataFrame,
    train: DataFrame,
    groups: Sequence[str],
    numbers: Sequence[str],
    texts: Sequence[str],
    label: str = "status",
    correlation_threshold: float = 0.01,
    max_levels: int = 31,
    keep: Sequence[str] = ("chc_id",),
    refit: bool = False,
) -> DataFrame:
    """Aggregates of each group joined back to its rows, only those worth keeping.

    Fitted on ``train``; ``refit=True`` recomputes the values (not the choice) on ``df``.
    """
    fitted = fit_group_features(train, groups, numbers, texts, label, correlation_threshold, max_levels, df if refit else None)
    return join_group_features(df, fitted, keep)


# --- the categorical pipeline ---

METHODS = ("pct", "count", "ordinal", "y_mean", "y_log_ratio", "y_ratio")


def encoder_codes(train: DataFrame, cols: Sequence[str], label: str = "status", methods: Sequence[str] = METHODS, one_hot: bool = False) -> DataFrame:
    """(feature, level, n, y, total, ones, name, branch, code) of every encoder output, from
    one set of level counts; ``total`` and ``ones`` are the feature's rows and outcomes.

    A one-hot output has a single row: its level, code 1. All other rows of it are 0.
    """
    stats = level_order(level_stats(train, cols, label)).withColumn("y", F.round(F.col("n") * F.col("y_mean")))
    totals = stats.groupBy("feature").agg(F.sum("n").alias("total"), F.sum("y").alias("ones"))
    stats = stats.join(F.broadcast(totals), "feature")  # one row per feature
    p1, p0 = F.col("y_mean"), 1 - F.col("y_mean")
    floor = lambda p: F.when(p <= 0, F.lit(ODDS_FLOOR)).otherwise(p)
    codes = {
        "pct": F.col("share"), "count": F.col("n").cast("double"), "ordinal": F.col("rate_place").cast("double"), "y_mean": p1,
        "y_log_ratio": F.log(floor(p1) / floor(p0)), "y_ratio": p1 / floor(p0),
    }
    cells = [F.struct(F.concat(F.lit(m.upper() + "_"), "feature").alias("name"), F.lit(m).alias("branch"), codes[m].alias("code")) for m in methods]
    if one_hot:
        cells.append(F.struct(F.concat_ws("_", "feature", "level").alias("name"), F.lit("one_hot").alias("branch"), F.lit(1.0).alias("code")))
    return stats.select("feature", "level", "n", "y", "total", "ones", F.inline(F.array(*cells)))


def encoder_correlations(df: DataFrame, cols: Sequence[str], label: str = "status", min_pct: float = 0.01, max_count: int = 30, methods: Sequence[str] = METHODS) -> DataFrame:
    """Correlation with the target of every encoder output of the reduced levels.

    An output is constant within a level, so the level counts hold all it takes: the
    thousands of candidate columns are never built.
    """
    rows = reduce_rare(df, df, cols, min_pct, max_count)
    return _code_correlations(encoder_codes(rows, cols, label, methods)).select("name", "corr")


def _code_correlations(codes: DataFrame) -> DataFrame:
    """(name, branch, corr) from the rows of each level; levels without a row have code 0."""
    means = codes.groupBy("name").agg((F.sum(F.col("n") * F.col("code")) / F.max("total")).alias("_m"))
    d = codes.join(means, "name").withColumn("_d", F.col("code") - F.col("_m"))
    sums = d.groupBy("name", "branch").agg(
        F.max("total").cast("double").alias("n"), F.max("ones").alias("y"),
        (F.sum(F.col("n") * F.col("_d") * F.col("_d")) + F.max("_m") * F.max("_m") * (F.max("total") - F.sum("n"))).alias("dd"),
        (F.sum(F.col("_d") * F.col("y")) - F.max("_m") * (F.max("ones") - F.sum("y"))).alias("dy"),
    )
    return sums.select("name", "branch", ratio(F.col("dy"), F.sqrt(F.col("dd") * (F.col("y") - F.col("y") * F.col("y") / F.col("n")))).alias("corr"))


def categorical_pipeline(
    df: DataFrame,
    train: DataFrame,
    first: Sequence[str],
    second: Sequence[str],
    cols: Sequence[str],
    label: str = "status",
    key: str = "chc_id",
    target_threshold: float = 0.005,
    feature_threshold: float = 0.90,
    min_pct: float = 0.01,
    max_count: int = 30,
    tree_folds: int = 3,
    groups: Sequence[str] = (),
    numbers: Sequence[str] = (),
) -> DataFrame:
    """Interactions and rare levels, then branches side by side: every encoder, one-hot,
    trees over the ordinal codes, and aggregates of ``numbers`` and ``cols`` by ``groups``.

    Each branch is thinned by itself and the survivors together, and only those are
    built. ``tree_folds`` of 0 leaves the trees out. The encoders are screened on level
    counts, which are found once; the pair rule needs one pass over the rows.
    """
    from stayflow.operators.numeric import strong_enough, thin_branches
    from stayflow.operators.sampling import stratified_folds
    from stayflow.operators.stats import target_correlation
    from stayflow.operators.trees import fit_trees, tree_stage

    inter = interactions(first, second).outputs
    wide_cols = [*cols, *inter]
    fitted = fit_rare(train.withColumns(inter), wide_cols, min_pct, max_count)
    rare = LevelCodes(materialize(fitted.codes, "kept-levels"), fitted.defaults)

    def reduced(frame: DataFrame) -> DataFrame:
        return rare.apply(frame.withColumns(inter))

    codes = materialize(encoder_codes(reduced(train), wide_cols, label, one_hot=True), "encoder-codes")
    branch, corr = {}, {}
    for r in _code_correlations(codes).collect():  # one per output
        branch[r["name"]], corr[r["name"]] = r["branch"], r["corr"]
    strong = strong_enough(corr, target_threshold)
    ordinals = sorted(n for n in strong if branch[n] == "ordinal") if tree_folds else []
    maps: dict[str, tuple[str, dict]] = {}
    for r in codes.filter(F.col("name").isin(list(strong))).select("name", "feature", "level", "code").collect():  # at most max_count + 1 levels per feature
        maps.setdefault(r["name"], (r["feature"], {}))[1][r["level"]] = r["code"]
    unseen = {n: math.log(ODDS_FLOOR / (1 - ODDS_FLOOR)) if branch[n] == "y_log_ratio" else 0.0 for n in maps}
    encoded = {n: map_levels(F.col(f"`{feature}`"), pairs, F.lit(unseen[n])).alias(n) for n, (feature, pairs) in sorted(maps.items())}
    quoted = lambda names: [F.col(f"`{n}`") for n in names]

    trees: dict[str, Column] = {}
    if ordinals:
        rows = reduced(train).select(key, label, *(encoded[n] for n in ordinals))
        folds = materialize(stratified_folds(rows, tree_folds, key, label), "tree-folds")
        trees = dict(tree_stage(fit_trees(folds, ordinals, label, corr_threshold=target_threshold)).renamed(prefix="TREE").outputs)

    grouped = fit_group_features(reduced(train), groups, numbers, cols, label, target_threshold)
    aggregates = [n for f in grouped for n in f.names]

    def build(frame: DataFrame) -> DataFrame:
        """Key, label and all candidates."""
        rows = reduced(frame)
        rows = rows.select(*quoted(dict.fromkeys([key, label, *groups])), *encoded.values())
        rows = rows.select("*", *(c.alias(n) for n, c in trees.items()))
        return join_group_features(rows, grouped, quoted([key, label, *encoded, *trees]))

    frame = materialize(build(train), "candidates")
    late = [*trees, *aggregates]
    if late:
        simple = {n: f"_{i}" for i, n in enumerate(late)}  # level names may hold any sign
        view = frame.select(F.col(label), *(F.col(f"`{n}`").alias(s) for n, s in simple.items()))
        back = {s: n for n, s in simple.items()}
        found = {back[r["feature"]]: r["corr"] for r in target_correlation(view, list(back), label).collect()}
        strong |= strong_enough(found, target_threshold)
    branches = [[n for n in encoded if branch[n] == b] for b in (*METHODS, "one_hot")] + [list(trees), aggregates]
    names = thin_branches(frame.select(*quoted(strong)), strong, branches, feature_threshold)
    return (frame if df is train else build(df)).select(key, label, *quoted(names))
