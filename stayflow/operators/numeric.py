"""Numeric transforms. Each fit is one statistics pass; each result is a set of
expressions, so a union of many transforms is still a single ``select``."""
from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from stayflow.functions.columns import just_above, ratio, row_sum, tree_index
from stayflow.operators.quantiles import exact_quantiles
from stayflow.operators.stage import Fitted, build, builder, union
from stayflow.operators.stats import long_numbers, number, pair_correlations, per_column, target_correlation
from stayflow.operators import prep
from stayflow.session import materialize


def _x(c: str) -> Column:
    """The column as double, NaN read as missing."""
    return number(c)


def universal(cols: Sequence[str], function: Callable[[Column], Column]) -> Fitted:
    """A user function per column; a missing result becomes 0."""
    out = {}
    for c in cols:
        y = function(_x(c)).cast("double")
        out[c] = F.coalesce(F.when(~F.isnan(y), y), F.lit(0.0))
    return Fitted(out)


@builder("log1p")
def _log1p(cols: Sequence[str]) -> Fitted:
    return Fitted({c: F.when(_x(c) > -1, F.log1p(_x(c))).otherwise(F.lit(0.0)) for c in cols})


def log1p(cols: Sequence[str]) -> Fitted:
    """``ln(1 + x)``; missing and x <= -1 give 0."""
    return build("log1p", cols=list(cols))


def sqrt(cols: Sequence[str]) -> Fitted:
    """Square root; missing and negative values give 0."""
    return build("sqrt", cols=list(cols))


@builder("sqrt")
def _sqrt(cols: Sequence[str]) -> Fitted:
    return Fitted({c: F.when(_x(c) >= 0, F.sqrt(_x(c))).otherwise(F.lit(0.0)) for c in cols})


def reciprocal(cols: Sequence[str]) -> Fitted:
    """``1 / x``; missing and zero give 0."""
    return build("reciprocal", cols=list(cols))


@builder("reciprocal")
def _reciprocal(cols: Sequence[str]) -> Fitted:
    return Fitted({c: F.coalesce(ratio(F.lit(1.0), _x(c)), F.lit(0.0)) for c in cols})


def binarize(cols: Sequence[str], threshold: float = 0.0) -> Fitted:
    return build("binarize", cols=list(cols), threshold=threshold)


@builder("binarize")
def _binarize(cols: Sequence[str], threshold: float) -> Fitted:
    return Fitted({c: F.when(_x(c) > threshold, 1.0).otherwise(F.when(_x(c).isNotNull(), 0.0)) for c in cols})


def passthrough(cols: Sequence[str]) -> Fitted:
    return build("passthrough", cols=list(cols))


@builder("passthrough")
def _passthrough(cols: Sequence[str]) -> Fitted:
    return Fitted({c: F.col(c) for c in cols})


def _stat(df: DataFrame, cols: Sequence[str], **measures) -> dict[str, dict]:
    return {r["feature"]: r.asDict() for r in per_column(df, cols, measures).collect()}


Quantiles = Mapping[str, Mapping[float, float | None]]


def moments(df: DataFrame, cols: Sequence[str]) -> dict[str, dict]:
    """Everything the linear scalers need, in one pass; NaN counts as missing."""
    x = lambda c: F.nanvl(c.cast("double"), F.lit(None).cast("double"))
    return _stat(
        df, cols, mean=lambda c: F.avg(x(c)), sd=lambda c: F.stddev_pop(x(c)), lo=lambda c: F.min(x(c)), hi=lambda c: F.max(x(c))
    )


def quantile_table(df: DataFrame, cols: Sequence[str], *probs: Sequence[float]) -> Quantiles:
    """Exact quantiles at all the given probabilities, found together."""
    wanted = sorted({p for group in probs for p in group})
    return {c: dict(zip(wanted, v)) for c, v in exact_quantiles(df, cols, wanted).items()}


def _steps(n: int) -> list[float]:
    return [k / n for k in range(n + 1)]


def standard(df: DataFrame, cols: Sequence[str], with_mean: bool = True, with_std: bool = True, stats: dict | None = None) -> Fitted:
    """Population standard deviation; a constant column is divided by 1."""
    s = stats or moments(df, cols)
    mean = {c: s[c]["mean"] or 0.0 if with_mean else 0.0 for c in cols}
    return build("linear", shift=mean, size={c: s[c]["sd"] or 1.0 if with_std else 1.0 for c in cols})


@builder("linear")
def _linear(shift: Mapping[str, float], size: Mapping[str, float], low: float = 0.0, width: float = 1.0) -> Fitted:
    """``(x - shift) / size``, spread over ``width`` from ``low``."""
    scaled = {c: (_x(c) - shift[c]) / size[c] for c in shift}
    return Fitted({c: x * width + low if (low, width) != (0.0, 1.0) else x for c, x in scaled.items()})


def robust(df: DataFrame, cols: Sequence[str], quantile_range: tuple[float, float] = (25.0, 75.0), table: Quantiles | None = None) -> Fitted:
    """Centred on the median, divided by the quantile range (1 when it is zero)."""
    lo, hi = (p / 100 for p in quantile_range)
    q = table or quantile_table(df, cols, [lo, 0.5, hi])
    shift, size = {}, {}
    for c in cols:
        a, med, b = (q[c][p] for p in (lo, 0.5, hi))
        shift[c], size[c] = (0.0, 1.0) if med is None else (med, (b - a) or 1.0)
    return build("linear", shift=shift, size=size)


def minmax(df: DataFrame, cols: Sequence[str], feature_range: tuple[float, float] = (0.0, 1.0), stats: dict | None = None) -> Fitted:
    s = stats or moments(df, cols)
    low, high = feature_range
    ends = {c: (s[c]["lo"] or 0.0, s[c]["hi"] or 0.0) for c in cols}
    return build("linear", shift={c: a for c, (a, _) in ends.items()}, size={c: (b - a) or 1.0 for c, (a, b) in ends.items()}, low=float(low), width=float(high - low))


def maxabs(df: DataFrame, cols: Sequence[str], stats: dict | None = None) -> Fitted:
    s = stats or moments(df, cols)
    size = {c: max(abs(s[c]["lo"] or 0.0), abs(s[c]["hi"] or 0.0)) or 1.0 for c in cols}
    return build("linear", shift={c: 0.0 for c in cols}, size=size)


def normalize(cols: Sequence[str], norm: str = "l2") -> Fitted:
    """Each row divided by its norm over the given columns; a zero row stays."""
    return build("normalize", cols=list(cols), norm=norm)


@builder("normalize")
def _normalize(cols: Sequence[str], norm: str) -> Fitted:
    xs = [_x(c) for c in cols]
    size = {
        "l1": lambda: row_sum([F.abs(x) for x in xs]),
        "l2": lambda: F.sqrt(row_sum([x * x for x in xs])),
        "max": lambda: F.greatest(*[F.coalesce(F.abs(x), F.lit(0.0)) for x in xs]),
    }[norm]()
    return Fitted({c: F.when(size == 0, _x(c)).otherwise(ratio(_x(c), size)) for c in cols})


_TREE_CUTS = 64


def bucket_index(c: Column, cuts: Sequence[float]) -> Column:
    """How many cuts are <= c (left-closed buckets 0..len(cuts)); null and NaN give null.

    A balanced comparison tree keeps short cut lists inside generated code; long ones
    use a vectorised search on Arrow batches. Both give the same number for any value.
    """
    cuts = list(cuts)
    c = F.nanvl(c.cast("double"), F.lit(None).cast("double"))
    if len(cuts) > _TREE_CUTS:
        return _search(cuts)(c)

    return tree_index(c, cuts)


def _search(cuts: list[float]):
    edges = np.asarray(cuts, dtype="float64")

    @F.pandas_udf("int")
    def search(x: pd.Series) -> pd.Series:
        found = pd.Series(np.searchsorted(edges, x.to_numpy("float64"), side="right"), index=x.index, dtype="Int32")
        return found.mask(x.isna())

    return search


def qcut(c: Column, edges: Sequence[float]) -> Column:
    """1-based right-closed quantile bins with repeated edges merged: ``edges`` are the
    quantiles from minimum to maximum. A value's bin is 1 + the inner edges below it."""
    inner = sorted(set(edges))[1:-1]
    return right_closed_index(c, inner) + 1


def right_closed_index(c: Column, cuts: Sequence[float]) -> Column:
    """How many cuts are < c (right-closed buckets)."""
    return bucket_index(c, just_above(cuts))


def quantile(df: DataFrame, cols: Sequence[str], n_quantiles: int = 1000, table: Quantiles | None = None) -> Fitted:
    """Rank-like map to [0, 1] by interpolation between quantile landmarks.

    On a repeated landmark the result is the middle of its span.
    """
    steps = _steps(n_quantiles - 1)
    found = table or quantile_table(df, cols, steps)
    return build("quantile", landmarks={c: [found[c][p] for p in steps] for c in cols})


@builder("quantile")
def _quantile(landmarks: Mapping[str, Sequence[float | None]]) -> Fitted:
    known = [c for c, marks in landmarks.items() if marks[0] is not None]
    out: dict[str, Column] = {c: F.lit(None).cast("double") for c in landmarks}
    if known:
        # one Arrow pass for all columns: equal calls in a projection are evaluated once
        placed = _place_all([landmarks[c] for c in known])(F.struct(*(_x(c).alias(f"_{i}") for i, c in enumerate(known))))
        out |= {c: F.when(_x(c).isNotNull(), F.get(placed, F.lit(i))) for i, c in enumerate(known)}
    return Fitted(out)


def _place_all(landmarks: Sequence[Sequence[float]]):
    """The places of several columns between their landmarks, as one array per row."""
    marks = [np.asarray(m) for m in landmarks]
    refs = np.linspace(0.0, 1.0, len(marks[0]))

    @F.pandas_udf("array<double>")
    def place(x: pd.DataFrame) -> pd.Series:
        cells = np.empty((len(x), len(marks)))
        for i, m in enumerate(marks):
            v = x.iloc[:, i].to_numpy("float64")
            out = 0.5 * (np.interp(v, m, refs) - np.interp(-v, -m[::-1], -refs[::-1]))
            out[v <= m[0]] = 0.0
            out[v >= m[-1]] = 1.0
            cells[:, i] = out
        return pd.Series(list(cells), index=x.index)

    return place


def kbins(df: DataFrame, cols: Sequence[str], n_bins: int = 5, encode: str = "onehot", table: Quantiles | None = None) -> Fitted:
    """Quantile bins, left-closed, the last one closed; bins narrower than 1e-8 merged."""
    q = table or quantile_table(df, cols, _steps(n_bins))
    kept = {}
    for c in cols:
        edges = [q[c][p] for p in _steps(n_bins) if q[c][p] is not None]
        kept[c] = edges[:1] + [b for a, b in zip(edges, edges[1:]) if b - a > 1e-8]
    return build("kbins", edges=kept, encode=encode)


@builder("kbins")
def _kbins(edges: Mapping[str, Sequence[float]], encode: str) -> Fitted:
    out = {}
    for c, kept in edges.items():
        index = bucket_index(_x(c), kept[1:-1])
        if encode == "ordinal":
            out[c] = index.cast("double")
        else:
            for k in range(max(len(kept) - 1, 1)):
                out[f"{c}_{k}"] = F.when(index == k, 1.0).otherwise(0.0)
    return Fitted(out)


# The exponents tried by the power transform, -2 to 2 in steps of 0.25.
POWER_GRID = tuple(k / 4 for k in range(-8, 9))


def _yeo_johnson(x: Column, lam: Column | float) -> Column:
    lam = lam if isinstance(lam, Column) else F.lit(float(lam))
    up = F.when(lam == 0, F.log1p(x)).otherwise(F.try_divide(F.pow(x + 1, lam) - 1, lam))
    down = F.when(lam == 2, -F.log1p(-x)).otherwise(-F.try_divide(F.pow(1 - x, 2 - lam) - 1, 2 - lam))
    return F.when(x >= 0, up).otherwise(F.when(x < 0, down))


def _box_cox(x: Column, lam: Column | float) -> Column:
    lam = lam if isinstance(lam, Column) else F.lit(float(lam))
    return F.when(x > 0, F.when(lam == 0, F.log(x)).otherwise(F.try_divide(F.pow(x, lam) - 1, lam)))


def power(df: DataFrame, cols: Sequence[str], method: str = "yeo-johnson", grid: Sequence[float] = POWER_GRID) -> Fitted:
    """The exponent with the highest likelihood on a fixed grid, then standardised.

    The likelihood of an exponent needs a variance and one sum, so one aggregate with a
    row per column scores all exponents; a value is not copied for each of them.
    """
    f = _POWERS[method]
    x = F.col("value")
    jacobian = F.signum(x) * F.log1p(F.abs(x)) if method == "yeo-johnson" else F.log(F.when(x > 0, x))
    tried = [(float(g), f(x, float(g))) for g in grid]
    sums = [F.struct(F.count(t).alias("n"), F.avg(t).alias("m"), F.var_pop(t).alias("v")).alias(f"_{i}") for i, (_, t) in enumerate(tried)]
    found: dict[str, list] = {c: [] for c in cols}
    for r in long_numbers(df, cols).groupBy("feature").agg(F.sum(jacobian).alias("j"), *sums).collect():  # one row per column
        for i, (g, _) in enumerate(tried):
            n, m, v = r[f"_{i}"]
            if v and math.isfinite(v):
                found[r["feature"]].append((-n / 2 * math.log(v) + (g - 1) * r["j"], g, m, v))
    return build("power", method=method, chosen={c: list(max(found[c], default=(0.0, 1.0, 0.0, 1.0))[1:]) for c in cols})


_POWERS = {"yeo-johnson": _yeo_johnson, "box-cox": _box_cox}


@builder("power")
def _power(method: str, chosen: Mapping[str, Sequence[float]]) -> Fitted:
    """Exponent, mean and variance of each column."""
    return Fitted({c: (_POWERS[method](_x(c), lam) - m) / math.sqrt(v) for c, (lam, m, v) in chosen.items()})


def standard_set(df: DataFrame, cols: Sequence[str], n_quantiles: int = 100, kbins_n: int = 10) -> dict[str, Fitted]:
    """The twelve transforms of the numeric pipeline under their prefixes.

    They share one pass of moments and one search for quantiles.
    """
    s = moments(df, cols)
    q = quantile_table(df, cols, [0.05, 0.5, 0.95], _steps(n_quantiles - 1), _steps(kbins_n))
    made = {
        "Original": passthrough(cols),
        "Standard": standard(df, cols, stats=s),
        "Robust": robust(df, cols, (5.0, 95.0), table=q),
        "Quantile": quantile(df, cols, n_quantiles, table=q),
        "Binary": binarize(cols, 0),
        "MinMax": minmax(df, cols, stats=s),
        "MaxAbs": maxabs(df, cols, stats=s),
        "Norm": normalize(cols, "l1"),
        "KBin": kbins(df, cols, kbins_n, "ordinal", table=q),
        "Log1p": log1p(cols),
        "Sqrt": sqrt(cols),
        "Reciprocal": reciprocal(cols),
    }
    return {name: f.renamed(prefix=name) for name, f in made.items()}


def strong_enough(corr: Mapping[str, float | None], threshold: float) -> dict[str, float]:
    """The names whose correlation with the target reaches the threshold."""
    return {c: v for c, v in corr.items() if v is not None and round(abs(v), 9) >= threshold}


def thin_branches(frame: DataFrame, strong: Mapping[str, float], branches: Sequence[Sequence[str]], threshold: float) -> list[str]:
    """Survivors of the pair rule inside every branch, then among all of them, strongest first.

    One pass over ``frame`` finds the pairs above the threshold for both rounds; both are
    decided in Spark, and only names reach the driver.
    """
    branch = {n: i for i, names in enumerate(branches) for n in names if n in strong}
    order = prep.correlation_order({c: strong[c] for c in branch})
    if len(order) < 2:
        return order
    pairs = prep.late_of_pairs(pair_correlations(frame, order, least=threshold), order, strong)
    of = frame.sparkSession.createDataFrame(list(branch.items()), "name string, branch int")
    of = lambda x, df=of: F.broadcast(df.select(F.col("name").alias(x), F.col("branch").alias(f"{x}_branch")))  # noqa: E731 - one row per column
    pairs = pairs.join(of("drop_feature"), "drop_feature").join(of("corr_feature"), "corr_feature")
    pairs = materialize(pairs.select("drop_feature", "corr_feature", (F.col("drop_feature_branch") == F.col("corr_feature_branch")).alias("same")), "thin")
    gone = pairs.filter("same").select("drop_feature").distinct()
    stays = lambda c: gone.withColumnRenamed("drop_feature", c)
    across = pairs.join(stays("drop_feature"), "drop_feature", "left_anti").join(stays("corr_feature"), "corr_feature", "left_anti")
    out = {r["drop_feature"] for r in gone.unionByName(across.select("drop_feature")).distinct().collect()}
    return [c for c in order if c not in out]


def thinned_union(
    df: DataFrame, stages: dict[str, Fitted], label: str = "status", target_threshold: float = 0.005, feature_threshold: float = 0.90
) -> Fitted:
    """Many transforms side by side, each thinned, then thinned together.

    The outputs are built once and written. They are first screened against the label, so
    that only promising columns are compared with each other.
    """
    everything = union(*stages.values())
    names = list(everything.outputs)
    frame = materialize(everything.apply(df, [F.col(label).cast("double").alias("_label")]), "union")
    corr = {r["feature"]: r["corr"] for r in target_correlation(frame, names, "_label").collect()}
    strong = strong_enough({c: corr[c] for c in names}, target_threshold)
    return everything.only(thin_branches(frame, strong, [list(f.outputs) for f in stages.values()], feature_threshold))


def numeric_pipeline(
    df: DataFrame,
    cols: Sequence[str],
    label: str = "status",
    target_threshold: float = 0.005,
    feature_threshold: float = 0.90,
    n_quantiles: int = 100,
    extra: dict[str, Fitted] | None = None,
) -> Fitted:
    """The twelve standard transforms, and any ``extra`` such as trees, thinned twice."""
    return thinned_union(df, standard_set(df, cols, n_quantiles) | (extra or {}), label, target_threshold, feature_threshold)
