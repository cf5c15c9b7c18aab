"""Pre-processing: types, missing values, constant, correlated and duplicate columns.

The fits read statistics, never rows: each decision below is made on the driver from
a frame with one entry per column or pair of columns. Column choices follow the
rules literally, including two that surprise: a column drops only when its missing
share is *above* the threshold, and the correlation rule compares with every earlier
column, even one that is itself dropped.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from stayflow.catalog import NOT_FEATURES, Catalog
from stayflow.functions.columns import blank_to_null, clip
from stayflow.operators.columns import dummy_name
from stayflow.operators.quantiles import exact_quantiles
from stayflow.operators.stats import (
    blank_nan,
    categorical_columns,
    describe,
    few_valued,
    is_wide,
    long_levels,
    missing_pct,
    missing_share,
    numeric_columns,
    pair_correlations,
    per_column,
    target_correlation,
    unique_counts,
    wide_moments,
)
from stayflow.session import materialize


def blanks_to_null(df: DataFrame) -> DataFrame:
    """Blank text read as missing in every text column."""
    return df.withColumns({c: blank_to_null(F.col(c)) for c in categorical_columns(df)})


def dtype_report(df: DataFrame, catalog: Catalog, exclude: Sequence[str] = NOT_FEATURES) -> DataFrame:
    """Columns whose type disagrees with the catalogue, and what a cast would keep.

    Counts the values present, those that survive the cast, and the distinct ones.
    """
    numbers, texts = numeric_columns(df, exclude), categorical_columns(df, exclude)
    types = dict(df.dtypes)
    wrong = [(c, "NUM", types[c]) for c in texts if catalog.kinds.get(c) == "NUM"]
    wrong += [(c, "CAT", types[c]) for c in numbers if catalog.kinds.get(c) == "CAT"]
    names = df.sparkSession.createDataFrame(wrong, "feature string, default_dtype string, actual_dtype string")
    if not wrong:
        return names.selectExpr("*", "0L AS n", "0L AS n_convertible", "0L AS n_unique")
    cols = [c for c, _, _ in wrong]
    kinds = {c: k for c, k, _ in wrong}
    clean = df.select(*[(blank_to_null(F.col(c)) if c in texts else F.col(c)).alias(c) for c in cols])
    cast = clean.select(*[(F.col(c).try_cast("double") if kinds[c] == "NUM" else F.col(c)).alias(c) for c in cols])
    out = names.join(per_column(clean, cols, {"n": F.count}), "feature")
    out = out.join(per_column(cast, cols, {"n_convertible": F.count}), "feature")
    return out.join(unique_counts(clean, cols), "feature")


def use_default_types(df: DataFrame, catalog: Catalog, exclude: Sequence[str] = NOT_FEATURES) -> DataFrame:
    """Blank text to null, then text to number or number to text as the catalogue says."""
    numbers, texts = set(numeric_columns(df, exclude)), set(categorical_columns(df, exclude))

    def cast(c: str) -> Column:
        col = blank_to_null(F.col(c)) if c in categorical_columns(df) else F.col(c)
        if c in texts and catalog.kinds.get(c) == "NUM":
            col = col.try_cast("double")
        if c in numbers and catalog.kinds.get(c) == "CAT":
            col = col.cast("string")
        return col.alias(c)

    return df.select(*[cast(c) for c in df.columns])


@dataclass(frozen=True)
class Choice:
    """Columns kept and dropped by a fitted rule, with the numbers behind it."""

    kept: list[str]
    dropped: list[str]
    report: DataFrame

    def apply(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        return df.select(*keep, *[c for c in self.kept if c not in keep])


def _features(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    return sorted(c for c in df.columns if c not in exclude)


def drop_missing(df: DataFrame, threshold: float = 0.99, exclude: Sequence[str] = NOT_FEATURES) -> Choice:
    if not 0 <= threshold <= 1:
        raise ValueError("threshold must lie in [0, 1]")
    cols = _features(df, exclude)
    report = missing_pct(df, cols).withColumn("dropped", F.col("missing_pct") > threshold)
    gone = {r["feature"] for r in report.filter("dropped").collect()}
    return Choice([c for c in cols if c not in gone], sorted(gone), report)


def drop_constant(
    df: DataFrame, unique_threshold: int = 1, missing_threshold: float = 0.0, exclude: Sequence[str] = NOT_FEATURES
) -> Choice:
    """Few distinct values *and* hardly any missing; an all-null column stays."""
    cols = _features(df, exclude)
    few = few_valued(df, cols, unique_threshold)
    names = sorted(few)
    missing = {r["feature"]: r["missing_pct"] for r in missing_pct(df, names).collect()} if names else {}
    gone = sorted(c for c in names if missing[c] <= missing_threshold)
    rows = [(c, few[c], float(missing[c]), c in gone) for c in names]
    report = df.sparkSession.createDataFrame(rows, "feature string, n_unique bigint, missing_pct double, dropped boolean")
    return Choice([c for c in cols if c not in gone], gone, report)


def correlation_order(corr: Mapping[str, float | None]) -> list[str]:
    """Strongest correlation with the target first; equal ones by name, undefined last."""
    return sorted(corr, key=lambda c: (-round(abs(corr[c]), 9), c) if corr[c] is not None else (1.0, c))


def collinear(order: Sequence[str], pairs: Mapping[frozenset, float | None], threshold: float) -> list[tuple[str, str, float]]:
    """(dropped, earlier column, r) for every pair above the threshold, in order."""
    place = {c: i for i, c in enumerate(order)}
    hits = []
    for pair, r in pairs.items():
        if r is not None and round(abs(r), 9) > threshold and len(pair) == 2 and all(c in place for c in pair):
            early, late = sorted(pair, key=place.get)
            hits.append((place[late], place[early], late, early, r))
    return [(late, early, r) for _, _, late, early, r in sorted(hits)]


def drop_correlated(
    df: DataFrame, threshold: float = 0.90, label: str | None = None, exclude: Sequence[str] = NOT_FEATURES
) -> Choice:
    if not 0 <= threshold <= 1:
        raise ValueError("threshold must lie in [0, 1]")
    numbers = sorted(numeric_columns(df, exclude))
    return _drop_collinear(df, numbers, threshold, label, exclude)


def drop_irrelevant_collinear(
    df: DataFrame,
    target_threshold: float = 0.005,
    feature_threshold: float = 0.90,
    label: str = "status",
    exclude: Sequence[str] = NOT_FEATURES,
) -> Choice:
    """Columns weakly correlated with the target go first, then the collinear ones."""
    numbers = [c for c in _features(df, exclude) if c in numeric_columns(df)]
    corr = {r["feature"]: r["corr"] for r in target_correlation(df, numbers, label).collect()}
    strong = [c for c in numbers if corr[c] is not None and round(abs(corr[c]), 9) >= target_threshold]
    return _drop_collinear(df, strong, feature_threshold, label, exclude, weak=[c for c in numbers if c not in strong])


def _drop_collinear(df, numbers, threshold, label, exclude, weak=()) -> Choice:
    center = None
    if label is None:
        corr: dict[str, float | None] = {}
        order = list(numbers)
    else:
        center = wide_moments(df, [label, *numbers]) if is_wide(numbers) else None  # both correlations shift and scale by them
        corr = {r["feature"]: r["corr"] for r in target_correlation(df, numbers, label, center=center).collect()} if numbers else {}
        order = correlation_order(corr)
    report = late_of_pairs(pair_correlations(df, order, center=center, least=threshold), order, corr)
    report = materialize(report, "collinear")
    gone = sorted({r["drop_feature"] for r in report.select("drop_feature").distinct().collect()} | set(weak))  # column names
    return Choice([c for c in _features(df, exclude) if c not in gone], gone, report)


def late_of_pairs(pairs: DataFrame, order: Sequence[str], corr: Mapping[str, float | None]) -> DataFrame:
    """For each pair the later column in ``order``, which goes, and the earlier one.

    Decided in Spark: of ten thousand columns, millions of pairs may exceed a threshold.
    """
    places = pairs.sparkSession.createDataFrame([(c, i, corr.get(c)) for i, c in enumerate(order)], "name string, place int, r double")
    side = lambda x: places.select(*(F.col(c).alias(f"{c}_{x}") for c in places.columns))
    both = pairs.join(F.broadcast(side("a")), F.col("col_a") == F.col("name_a")).join(F.broadcast(side("b")), F.col("col_b") == F.col("name_b"))  # one row per column
    a_first = F.col("place_a") < F.col("place_b")
    late = lambda x, y: F.when(a_first, F.col(y)).otherwise(F.col(x))
    return both.select(
        late("name_a", "name_b").alias("drop_feature"), late("name_b", "name_a").alias("corr_feature"), F.col("corr").alias("pairwise_corr"),
        late("r_a", "r_b").alias("corr_drop_target"), late("r_b", "r_a").alias("corr_kept_target"),
    )


def drop_duplicate_columns(
    df: DataFrame, key: str = "chc_id", numbers: bool = False, exclude: Sequence[str] = NOT_FEATURES
) -> Choice:
    """The later of two equal columns goes; number columns only on request.

    One pass takes a fingerprint of every column; only columns whose fingerprints
    agree are then compared value by value, in one more pass.
    """
    groups = [[c for c in _features(df, exclude) if c in categorical_columns(df)]]
    if numbers:
        groups.append([c for c in _features(df, exclude) if c in numeric_columns(df)])
    cols = [c for g in groups for c in g]
    types = dict(df.dtypes)
    prints = {r["feature"]: r["print"] for r in per_column(df, cols, {"print": lambda c: F.bit_xor(F.xxhash64(F.col(key), c))}).collect()} if cols else {}
    pairs = [
        (a, b)
        for g in groups
        for i, a in enumerate(g)
        for b in g[i + 1 :]
        if types[a] == types[b] and prints[a] == prints[b]
    ]
    same = [F.bool_and(F.col(a).eqNullSafe(F.col(b))).alias(f"p{i}") for i, (a, b) in enumerate(pairs)]
    checked = df.agg(*same).first() if same else []
    hits = [(b, a) for i, (a, b) in enumerate(pairs) if checked[i]]
    gone = sorted({b for b, _ in hits})
    report = df.sparkSession.createDataFrame(hits, "drop_feature string, duplicate_feature string")
    return Choice([c for c in _features(df, exclude) if c not in gone], gone, report)


def impute(df: DataFrame, catalog: Catalog, exclude: Sequence[str] = NOT_FEATURES) -> DataFrame:
    """Blank to null, gaps filled from the catalogue, types as the catalogue says."""
    typed = blank_nan(use_default_types(df, catalog, exclude), [c for c in df.columns if c not in exclude])
    types = dict(typed.dtypes)

    def fill(c: str) -> Column:
        if c in exclude or catalog.defaults.get(c) is None:
            return F.col(c)
        return F.coalesce(F.col(c), F.lit(catalog.defaults[c]).cast(types[c])).alias(c)

    return typed.select(*[fill(c) for c in typed.columns])


def impute_summary(df: DataFrame, catalog: Catalog, exclude: Sequence[str] = NOT_FEATURES) -> DataFrame:
    """Per column: the default, and missing share, mean and sd before and after."""
    before, after = use_default_types(df, catalog, exclude), impute(df, catalog, exclude)
    cols = _features(df, exclude)
    numbers = [c for c in cols if c in numeric_columns(before)]
    defaults = df.sparkSession.createDataFrame([(c, str(catalog.defaults.get(c))) for c in cols], "feature string, default_value string")
    out = defaults
    for tag, frame in (("before", before), ("after", after)):
        out = out.join(missing_pct(frame, cols).withColumnRenamed("missing_pct", f"missing_{tag}"), "feature")
        moments = per_column(
            frame, numbers, {f"mean_{tag}": lambda c: F.avg(c.cast("double")), f"sd_{tag}": lambda c: F.stddev_samp(c.cast("double"))}
        )
        out = out.join(moments, "feature", "left")
    return out


def drop_zero_variance(df: DataFrame, exclude: Sequence[str] = NOT_FEATURES) -> Choice:
    """Number columns whose sample variance is exactly zero."""
    cols = numeric_columns(df, exclude)
    report = per_column(df, cols, {"variance": lambda c: F.var_samp(c.cast("double"))})
    report = report.withColumn("dropped", F.coalesce(F.col("variance") == 0, F.lit(False)))
    gone = sorted(r["feature"] for r in report.filter("dropped").collect())
    return Choice([c for c in df.columns if c not in exclude and c not in gone], gone, report)


def level_lists(df: DataFrame, cols: Sequence[str]) -> dict[str, list[str]]:
    """The levels of each column, sorted: one entry for each column of a projection to come.

    Columns with very many levels are better served by :func:`sparse_levels`.
    """
    pairs = long_levels(df, cols).filter("level IS NOT NULL").distinct().collect()
    out: dict[str, list[str]] = {c: [] for c in cols}
    for r in pairs:
        out[r["feature"]].append(r["level"])
    return {c: sorted(v) for c, v in out.items()}


def dummies(levels: Mapping[str, Sequence[str]], sep: str = "_") -> dict[str, Column]:
    return {
        dummy_name(c, v, sep): F.when(F.col(c) == v, 1).otherwise(0) for c, vs in levels.items() for v in vs
    }


def sparse_levels(df: DataFrame, train: DataFrame, cols: Sequence[str], keep: Sequence[str] = (), name: str = "levels") -> DataFrame:
    """One sparse 0/1 vector over all levels of all columns, for any number of levels.

    Fitted on ``train``, levels by name; a missing or unknown level gives zeros.
    """
    if not cols:
        raise ValueError("no columns to encode")
    codes, ones = [f"_code_{c}" for c in cols], [f"_one_{c}" for c in cols]
    stages = [
        StringIndexer(inputCols=list(cols), outputCols=codes, handleInvalid="keep", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCols=codes, outputCols=ones, dropLast=True),  # the last is the unknown one
        VectorAssembler(inputCols=ones, outputCol=name),
    ]
    return Pipeline(stages=stages).fit(train).transform(df).select(*keep, name)


def process_data(
    df: DataFrame, catalog: Catalog, keep: Sequence[str] = ("chc_id", "status"), exclude: Sequence[str] = NOT_FEATURES
) -> DataFrame:
    """Impute, drop incomplete rows, cast, one-hot, drop zero-variance columns."""
    ready = impute(df, catalog, exclude)
    cols = catalog.features([c for c in df.columns if c not in exclude])
    ready = ready.select(*keep, *cols).na.drop("any", subset=cols)
    texts, numbers = catalog.of_kind("CAT", cols), catalog.of_kind("NUM", cols)
    model = ready.select(
        *keep,
        *[F.col(c).cast("double").alias(c) for c in numbers],
        *[c.alias(n) for n, c in dummies(level_lists(ready, texts)).items()],
    )
    choice = drop_zero_variance(model, exclude=list(keep))
    return choice.apply(model, keep)


def winsorize(
    df: DataFrame, cols: Sequence[str], lo: float = 0.0, hi: float = 0.995, negatives_to_zero: bool = False
) -> dict[str, Column]:
    """Clip expressions fitted on ``df``; apply the same ones to any other table."""
    out = {}
    for c, (a, b) in exact_quantiles(df, cols, [lo, hi]).items():
        x = clip(F.col(c), a, b) if a is not None else F.col(c).cast("double")
        out[c] = F.when(x < 0, F.lit(0.0)).otherwise(x) if negatives_to_zero else x
    return out


def preprocess_numbers(
    df: DataFrame,
    cols: Sequence[str],
    keep: Sequence[str] = ("chc_id",),
    negatives_to_zero: bool = False,
    remove_constant: bool = True,
    lo: float = 0.0,
    hi: float = 0.995,
) -> DataFrame:
    """Clip (not flags and service visits), drop constants, fill gaps with zero."""
    clipped = winsorize(df, [c for c in cols if not c.startswith(("flag", "service_visit"))], lo, hi, negatives_to_zero)
    out = df.select(*keep, *[clipped.get(c, F.col(c).cast("double")).alias(c) for c in cols])
    few = few_valued(out, list(cols), 1) if remove_constant else {}
    kept = [c for c in cols if few.get(c) != 1]
    return out.select(*keep, *[F.coalesce(c, F.lit(0.0)).alias(c) for c in kept])


# --- the whole pipeline, for one population or for several markets at once ---


def _facts(df: DataFrame, cols: Sequence[str], label: str, key: str, by: Sequence[str], threshold: float) -> dict:
    """All statistics the column rules need, per group, in two passes over the table.

    The first takes missing shares, constancy, moments and fingerprints; the second
    all correlations, with the label as one more column. Of the pairs only those above
    the threshold leave Spark.
    """
    numbers = [c for c in cols if c in numeric_columns(df)]
    clean = blank_nan(df, numbers).withColumn("_label", F.col(label).cast("double"))

    def group(r) -> tuple:
        return tuple(r[b] for b in by)

    first = {
        "missing": missing_share,
        "one": lambda c: F.coalesce(F.min(c) == F.max(c), F.lit(False)),
        "print": lambda c: F.bit_xor(F.xxhash64(F.col(key), c)),
    }
    out: dict = {}
    basic = per_column(clean, cols, first, by)
    for r in basic.collect():
        facts = out.setdefault(group(r), {"missing": {}, "one": set(), "print": {}, "corr": {}, "pairs": {}})
        facts["missing"][r["feature"]] = r["missing"]
        facts["print"][r["feature"]] = r["print"]
        if r["one"]:
            facts["one"].add(r["feature"])
    pairs = pair_correlations(clean, ["_label", *numbers], by)
    for r in pairs.filter((F.col("col_a") == "_label") | (F.round(F.abs("corr"), 9) > threshold)).collect():
        if r["col_a"] == "_label":
            out[group(r)]["corr"][r["col_b"]] = r["corr"]
        else:
            out[group(r)]["pairs"][frozenset((r["col_a"], r["col_b"]))] = r["corr"]
    for facts in out.values():
        for c in numbers:
            facts["corr"].setdefault(c, None)
    return out


def _duplicate_texts(df: DataFrame, cols: Sequence[str], facts: dict, by: Sequence[str]) -> dict:
    """Later text columns equal to an earlier one, per group; equal prints are verified."""
    texts = [c for c in cols if c in categorical_columns(df)]
    pairs = [(a, b) for i, a in enumerate(texts) for b in texts[i + 1 :]]
    near = [(a, b) for a, b in pairs if any(f["print"][a] == f["print"][b] for f in facts.values())]
    if not near:
        return {}
    same = [F.bool_and(F.col(a).eqNullSafe(F.col(b))).alias(f"p{i}") for i, (a, b) in enumerate(near)]
    out: dict = {}
    for r in df.groupBy(*by).agg(*same).collect():
        out[tuple(r[b] for b in by)] = {b for i, (a, b) in enumerate(near) if r[f"p{i}"]}
    return out


def fit_pipeline(
    df: DataFrame,
    catalog: Catalog,
    label: str = "status",
    key: str = "chc_id",
    by: Sequence[str] = (),
    missing: float = 0.99,
    first_corr: float = 0.99,
    second_corr: float = 0.90,
    exclude: Sequence[str] = NOT_FEATURES,
) -> dict[tuple, list[tuple[str, str]]]:
    """Eight stages: types, missing, constant, correlated, duplicate, impute, constant, correlated.

    Returns for each group of ``by`` the list of (feature, stage that dropped it or
    ``'kept'``). Two statistics passes serve all stages and all groups: one before the
    imputation and one after. Groups are markets: their statistics reach the driver.
    """
    cols = [c for c in _features(df, exclude) if c not in by]
    typed = use_default_types(df, catalog, exclude)
    raw = _facts(typed, cols, label, key, by, first_corr)
    duplicates = _duplicate_texts(typed, cols, raw, by)
    filled = _facts(impute(df, catalog, exclude), cols, label, key, by, second_corr)
    out = {}
    for group, facts in raw.items():
        fate = {}
        for c in cols:
            if facts["missing"][c] > missing:
                fate[c] = "missing"
            elif c in facts["one"] and facts["missing"][c] <= 0:
                fate[c] = "constant"
        order = correlation_order({c: r for c, r in facts["corr"].items() if c not in fate})
        for late, _, _ in collinear(order, facts["pairs"], first_corr):
            fate.setdefault(late, "correlated")
        for c in duplicates.get(group, ()):
            fate.setdefault(c, "duplicate")
        after = filled[group]
        for c in after["one"]:
            fate.setdefault(c, "constant after imputing")
        order = correlation_order({c: r for c, r in after["corr"].items() if c not in fate})
        for late, _, _ in collinear(order, after["pairs"], second_corr):
            fate.setdefault(late, "correlated after imputing")
        out[group] = [(c, fate.get(c, "kept")) for c in cols]
    return out


# --- the same pipeline for any number of markets: nothing of a market reaches the driver ---

_FACTS = "kind string, a string, b string, x double, one boolean"


def _long_facts(df: DataFrame, cols: Sequence[str], label: str, key: str, by: Sequence[str], threshold: float, stage: str) -> DataFrame:
    """(by..., kind, a, b, x, one): column facts and the pairs above the threshold, as rows."""
    numbers = [c for c in cols if c in numeric_columns(df)]
    clean = blank_nan(df, numbers).withColumn("_label", F.col(label).cast("double"))
    basic = per_column(clean, cols, {"missing": missing_share, "one": lambda c: F.coalesce(F.min(c) == F.max(c), F.lit(False))}, by)
    nothing = F.lit(None)
    facts = basic.select(*by, F.lit(f"{stage} column").alias("kind"), F.col("feature").alias("a"), nothing.cast("string").alias("b"), F.col("missing").alias("x"), "one")
    if not numbers:
        return facts
    pairs = pair_correlations(clean, ["_label", *numbers], by).filter((F.col("col_a") == "_label") | (F.round(F.abs("corr"), 9) > threshold))
    target = F.col("col_a") == "_label"
    return facts.unionByName(
        pairs.select(
            *by, F.when(target, F.lit(f"{stage} target")).otherwise(F.lit(f"{stage} pair")).alias("kind"),
            F.when(target, F.col("col_b")).otherwise(F.col("col_a")).alias("a"), F.when(~target, F.col("col_b")).alias("b"), F.col("corr").alias("x"), nothing.cast("boolean").alias("one"),
        )
    )


def _equal_texts(df: DataFrame, cols: Sequence[str], key: str, by: Sequence[str]) -> DataFrame | None:
    """(by..., kind, a, b, x, one) of text columns that are equal in a market: prints first, then value by value."""
    texts = [c for c in cols if c in categorical_columns(df)]
    if len(texts) < 2:
        return None
    prints = per_column(df, texts, {"print": lambda c: F.bit_xor(F.xxhash64(F.col(key), c))}, by)
    other = prints.select(*by, F.col("feature").alias("later"), "print")
    order = {c: i for i, c in enumerate(texts)}
    met = prints.join(other, [*by, "print"]).filter("feature <> later").select("feature", "later").distinct()  # pairs of columns, not of markets
    near = sorted({tuple(sorted((r["feature"], r["later"]), key=order.get)) for r in met.collect()})
    if not near:
        return None
    cells = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.bool_and(F.col(a).eqNullSafe(F.col(b))).alias("one")) for a, b in near]
    same = df.groupBy(*by).agg(F.array(*cells).alias("cells")).select(*by, F.inline("cells")).filter("one")
    return same.select(*by, F.lit("equal").alias("kind"), "a", "b", F.lit(None).cast("double").alias("x"), "one")


def _fates(cols: Sequence[str], facts: Sequence[tuple], missing: float, first_corr: float, second_corr: float) -> dict[str, str]:
    """The stage that drops each column, or ``'kept'``, from one market's facts."""
    at: dict[str, list[tuple]] = {}
    for kind, a, b, x, one in facts:
        at.setdefault(kind, []).append((a, b, x, one))

    def late(stage: str, threshold: float) -> list[str]:
        corr = {a: x for a, _, x, _ in at.get(f"{stage} target", ()) if a not in fate}
        pairs = {frozenset((a, b)): x for a, b, x, _ in at.get(f"{stage} pair", ())}
        return [c for c, _, _ in collinear(correlation_order(corr), pairs, threshold)]

    fate: dict[str, str] = {}
    for a, _, x, one in at.get("raw column", ()):
        if x is not None and x > missing:
            fate[a] = "missing"
        elif one and not x:
            fate[a] = "constant"
    for c in late("raw", first_corr):
        fate.setdefault(c, "correlated")
    for _, b, _, _ in at.get("equal", ()):
        fate.setdefault(b, "duplicate")
    for a, _, _, one in at.get("filled column", ()):
        if one:
            fate.setdefault(a, "constant after imputing")
    for c in late("filled", second_corr):
        fate.setdefault(c, "correlated after imputing")
    return {c: fate.get(c, "kept") for c in cols}


def fit_pipeline_by(
    df: DataFrame,
    catalog: Catalog,
    by: Sequence[str],
    label: str = "status",
    key: str = "chc_id",
    missing: float = 0.99,
    first_corr: float = 0.99,
    second_corr: float = 0.90,
    exclude: Sequence[str] = NOT_FEATURES,
) -> DataFrame:
    """(by..., feature, fate): the eight stages of :func:`fit_pipeline` for every group of ``by``.

    The statistics of all groups are rows of one table, and each group is decided in a
    task from its own rows: the facts of its columns and its pairs above the thresholds.
    Only pairs of column names reach the driver, so the number of groups has no limit.
    """
    cols = [c for c in _features(df, exclude) if c not in by]
    typed = use_default_types(df, catalog, exclude)
    facts = _long_facts(typed, cols, label, key, by, first_corr, "raw")
    facts = facts.unionByName(_long_facts(impute(df, catalog, exclude), cols, label, key, by, second_corr, "filled"))
    equal = _equal_texts(typed, cols, key, by)
    if equal is not None:
        facts = facts.unionByName(equal)
    kinds = ", ".join(f"`{b}` {t}" for b, t in facts.select(*by).dtypes)

    def decide(rows: pd.DataFrame) -> pd.DataFrame:
        clean = rows[["kind", "a", "b", "x", "one"]].astype(object).where(rows[["kind", "a", "b", "x", "one"]].notna(), None)
        fate = _fates(cols, list(clean.itertuples(index=False, name=None)), missing, first_corr, second_corr)
        out = pd.DataFrame({"feature": list(fate), "fate": list(fate.values())})
        for i, b in enumerate(by):
            out.insert(i, b, rows[b].iloc[0])
        return out

    return facts.groupBy(*by).applyInPandas(decide, f"{kinds}, feature string, fate string")


def selection_view(df: DataFrame, catalog: Catalog, view: str = "ALL", retain: Sequence[str] = (), keep: Sequence[str] = ("chc_id", "status"), exclude: Sequence[str] = NOT_FEATURES) -> DataFrame:
    """The processed table for a selection among number columns, text columns or all.

    ``view`` is 'NUM', 'CAT' or 'ALL'; ``retain`` narrows it to the listed columns first,
    and unknown names in it are left out. The rows are those that are complete in the
    view's own columns.
    """
    if view not in ("NUM", "CAT", "ALL"):
        raise ValueError("view is 'NUM', 'CAT' or 'ALL'")
    cols = catalog.features([c for c in df.columns if c not in exclude and (not retain or c in retain)])
    cols = cols if view == "ALL" else catalog.of_kind(view, cols)
    return process_data(df.select(*keep, *cols), catalog, keep, exclude)


def run_pipeline(df: DataFrame, fitted: Sequence[tuple[str, str]], catalog: Catalog, keep: Sequence[str], exclude: Sequence[str] = NOT_FEATURES) -> DataFrame:
    """The fitted column choice applied to any table of the same layout, gaps filled."""
    kept = [c for c, fate in fitted if fate == "kept"]
    return impute(df, catalog, exclude).select(*keep, *kept)


__all__ = [
    "Choice", "blanks_to_null", "collinear", "correlation_order", "describe", "drop_constant", "drop_correlated",
    "drop_duplicate_columns", "drop_irrelevant_collinear", "drop_missing", "drop_zero_variance", "dtype_report",
    "dummies", "fit_pipeline", "impute", "impute_summary", "level_lists", "preprocess_numbers", "process_data",
    "run_pipeline", "unique_counts", "use_default_types", "winsorize",
]
