"""Cohorts from the monthly snapshot: who is eligible, who left, who stayed.

The snapshot holds one row per customer and month and should be stored partitioned
by the month column, so that every filter here prunes to the months it names.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from stayflow.functions.months import next_months

# Reasons that take a customer out of the base before the window opens.
PENDING_OUT = ("VOLUNTARY", "MOVE AND TRANSFER")


@dataclass(frozen=True)
class CohortRules:
    """Column names and predicates of a snapshot, all replaceable."""

    products: Sequence[str]
    product_col: str = "products"
    key: str = "chc_id"
    month: str = "dt"
    status_col: str = "drform"
    active: Sequence[str] = ("ACTIVE",)
    pending_col: str = "pending_drform"
    pending_out: Sequence[str] = PENDING_OUT
    leaves: str = "vol_pend_disco = 'Y' OR pending_mover = 'FALSE'"
    leaves_test: str = "pending_drform = 'VOLUNTARY' OR pending_mover = 'FALSE'"
    clean: str = "coalesce(vol_pend_disco, 'XX') <> 'Y' AND coalesce(pending_mover, 'XX') <> 'FALSE'"
    horizon: int = 3
    segments: Mapping[str, str] = field(default_factory=dict)


def segment_predicate(
    column: str,
    above: int | None = None,
    upto: int | None = None,
    lists: Mapping[str, Sequence[str]] | None = None,
    nullable: Mapping[str, Sequence[str]] | None = None,
) -> str:
    """SQL text of a segment: a half-open range plus IN-lists.

    ``nullable`` lists read a missing value as the empty text, so listing ``''``
    lets it in.
    """
    parts = []
    if above is not None:
        parts.append(f"{column} > {int(above)}")
    if upto is not None:
        parts.append(f"{column} <= {int(upto)}")
    for name, values in (lists or {}).items():
        parts.append(f"{name} IN ({', '.join(_quoted(v) for v in values)})")
    for name, values in (nullable or {}).items():
        parts.append(f"coalesce({name}, '') IN ({', '.join(_quoted(v) for v in values)})")
    return " AND ".join(parts)


def _quoted(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def project(df: DataFrame, atts: str | Sequence[str], key: Sequence[str] = ("chc_id",)) -> DataFrame:
    """Key columns plus a list of attributes, every column for ``'*'``, or keys only."""
    if atts == "*":
        return df
    return df.select(*key, *[a for a in atts if a not in key])


def eligible(df: DataFrame, month: int, rules: CohortRules, segment: str | None = None) -> DataFrame:
    out = df.filter(
        (F.col(rules.month) == month)
        & F.col(rules.status_col).isin(*rules.active)
        & F.col(rules.product_col).isin(*rules.products)
        & ~F.coalesce(rules.pending_col, F.lit("XX")).isin(*rules.pending_out)
    )
    return out.filter(F.expr(segment)) if segment else out


def _window(df: DataFrame, month: int, rules: CohortRules) -> DataFrame:
    return df.filter(F.col(rules.month).isin(next_months(month, rules.horizon)))


def leavers(df: DataFrame, month: int, rules: CohortRules, predicate: str) -> DataFrame:
    """Distinct keys that meet ``predicate`` in any month of the window: one pruned scan."""
    return _window(df, month, rules).filter(predicate).select(rules.key).distinct()


def stayers(df: DataFrame, month: int, rules: CohortRules) -> DataFrame:
    """Keys active and clean in each month of the window, by counting the clean months."""
    clean = _window(df, month, rules).filter(f"({rules.clean})").filter(F.col(rules.status_col).isin(*rules.active))
    months = clean.select(rules.key, rules.month).distinct().groupBy(rules.key).agg(F.count(F.lit(1)).alias("m"))
    return months.filter(F.col("m") == rules.horizon).select(rules.key)


def positives(df: DataFrame, month: int, rules: CohortRules, segment: str | None = None) -> DataFrame:
    """Eligible now and leaving inside the window (semi join)."""
    return eligible(df, month, rules, segment).join(leavers(df, month, rules, rules.leaves), rules.key, "left_semi")


def negatives(df: DataFrame, month: int, rules: CohortRules, segment: str | None = None) -> DataFrame:
    """Eligible now and clean in every month of the window (semi join)."""
    return eligible(df, month, rules, segment).join(stayers(df, month, rules), rules.key, "left_semi")


def negatives_test(df: DataFrame, month: int, rules: CohortRules, segment: str | None = None) -> DataFrame:
    """Eligible now and not among the leavers; a null key never empties the result."""
    gone = leavers(df, month, rules, rules.leaves_test).filter(F.col(rules.key).isNotNull())
    return eligible(df, month, rules, segment).join(gone, rules.key, "left_anti")


def train_cohort(
    df: DataFrame, month: int, rules: CohortRules, atts: str | Sequence[str] = (), segment: str | None = None
) -> DataFrame:
    """Label 1 for leavers, 0 for stayers, distinct rows; everyone else is left out.

    The window months are read once: both outcomes come from one aggregate per key.
    """
    window = _window(df, month, rules)
    left = F.coalesce(F.expr(rules.leaves), F.lit(False))
    stayed = F.expr(rules.clean) & F.col(rules.status_col).isin(*rules.active)
    clean = [F.max(F.when((F.col(rules.month) == m) & stayed, 1)) for m in next_months(month, rules.horizon)]
    outcome = window.groupBy(rules.key).agg(
        F.max(F.when(left, 1)).alias("_left"), F.least(*[F.coalesce(c, F.lit(0)) for c in clean]).alias("_stayed")
    )
    labels = F.array_compact(F.array(F.when(F.col("_left") == 1, 1), F.when(F.col("_stayed") == 1, 0)))
    base = project(eligible(df, month, rules, segment), atts, (rules.key,))
    return (
        base.join(outcome.select(rules.key, labels.alias("_labels")).filter(F.size("_labels") > 0), rules.key)
        .select(F.explode("_labels").alias("status"), *base.columns)
        .distinct()
    )


def holdout_cohort(
    df: DataFrame, month: int, rules: CohortRules, atts: str | Sequence[str] = (), segment: str | None = None
) -> DataFrame:
    """Label 1 for pending leavers, 0 for all the rest of the eligible base."""
    gone = leavers(df, month, rules, rules.leaves_test).filter(F.col(rules.key).isNotNull())
    base = project(eligible(df, month, rules, segment), atts, (rules.key,))
    return (
        base.join(gone.withColumn("_gone", F.lit(1)), rules.key, "left")
        .select(F.coalesce("_gone", F.lit(0)).alias("status"), *base.columns)
        .distinct()
    )


def score_cohort(
    df: DataFrame, month: int, rules: CohortRules, atts: str | Sequence[str] = (), segment: str | None = None
) -> DataFrame:
    return project(eligible(df, month, rules, segment), atts, (rules.key,))


def stack_segments(df: DataFrame, segments: Mapping[str, str], key: str = "chc_id") -> DataFrame:
    """Rows of the segments in the order given; a key in several stays with its first.

    One scan tags each row with its first matching segment, in place of one query per
    segment. The number of rows kept per key is one.
    """
    chain, priority = None, None
    for i, (name, predicate) in enumerate(segments.items()):
        cond = F.coalesce(F.expr(predicate), F.lit(False))
        chain = F.when(cond, F.lit(name)) if chain is None else chain.when(cond, F.lit(name))
        priority = F.when(cond, F.lit(i)) if priority is None else priority.when(cond, F.lit(i))
    tagged = df.select(chain.alias("segment_name"), priority.alias("_priority"), "*").filter("_priority IS NOT NULL")
    return first_per_key(tagged, [key], [F.col("_priority")]).drop("_priority")


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key; the limit of one row is applied before the shuffle."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def require_rows(df: DataFrame, name: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"cohort {name} is empty")
    return df


def duplicate_keys(df: DataFrame, key: Sequence[str] = ("chc_id",)) -> DataFrame:
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def require_unique(df: DataFrame, key: Sequence[str] = ("chc_id",)) -> DataFrame:
    if not duplicate_keys(df, key).isEmpty():
        raise ValueError(f"duplicate keys in {', '.join(key)}")
    return df


def outcome_flag(*labels: Column) -> Column:
    """1 when any label is 1, else 0; a missing label counts as 0."""
    any_one = labels[0] == 1
    for c in labels[1:]:
        any_one = F.coalesce(any_one, F.lit(False)) | F.coalesce(c == 1, F.lit(False))
    return F.when(any_one, 1).otherwise(0)


def population(df: DataFrame, equals: Mapping[str, str]) -> DataFrame:
    """Rows whose text columns equal the given values, compared without case."""
    for c, v in equals.items():
        df = df.filter(F.upper(c) == v.upper())
    return df
