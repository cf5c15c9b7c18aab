"""The cohorts as parameterised SQL text, for users who keep their cohorts as queries.

Names of views and columns come in by ``IDENTIFIER``, values as named markers, and Spark
binds both: no value is ever pasted into the text. Only predicates, which are SQL
themselves, are part of it. The plans are those of :mod:`stayflow.operators.cohort`:
months are constants after binding, so partitions are pruned, and the window is read once.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stayflow.functions.months import next_months
from stayflow.operators.cohort import CohortRules

_ELIGIBLE = """
  IDENTIFIER(:month_col) = :month AND array_contains(:active, IDENTIFIER(:status_col)) AND array_contains(:products, IDENTIFIER(:product_col))
  AND NOT array_contains(:pending_out, coalesce(IDENTIFIER(:pending_col), 'XX')) AND ({segment})"""

_BASE = "SELECT {columns} FROM IDENTIFIER(:view) WHERE" + _ELIGIBLE

_TRAIN = """
WITH base AS (""" + _BASE + """),
outcome AS (
  SELECT IDENTIFIER(:key) AS _key, bool_or(coalesce({leaves}, false)) AS gone,
    count(DISTINCT CASE WHEN ({clean}) AND array_contains(:active, IDENTIFIER(:status_col)) THEN IDENTIFIER(:month_col) END) = :horizon AS stayed
  FROM IDENTIFIER(:view) WHERE array_contains(:window, IDENTIFIER(:month_col)) GROUP BY 1)
SELECT DISTINCT status, base.* FROM base JOIN outcome ON IDENTIFIER('base.' || :key) = outcome._key
LATERAL VIEW explode(array_compact(array(CASE WHEN gone THEN 1 END, CASE WHEN stayed THEN 0 END))) AS status
"""

_HOLDOUT = """
WITH base AS (""" + _BASE + """),
gone AS (SELECT DISTINCT IDENTIFIER(:key) AS _key FROM IDENTIFIER(:view) WHERE array_contains(:window, IDENTIFIER(:month_col)) AND ({leaves}) AND IDENTIFIER(:key) IS NOT NULL)
SELECT DISTINCT CASE WHEN gone._key IS NULL THEN 0 ELSE 1 END AS status, base.* FROM base LEFT JOIN gone ON IDENTIFIER('base.' || :key) = gone._key
"""


def _texts(values: Sequence[str]) -> Column:
    return F.array(*(F.lit(v) for v in values)) if values else F.array().cast("array<string>")


def _arguments(view: str, month: int, rules: CohortRules) -> dict:
    return {
        "view": view, "month": month, "key": rules.key, "month_col": rules.month, "status_col": rules.status_col, "product_col": rules.product_col,
        "pending_col": rules.pending_col, "active": _texts(rules.active), "products": _texts(rules.products), "pending_out": _texts(rules.pending_out),
    }


def _quoted(names: Sequence[str]) -> str:
    return ", ".join("`" + n.replace("`", "``") + "`" for n in names)


def _columns(spark: SparkSession, view: str, atts: str | Sequence[str], rules: CohortRules) -> str:
    if atts == "*":
        return _quoted(spark.table(view).columns)
    return _quoted([rules.key, *(a for a in atts if a != rules.key)])


def _bound(spark: SparkSession, text: str, names: dict) -> DataFrame:
    """Only the markers that the text names are bound."""
    return spark.sql(text, args={k: v for k, v in names.items() if f":{k}" in text})


def score_cohort(spark: SparkSession, view: str, month: int, rules: CohortRules, atts: str | Sequence[str] = (), segment: str | None = None) -> DataFrame:
    text = _BASE.format(columns=_columns(spark, view, atts, rules), segment=segment or "true")
    return _bound(spark, text, _arguments(view, month, rules))


def _window(month: int, rules: CohortRules) -> Column:
    return F.array(*(F.lit(m) for m in next_months(month, rules.horizon)))


def train_cohort(spark: SparkSession, view: str, month: int, rules: CohortRules, atts: str | Sequence[str] = (), segment: str | None = None) -> DataFrame:
    """Label 1 for leavers, 0 for stayers, distinct rows; everyone else is left out."""
    text = _TRAIN.format(columns=_columns(spark, view, atts, rules), segment=segment or "true", leaves=rules.leaves, clean=rules.clean)
    return _bound(spark, text, {**_arguments(view, month, rules), "window": _window(month, rules), "horizon": rules.horizon})


def holdout_cohort(spark: SparkSession, view: str, month: int, rules: CohortRules, atts: str | Sequence[str] = (), segment: str | None = None) -> DataFrame:
    """Label 1 for pending leavers, 0 for all the rest of the eligible base."""
    text = _HOLDOUT.format(columns=_columns(spark, view, atts, rules), segment=segment or "true", leaves=rules.leaves_test)
    return _bound(spark, text, {**_arguments(view, month, rules), "window": _window(month, rules)})
