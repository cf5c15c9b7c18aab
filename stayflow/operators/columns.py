"""Column plumbing: selection, names, alignment to a training layout."""
from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stayflow.operators.stage import affix
from stayflow.operators.stats import categorical_columns, numeric_columns


def select_numeric(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*keep, *numeric_columns(df, keep))


def select_categorical(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*keep, *categorical_columns(df, keep))


def rename_all(df: DataFrame, prefix: str | None = None, suffix: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    return df.withColumnsRenamed({c: affix(c, prefix, suffix) for c in df.columns if c not in keep})


def clean_name(name: str) -> str:
    """Letters, digits, plus and space survive; the last two are spelled out."""
    return re.sub(r"[^A-Za-z0-9+ ]", "", name).replace("+", "PLUS").replace(" ", "SPACE")


def clean_text(c: Column) -> Column:
    """The same rule as a column expression."""
    return F.replace(F.replace(F.regexp_replace(c, r"[^A-Za-z0-9+ ]", ""), F.lit("+"), F.lit("PLUS")), F.lit(" "), F.lit("SPACE"))


def clean_names(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The frame under clean names, and the table of old and new names."""
    pairs = [(c, clean_name(c)) for c in df.columns]
    if len({new for _, new in pairs}) < len(pairs):
        raise ValueError("two columns get the same clean name")
    names = df.sparkSession.createDataFrame(pairs, "original string, cleaned string")
    return df.toDF(*[new for _, new in pairs]), names


def align_to(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the training columns in training order; a column not seen here is 0."""
    have = set(df.columns)
    return df.select(*keep, *[F.col(c) if c in have else F.lit(0).alias(c) for c in columns])


def dummy_name(attribute: str, level: str, sep: str = "_") -> str:
    return f"{attribute}{sep}{level}"


def name_map(spark, levels: Mapping[str, Sequence[str]], numbers: Sequence[str], sep: str) -> DataFrame:
    """Model column -> attribute and level, from fitted encoder metadata."""
    rows = [(a, dummy_name(a, v), dummy_name(a, v, sep), clean_name(dummy_name(a, v, sep))) for a, vs in levels.items() for v in vs]
    rows += [(c, c, c, clean_name(c)) for c in numbers]
    return spark.createDataFrame(rows, "attribute string, attribute_level string, with_sep string, model_name string")
