"""Rows as (row, column, level) triples, and their join with a table of levels."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from stayflow.operators.stats import long_levels
from stayflow.session import materialize

#: a level with at least this share of a column's rows is joined by broadcast: at most 1 / HOT of them a column
HOT = 0.002

ROW = "_row"


def numbered(df: DataFrame) -> DataFrame:
    """``df`` written once, with a number for each row: repeated keys stay rows of their own."""
    return materialize(df.withColumn(ROW, F.monotonically_increasing_id()), "numbered")


def join_levels(rows: DataFrame, cols: Sequence[str], levels: DataFrame, wanted: Sequence[str], share: str = "share") -> DataFrame:
    """(_row, feature, level, wanted...) of every level of numbered ``rows`` that ``levels`` knows.

    ``levels`` holds (feature, level, share, wanted...). One join serves all columns. A hot
    level is found in a broadcast list, so that its rows are not moved to one place.
    """
    long = long_levels(rows, cols, [ROW]).filter("level IS NOT NULL")
    known = levels.select("feature", "level", share, *wanted)
    hot = known.filter(F.col(share) >= HOT).drop(share).withColumn("_hot", F.lit(True))
    marked = long.join(F.broadcast(hot), ["feature", "level"], "left")  # at most 1 / HOT levels of a column
    cold = marked.filter("_hot IS NULL").select(ROW, "feature", "level").join(known.filter(F.col(share) < HOT).drop(share), ["feature", "level"])
    names = [ROW, "feature", "level", *wanted]
    return marked.filter("_hot").select(names).unionByName(cold.select(names))
