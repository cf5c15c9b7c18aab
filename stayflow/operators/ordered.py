"""Ranks and running totals over a whole table, without a one-task window.

A window with no partition key pulls every row into one task. Here the rows are
range partitioned on the full order (score *and* key, so a score shared by a third
of the table still splits), sorted inside each slice, and written once to the
shared folder. A slice then only needs the totals of the slices before it, which is
a frame with one row per slice. The number of slices is left to the session: adaptive
execution merges neighbouring small ranges, which keeps their order.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from stayflow.functions.columns import int_div
from stayflow.session import materialize

_SLICE_BITS = 33


def _before(frame: DataFrame, by: Sequence[str], cols: Sequence[str]) -> list[Column]:
    """Totals of the earlier slices; one row per (slice, group) only."""
    order = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    order = order.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    return [F.coalesce(F.sum(c).over(order), F.lit(0)).alias(f"_before_{c}") for c in cols]


def global_rank(df: DataFrame, order: Sequence[Column], rank: str = "rank_no", total: str | None = None) -> DataFrame:
    """Row numbers 1..n over ``order`` (which must end in a unique key)."""
    kept = materialize(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id()),
        "rank",
    ).withColumn("_slice", F.shiftright("_mid", _SLICE_BITS).cast("int"))
    sizes = kept.groupBy("_slice").agg(F.count(F.lit(1)).alias("n"))
    extra = [F.sum("n").over(Window.partitionBy(F.lit(0))).alias(total)] if total else []
    offsets = sizes.select("_slice", *_before(sizes, (), ["n"]), *extra)
    position = F.col("_mid").bitwiseAND(F.lit((1 << _SLICE_BITS) - 1))
    return (
        kept.join(F.broadcast(offsets), "_slice")  # one row per slice
        .withColumn(rank, F.col("_before_n") + position + 1)
        .drop("_slice", "_mid", "_before_n")
    )


def running_totals(
    df: DataFrame, order: Sequence[Column], sums: Sequence[str], by: Sequence[str] = (), totals: bool = False
) -> DataFrame:
    """Adds ``<c>_before``: the sum of each column over the *earlier* rows of its ``by``
    group, and with ``totals`` also ``<c>_total``, the sum over the whole group.

    ``order`` must be unique within a group. A group larger than one slice is spread
    over several, so a hot group costs no more than its share of the table.
    """
    group = [F.col(b) for b in by]
    kept = materialize(
        df.repartitionByRange(*group, *order).withColumn("_slice", F.spark_partition_id()), "totals"
    )
    parts = kept.groupBy("_slice", *by).agg(*[F.sum(c).alias(c) for c in sums])
    everything = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    extra = [F.sum(c).over(everything).alias(f"{c}_total") for c in sums] if totals else []
    offsets = parts.select("_slice", *by, *_before(parts, by, sums), *extra)
    if not by:
        offsets = F.broadcast(offsets)  # one row per slice
    inside = Window.partitionBy("_slice", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = kept.select("*", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"_local_{c}") for c in sums])
    before = [(F.col(f"_before_{c}") + F.col(f"_local_{c}")).alias(f"{c}_before") for c in sums]
    return local.join(offsets, ["_slice", *by]).select(*df.columns, *before, *[f"{c}_total" for c in sums if totals])


def nearest_known(df: DataFrame, by: Sequence[str], value: str, known: Column, out: str) -> DataFrame:
    """Adds ``out``: ``known`` of the row whose ``value`` is nearest among the rows of the
    same ``by`` group where ``known`` is not null; half way between two, the smaller one's.

    Rows are range partitioned on group and value. Inside a slice the neighbours come from
    a window; those beyond its ends from one row per slice and group, so a group of any
    size is spread. Null values have no place and must be left out before.
    """
    named = df.withColumn("_k", F.when(known.isNotNull(), F.struct(F.col(value).alias("at"), known.alias("known"))))
    kept = materialize(named.repartitionByRange(*by, value).withColumn("_slice", F.spark_partition_id()), "nearest")
    ends = kept.groupBy("_slice", *by).agg(F.min("_k").alias("_first"), F.max("_k").alias("_last"))
    # frames that grow from one end, in both orders: a frame that shrinks is read again for each row
    before = lambda w, last: w.rowsBetween(Window.unboundedPreceding, last)
    slices, inside = Window.partitionBy(*by), Window.partitionBy("_slice", *by)
    ends = ends.select(  # one row per slice and group
        "_slice", *by,
        F.last("_last", ignorenulls=True).over(before(slices.orderBy("_slice"), -1)).alias("_earlier"),
        F.last("_first", ignorenulls=True).over(before(slices.orderBy(F.desc("_slice")), -1)).alias("_later"),
    )
    placed = kept.select(
        "*",
        F.last("_k", ignorenulls=True).over(before(inside.orderBy(value), 0)).alias("_down"),
        F.last("_k", ignorenulls=True).over(before(inside.orderBy(F.desc(value)), 0)).alias("_up"),
    ).join(ends, ["_slice", *by])
    placed = placed.withColumns({"_down": F.coalesce("_down", "_earlier"), "_up": F.coalesce("_up", "_later")})
    left = F.col("_up").isNull() | (F.col(value) <= (F.col("_down.at") + F.col("_up.at")) / 2)
    return placed.select(*df.columns, F.when(F.col("_down").isNotNull() & left, F.col("_down.known")).otherwise(F.col("_up.known")).alias(out))


def rank_slice(rank: Column, n: Column, k: int) -> Column:
    """1-based bucket ``floor((rank-1) / (n/k)) + 1``, in integers."""
    return (int_div((rank - 1) * k, n) + 1).cast("int")


def slice_of(rank: Column, n: Column, k: int) -> Column:
    """0-based slice with bounds ``int(j * (n + 1) / k)`` on the 0-based position.

    Row ``r`` is in slice j when ``int(j(n+1)/k) <= r-1 < int((j+1)(n+1)/k)``, that is
    when j is the largest with ``j(n+1) < r*k``: ``floor((r*k - 1) / (n+1))``.
    """
    return int_div(rank * k - 1, n + 1).cast("int")
