"""What leaves the system: target lists, call rates per rank, scored lists, profiles."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stayflow.functions.columns import ratio
from stayflow.functions.keys import build_key, padded, split_key
from stayflow.operators.evaluate import PREDICTED, PROB, with_percentile, with_rank
from stayflow.operators.ordered import rank_slice
from stayflow.operators.stats import long_levels

# Fixed value: the length of the monthly target list.
TARGETS = 30_000

#: characters of a composite key whose numbers fit their places
KEY_LENGTH = 12


def retention_calls(
    interactions: DataFrame, start: str, end: str, lob: str = "FIXED", dept: str = "retention",
) -> DataFrame:
    """Inbound voice calls to the retention desk in ``[start, end)``, numeric ids only."""
    return interactions.filter(
        (F.col("lob") == lob)
        & (F.lower("interactiontype") == "inbound")
        & (F.coalesce("callexcludeflag", F.lit("N")) == "N")
        & (F.upper("interactionchannel") == "VOICE")
        & F.lower("dept").contains(dept)
        & (F.col("reportdate") >= F.lit(start).cast("date"))
        & (F.col("reportdate") < F.lit(end).cast("date"))
    ).select(F.col("srcCustomerAccountID").try_cast("bigint").alias("chc_id"), "reportdate")


def target_list(scored: DataFrame, run_month: int, time_run: str, n: int = TARGETS, key: str = "chc_id", composite: str = "corp_house_cust") -> DataFrame:
    """The ``n`` likeliest leavers with their key parts padded back to full width.

    A top-n list: each task keeps its best ``n`` and only those are merged. A key longer
    than its places stays whole, as two customers must not become one; its parts are then
    the digits at their places.
    """
    top = scored.filter(F.col(PREDICTED) == 1).orderBy(F.desc(PROB), F.asc(key)).limit(n)
    parts = split_key(F.col(composite))
    house, cust = padded(parts["house"], 6), padded(parts["cust"], 2)
    grown = F.length(composite) > KEY_LENGTH
    return top.select(
        F.lit(time_run).alias("time_run"), F.lit(str(run_month)).alias("run_month"),
        parts["corp"].alias("corp"), house.alias("house"), F.when(grown, F.substring(composite, 11, 2)).otherwise(cust).alias("cust"),
        F.when(grown, F.col(composite)).otherwise(build_key(parts["corp"], house, cust)).alias("corp_house_cust"),
    )


def calls_until_order(ranked: DataFrame, orders: DataFrame, calls: DataFrame, start: str, last: str, key: str = "chc_id") -> DataFrame:
    """Calls per customer from ``start`` to the leave order (``last`` without one).

    Calls are joined to their customer's date and counted right away, so a customer
    with very many calls never multiplies the list: only counts are joined to it.
    """
    dated = ranked.select(key).join(orders, key, "left").select(key, F.coalesce("order_date", F.lit(last).cast("date")).alias("until"))
    window = calls.filter(F.col("reportdate") >= F.lit(start).cast("date"))
    # per customer and day first: partial counts shrink a hot customer before the join
    daily = window.groupBy(key, "reportdate").agg(F.count(F.lit(1)).alias("n"))
    inside = daily.join(dated, key).filter(F.col("reportdate") <= F.col("until"))
    counts = inside.groupBy(key).agg(F.sum("n").alias("retention_calls"))
    return ranked.join(counts, key, "left").withColumn("retention_calls", F.coalesce("retention_calls", F.lit(0)))


def call_rate(per_customer: DataFrame, rank: str = "Rank") -> DataFrame:
    """Retention calls per customer of each rank, three places."""
    return per_customer.groupBy(rank).agg(
        F.sum("retention_calls").alias("retention_calls"), F.count(F.lit(1)).alias("customer_count")
    ).withColumn("retention_callrate", F.round(ratio(F.col("retention_calls"), F.col("customer_count")), 3))


def scored_list(
    scores: DataFrame, attributes: DataFrame, rate: DataFrame, columns: Mapping[str, Column], prob: str = PROB, key: str = "chc_id", top: int = 20,
) -> DataFrame:
    """The best ``top`` percentiles with business columns, gaps as zero, and the call rate."""
    ranked = with_percentile(scores.select(key, prob), prob, key).filter(F.col("Rank") <= top).select(key, "Rank")
    rows = ranked.join(attributes, key).select(key, "Rank", *[c.alias(n) for n, c in columns.items()])
    texts = [f.name for f in rows.schema.fields if f.dataType.simpleString() == "string"]
    numbers = [c for c in columns if c not in texts]
    filled = rows.fillna(0, subset=numbers).fillna("0", subset=[c for c in texts if c in columns])
    return filled.join(rate.select("Rank", "retention_callrate"), "Rank", "left")


def profile_levels(
    scores: DataFrame, attributes: DataFrame, cols: Sequence[str], label: str | None, prob: str = PROB, key: str = "chc_id",
) -> DataFrame:
    """Share of each level overall, among leavers and inside rank buckets, one row per level.

    Buckets are percentiles 1-20, five-percent steps 5-20 and ten-percent steps 30-100.
    The attributes are unpivoted and counted once per (level, percentile); every share
    is then a sum over that small table.
    """
    wanted = [key, prob] + ([label] if label else [])
    ranked = with_rank(scores.select(*wanted), prob, key)
    n, r = F.col("n"), F.col("rank_no")
    joined = ranked.select(
        key, *([label] if label else []), rank_slice(r, n, 100).alias("p1"), rank_slice(r, n, 20).alias("p5"), rank_slice(r, n, 10).alias("p10")
    ).join(attributes.select(key, *cols), key)
    rows = long_levels(joined, cols, ["p1", "p5", "p10", *([label] if label else [])]).filter("level IS NOT NULL")
    y = F.sum(label) if label else F.lit(None).cast("bigint")
    cube = rows.groupBy("feature", "level", "p1", "p5", "p10").agg(F.count(F.lit(1)).alias("n"), y.alias("y"))
    masks = {"avg_proportion": F.lit(True)}
    masks |= {f"top_{k}": F.col("p1") == k for k in range(1, 21)}
    masks |= {f"step5_{5 * k}": F.col("p5") == k for k in range(1, 5)}
    masks |= {f"step10_{10 * k}": F.col("p10") == k for k in range(3, 11)}
    sums = [F.sum(F.when(m, F.col("n"))).alias(name) for name, m in masks.items()]
    names = list(masks)
    if label:
        sums.append(F.sum("y").alias("actual_proportion"))
        names.append("actual_proportion")
    counts = cube.groupBy("feature", "level").agg(*sums)
    totals = counts.groupBy("feature").agg(*[F.sum(m).alias(f"_t_{m}") for m in names])
    return counts.join(F.broadcast(totals), "feature").select("feature", "level", *[ratio(F.col(m), F.col(f"_t_{m}")).alias(m) for m in names])
