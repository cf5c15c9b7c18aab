"""Conversion reports: how many predicted leavers did go, by score band and month."""
from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stayflow.functions.columns import band
from stayflow.functions.months import next_months
from stayflow.operators.evaluate import (
    PREDICTED,
    PROB,
    class_metric_columns,
    confusion,
    flip_probability,
    rate_columns,
    roc_auc,
)

# The probability bands of the report and the two roll-ups.
BANDS = [
    (0.5, 0.6, "GTE_0.5 and LT_0.6"),
    (0.6, 0.7, "GTE_0.6 and LT_0.7"),
    (0.7, 0.8, "GTE_0.7 and LT_0.8"),
    (0.8, 0.9, "GTE_0.8 and LT_0.9"),
    (0.9, None, "GTE_0.9"),
]
ROLLUPS = [(0.7, "GTE_0.7"), (0.8, "GTE_0.8")]

PENDING = "pending_drform = 'VOLUNTARY' OR pending_mover = 'FALSE'"


def band_names(rollups: bool) -> list[str]:
    return [b[2] for b in BANDS] + ([r[1] for r in ROLLUPS] if rollups else [])


def _bands_of(p: Column, rollups: bool) -> Column:
    """Every band a probability counts in; an empty band name stands for none."""
    found = [band(p, BANDS)] + ([F.when(p >= lo, F.lit(name)) for lo, name in ROLLUPS] if rollups else [])
    return F.array_compact(F.array(*found))


def called(scored: DataFrame) -> DataFrame:
    return scored.filter(F.col(PREDICTED) == 1)


def band_counts(scored: DataFrame) -> DataFrame:
    """Predicted leavers per band and roll-up: each row is expanded to at most three."""
    rows = called(scored).select(F.explode(_bands_of(F.col(PROB), True)).alias("band"))
    return rows.groupBy("band").agg(F.count(F.lit(1)).alias("hh_count"))


def first_month(snapshot: DataFrame, months: Sequence[int], predicate: str, key: str = "chc_id", month: str = "dt") -> DataFrame:
    """The first of the given months in which a customer meets the predicate."""
    hit = snapshot.filter(F.col(month).isin(list(months))).filter(predicate)
    return hit.groupBy(key).agg(F.min(month).alias("disco_month"))


def converted(scored: DataFrame, snapshot: DataFrame, months: Sequence[int], predicate: str, key: str = "chc_id") -> DataFrame:
    return called(scored).join(first_month(snapshot, months, predicate, key), key)


def conversion_monthly(scored: DataFrame, snapshot: DataFrame, base_month: int, left: str = "drform = 'VOLUNTARY'", pending: str = PENDING, key: str = "chc_id") -> DataFrame:
    """(band, kind, month, count) of pending and actual leavers over six months.

    Both first months come from one pass over the snapshot, and one join and one
    aggregate serve both kinds and all roll-ups.
    """
    months = next_months(base_month, 6)
    dates = (
        snapshot.filter(F.col("dt").isin(months))
        .groupBy(key)
        .agg(F.min(F.when(F.expr(pending), F.col("dt"))).alias("p"), F.min(F.when(F.expr(left), F.col("dt"))).alias("v"))
        .filter("p IS NOT NULL OR v IS NOT NULL")
    )
    kinds = F.array_compact(
        F.array(
            F.when(F.col("p").isNotNull(), F.struct(F.lit("Pending Disconnect").alias("kind"), F.col("p").alias("month"))),
            F.when(F.col("v").isNotNull(), F.struct(F.lit("Voluntary Disconnect").alias("kind"), F.col("v").alias("month"))),
        )
    )
    hits = called(scored).select(key, PROB).join(dates, key).select(PROB, F.inline(kinds))
    # actual leavers have no roll-up rows in the report
    bands = F.when(F.col("kind") == "Pending Disconnect", _bands_of(F.col(PROB), True)).otherwise(_bands_of(F.col(PROB), False))
    return hits.select("kind", "month", F.explode(bands).alias("band")).groupBy("band", "kind", "month").agg(F.count(F.lit(1)).alias("hh_count"))


def conversion_grid(monthly: DataFrame, base_month: int) -> DataFrame:
    """Every band x kind x month of the report, 0 where nobody left.

    The grid is built from the band names and six months; nothing is cross joined.
    """
    months = next_months(base_month, 6)
    rows = [(b, k, m, i + 1) for k in ("Pending Disconnect", "Voluntary Disconnect") for b in band_names(k.startswith("P")) for i, m in enumerate(months)]
    grid = monthly.sparkSession.createDataFrame(rows, "band string, kind string, month int, month_no int")
    return grid.join(monthly, ["band", "kind", "month"], "left").select(
        "band", "kind", "month", "month_no", F.coalesce("hh_count", F.lit(0)).alias("hh_count")
    )


def conversion_sums(monthly: DataFrame, base_month: int) -> DataFrame:
    """Three- and six-month totals per band and kind; bands without leavers are absent."""
    three = next_months(base_month, 3)
    return monthly.groupBy("band", "kind").agg(
        F.sum(F.when(F.col("month").isin(three), F.col("hh_count"))).alias("conv_3m"), F.sum("hh_count").alias("conv_6m")
    )


def clean_label(text: str) -> str:
    """Report column names: every special character or blank becomes an underscore."""
    return re.sub(r"[!@#$%^&*()\[\]{};:,./<>?\\|`~\-=+ ]", "_", text)


def conversion_report(scored: DataFrame, snapshot: DataFrame, base_month: int, **kw) -> DataFrame:
    """Long report (item, value): counts, month grid and 3/6-month sums.

    Months are numbered 1 to 6, so reports of different runs line up.
    """
    monthly = conversion_monthly(scored, snapshot, base_month, **kw)
    counts = band_counts(scored)
    names = scored.sparkSession.createDataFrame([(b,) for b in band_names(True)], "band string")
    totals = names.join(counts, "band", "left").select(
        F.concat("band", F.lit(" Count(Counts)")).alias("item"), F.coalesce("hh_count", F.lit(0)).alias("value")
    )
    grid = conversion_grid(monthly, base_month).select(
        F.concat("band", F.lit(" "), "kind", F.lit("(month_"), F.col("month_no").cast("string"), F.lit(")")).alias("item"), F.col("hh_count").alias("value")
    )
    sums = conversion_sums(monthly, base_month)
    parts = [
        sums.filter(f"{c} IS NOT NULL").select(F.concat("band", F.lit(" "), "kind", F.lit(t)).alias("item"), F.col(c).alias("value"))
        for c, t in (("conv_3m", " (3m CR)"), ("conv_6m", " (6m CR)"))
    ]
    out = totals.unionByName(grid).unionByName(parts[0]).unionByName(parts[1])
    special = r"[!@#$%^&*()\[\]{};:,./<>?\\|`~\-=+ ]"
    return out.select(F.regexp_replace("item", special, "_").alias("item"), F.col("value").cast("bigint").alias("value"))


def report_items() -> list[str]:
    """Names of the fixed part of the report, used to pivot it into one row."""
    items = [f"{b} Count(Counts)" for b in band_names(True)]
    for kind in ("Pending Disconnect", "Voluntary Disconnect"):
        names = band_names(kind.startswith("P"))
        items += [f"{b} {kind}(month_{m})" for b in names for m in range(1, 7)]
        items += [f"{b} {kind} ({n}m CR)" for b in names for n in (3, 6)]
    return [clean_label(i) for i in items]


def conversion_wide(report: DataFrame) -> DataFrame:
    """The report as one wide row; names are known, so the pivot needs no extra pass."""
    return report.agg(*[F.coalesce(F.max(F.when(F.col("item") == i, F.col("value"))), F.lit(0)).alias(i) for i in report_items()])


def run_record(scored: DataFrame, train: DataFrame, identity: dict[str, str], label: str = "status") -> DataFrame:
    """One row per model run: identity, class counts of train and test, all metrics."""
    counts = confusion(scored)
    n = train.agg(F.count(F.when(F.col(label) == 0, 1)).alias("a"), F.count(F.when(F.col(label) == 1, 1)).alias("c"))
    auc = roc_auc(flip_probability(scored)).scalar()
    return counts.select(
        *[F.lit(v).alias(k) for k, v in identity.items()],
        n.select("a").scalar().alias("train_actives"),
        n.select("c").scalar().alias("train_leavers"),
        (F.col("tn") + F.col("fp")).alias("test_actives"),
        (F.col("tp") + F.col("fn")).alias("test_leavers"),
        "tp", "tn", "fp", "fn",
        *[c.alias(k) for k, c in (rate_columns() | class_metric_columns()).items()],
        auc.alias("auc"),
    )


def append_log(row: DataFrame, path: str) -> None:
    """Adds the rows of a run to a log table."""
    row.write.mode("append").parquet(path)
