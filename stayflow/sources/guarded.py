"""Tables that are checked while they are written, and tables laid out for joins without a shuffle."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, Window, functions as F


class GuardError(ValueError):
    """A table broke a rule while it was written; ``metrics`` says how."""

    def __init__(self, message: str, metrics: dict):
        super().__init__(message)
        self.metrics = metrics


def write_guarded(df: DataFrame, path: str, key: Sequence[str] = ("chc_id",), name: str = "cohort") -> dict:
    """Write ``df`` and return (rows, duplicates, missing_keys), all from the one job that writes.

    A cohort that is empty or repeats a key raises; rows with a missing key count by
    themselves and not as repeats. The sources are read once: the metrics are observed on
    the rows on their way to the files, in place of a count and a grouping beforehand.
    What was written stays at ``path`` for inspection and must not be used if this raises.
    """
    known = F.lit(True)
    for k in key:
        known = known & F.col(k).isNotNull()
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*key))
    marked = df.withColumn("_place", F.when(known, place))
    seen = Observation(f"guard of {name}")
    watched = marked.observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.col("_place") > 1).alias("duplicates"), F.count_if(F.col("_place").isNull()).alias("missing_keys")
    )
    watched.drop("_place").write.mode("overwrite").parquet(path)
    metrics = dict(seen.get)
    if not metrics["rows"]:
        raise GuardError(f"cohort {name} is empty", metrics)
    if metrics["duplicates"]:
        raise GuardError(f"duplicate keys in {', '.join(key)}: {metrics['duplicates']} rows of {name}", metrics)
    return metrics


def store_bucketed(df: DataFrame, table: str, path: str, key: str = "chc_id", month: str | None = "dt", buckets: int = 16) -> DataFrame:
    """Store ``df`` at ``path`` as a table in buckets of ``key``, within each month.

    Semi joins of months, groupings by key and joins of tables with the same buckets then
    need no shuffle of rows. ``buckets`` should give files of some hundred MB a month. Rows are
    dealt by month and bucket before the write, so that each bucket is one file; there are
    as many tasks as buckets of all months, so that none has to sort much more than one.
    """
    parts = [month] if month else []
    months = df.select(month).distinct().count() if month else 1
    dealt = df.repartition(max(months, 1) * buckets, *parts, F.pmod(F.hash(key), F.lit(buckets)))
    writer = dealt.write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key)
    (writer.partitionBy(*parts) if parts else writer).saveAsTable(table)
    return df.sparkSession.table(table)


def drop_stored(spark: SparkSession, table: str) -> None:
    """Forget a table's name; its files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
