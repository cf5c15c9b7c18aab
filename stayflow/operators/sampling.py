"""Seeded splits decided by a hash of the key: repeatable on any partitioning.

Exact class counts need ranks over a class that may hold most of the table, so the
ranks come from the sliced ``global_rank`` and not from a window per class.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stayflow.operators.ordered import running_totals


def key_hash(key: str, seed: int) -> Column:
    return F.xxhash64(F.col(key), F.lit(seed))


def class_rank(df: DataFrame, key: str, label: str, seed: int) -> DataFrame:
    """Adds ``class_rank`` 1..n_c in hash order inside each class and ``class_size``."""
    hashed = df.withColumn("_h", key_hash(key, seed)).withColumn("_one", F.lit(1).cast("bigint"))
    ranked = running_totals(hashed, [F.col("_h"), F.col(key)], ["_one"], [label])
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("class_size"))  # two rows
    return (
        ranked.join(F.broadcast(sizes), label)
        .withColumn("class_rank", F.col("_one_before") + 1)
        .drop("_h", "_one", "_one_before")
    )


def downsample(df: DataFrame, key: str = "chc_id", label: str = "status", seed: int = 0) -> DataFrame:
    """All positives and an equal number of negatives, picked by key hash."""
    n_pos = df.filter(F.col(label) == 1).count()
    ranked = class_rank(df, key, label, seed)
    return ranked.filter((F.col(label) == 1) | (F.col("class_rank") <= n_pos)).drop("class_rank", "class_size")


def stratified_split(
    df: DataFrame, test_share: float = 0.25, key: str = "chc_id", label: str = "status", seed: int = 0
) -> DataFrame:
    """Adds ``split``: the first ``ceil(share * class size)`` keys of a class are test."""
    ranked = class_rank(df, key, label, seed)
    cutoff = F.ceil(F.col("class_size") * F.lit(test_share))
    return ranked.withColumn("split", F.when(F.col("class_rank") <= cutoff, "test").otherwise("train")).drop(
        "class_rank", "class_size"
    )


def stratified_folds(df: DataFrame, k: int = 3, key: str = "chc_id", label: str = "status", seed: int = 0) -> DataFrame:
    """Adds ``fold`` 0..k-1, dealt round-robin inside each class."""
    ranked = class_rank(df, key, label, seed)
    return ranked.withColumn("fold", ((F.col("class_rank") - 1) % k).cast("int")).drop("class_rank", "class_size")


def shuffle_splits(
    df: DataFrame, n: int = 3, train_share: float = 0.8, key: str = "chc_id", label: str = "status", seed: int = 0
) -> DataFrame:
    """``n`` independent stratified splits as columns ``train_0 .. train_{n-1}`` (1 = train)."""
    out = df
    for i in range(n):
        ranked = class_rank(out, key, label, seed + i)
        cutoff = F.floor(F.col("class_size") * F.lit(train_share))
        out = ranked.withColumn(f"train_{i}", F.when(F.col("class_rank") <= cutoff, 1).otherwise(0)).drop(
            "class_rank", "class_size"
        )
    return out
