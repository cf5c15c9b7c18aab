"""Descriptive statistics: one pass over the table for all columns, long form for levels."""
from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import combinations
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from stayflow.functions.columns import pct2, pearson, ratio
from stayflow.operators.quantiles import counted_quantiles, group_quantiles, value_counts
from stayflow.session import materialize, materialize_wide, new_folder, quoted

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)

#: columns per aggregate; wider tables are read in several chunks of this size
CHUNK = 200

#: columns of a block, and tiles that run at the same time, in correlations of many columns
TILE = 256
TILES_AT_ONCE = 4

#: bytes of the matrices that a task holds for several groups or tiles at a time
GROUP_BYTES = 64 << 20

#: numbers of a wide table that a task works on at a time, and tasks of a core that add up products
SLICE, TASKS_OF_A_CORE = 4 << 20, 4

# The percentiles of the describe report.
DESCRIBE = {
    "p01": 0.01, "p05": 0.05, "p10": 0.1, "p20": 0.2, "p30": 0.3, "p40": 0.4, "p50": 0.5,
    "p60": 0.6, "p70": 0.7, "p80": 0.8, "p90": 0.9, "p95": 0.95, "p99": 0.99,
}


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC) and f.name not in exclude]


def categorical_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def per_column(
    df: DataFrame, cols: Sequence[str], measures: Mapping[str, object], by: Sequence[str] = (), chunk: int = CHUNK
) -> DataFrame:
    """One row per column (and group) with the given aggregates, one pass per chunk.

    ``measures`` maps a result name to a function from a Column to an aggregate.
    """
    out = None
    for at in range(0, len(cols), chunk):
        part = list(cols[at : at + chunk])
        aggs = [F.struct(F.lit(c).alias("feature"), *[f(F.col(c)).alias(m) for m, f in measures.items()]) for c in part]
        rows = df.groupBy(*by).agg(F.array(*aggs).alias("_rows")).select(*by, F.inline("_rows"))
        out = rows if out is None else out.unionByName(rows)
    return out


def number(c: str) -> Column:
    """The column as double, NaN read as missing."""
    return F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double"))


def blank_nan(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NaN read as missing in the given columns, so that every count agrees on it."""
    types = dict(df.dtypes)
    floating = [c for c in cols if types[c] in ("double", "float")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floating}) if floating else df


def missing_share(c: Column) -> Column:
    return ratio(F.count(F.when(c.isNull(), 1)), F.count(F.lit(1)))


def missing_pct(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return per_column(blank_nan(df, cols), cols, {"missing_pct": missing_share})


def unique_counts(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """Distinct non-null values per column.

    Exact form: one shuffle of the distinct (column, value) pairs, pre-aggregated on
    the map side. A single ``agg`` of many distinct counts would multiply every row.
    ``approx=True`` is a plain one-pass sketch for screening.
    """
    if approx:
        return per_column(df, cols, {"n_unique": F.approx_count_distinct})
    pairs = long_levels(df, cols).filter("level IS NOT NULL").distinct()
    counted = pairs.groupBy("feature").agg(F.count(F.lit(1)).alias("n_unique"))
    names = _names(df, cols)
    return names.join(counted, "feature", "left").select("feature", F.coalesce("n_unique", F.lit(0)).alias("n_unique"))


def few_valued(df: DataFrame, cols: Sequence[str], at_most: int) -> dict[str, int]:
    """Exact distinct counts of the columns that have at most ``at_most`` values.

    A one-pass sketch rules out the columns far above the limit; only the rest are
    counted exactly, so a high-cardinality column is never shuffled.
    """
    if not cols:
        return {}
    sketch = unique_counts(df, cols, approx=True).collect()
    near = [r["feature"] for r in sketch if r["n_unique"] <= 2 * at_most + 50]
    exact = unique_counts(df, near).collect() if near else []
    return {r["feature"]: r["n_unique"] for r in exact if r["n_unique"] <= at_most}


def _names(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The column names as a frame: a literal array, nothing is read."""
    one = df.sparkSession.range(1)
    return one.select(F.explode(F.array(*[F.lit(c) for c in cols])).alias("feature"))


def long_levels(df: DataFrame, cols: Sequence[str], keep: Sequence[str | Column] = ()) -> DataFrame:
    """(keep..., feature, level) rows, one per column, levels as text."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("level")) for c in cols])
    return df.select(*keep, F.inline(pairs if cols else pairs.cast("array<struct<feature:string,level:string>>")))


def long_numbers(df: DataFrame, cols: Sequence[str], keep: Sequence[str | Column] = ()) -> DataFrame:
    """(keep..., feature, value) rows, one per column, values as double."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), number(c).alias("value")) for c in cols])
    return df.select(*keep, F.inline(pairs))


def class_counts(df: DataFrame, label: str = "status") -> DataFrame:
    """Rows and share per class; the window runs over one row per class."""
    n = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("share", ratio(F.col("n"), F.sum("n").over(Window.partitionBy(F.lit(0)))))


def level_distribution(df: DataFrame, cols: Sequence[str], key: str = "chc_id", label: str = "status") -> DataFrame:
    """Distinct customers per (attribute, class, level), null levels left out.

    Two plain aggregates: the distinct pairs first, so a hot level is reduced on the
    map side and its final count is spread over the keys.
    """
    rows = long_levels(df, cols, [key, label]).filter("level IS NOT NULL").distinct()
    return rows.groupBy("feature", label, "level").agg(F.count(F.lit(1)).alias("customers"))


def number_summary(df: DataFrame, cols: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Mean, sample sd, median, min and max per feature and group."""
    rows = long_numbers(df, cols, by)
    keys = [*by, "feature"]
    moments = rows.groupBy(*keys).agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("sd"), F.min("value").alias("min"), F.max("value").alias("max")
    )
    return moments.join(group_quantiles(rows, keys, "value", {"median": 0.5}), keys, "left")


def describe(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), probs: Mapping[str, float] = DESCRIBE) -> DataFrame:
    """Count, mean, sd, min, percentiles, max and missing share per feature (and group).

    The table is read and unpivoted once: equal values are counted and written, and
    everything comes from the counts.
    """
    keys = [*by, "feature"]
    counts = materialize(value_counts(long_numbers(df, cols, by), keys, "value"), "values")
    v, n = F.col("_v"), F.col("_n")
    known = F.when(v.isNotNull(), n)
    moments = counts.groupBy(*keys).agg(
        F.coalesce(F.sum(known), F.lit(0)).alias("n"),
        (F.sum(v * n) / F.sum(known)).alias("mean"),
        F.min("_v").alias("min"),
        F.max("_v").alias("max"),
        ratio(100 * F.coalesce(F.sum(F.when(v.isNull(), n)), F.lit(0)), F.sum("_n")).alias("missing_pct"),
    )
    same = lambda a, b: [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys]
    off = counts.alias("c").join(moments.alias("m"), same("c", "m")).select("c.*", (v - F.col("m.mean")).alias("_off"))
    spread = off.groupBy(*keys).agg(F.sqrt(F.sum(n * F.col("_off") * F.col("_off")) / F.nullif(F.sum(known) - 1, F.lit(0))).alias("sd"))
    moments = moments.alias("m").join(spread.alias("s"), same("m", "s")).select(*[f"m.{k}" for k in keys], "n", "mean", "sd", "min", "max", "missing_pct")
    return moments.join(counted_quantiles(counts.filter("_v IS NOT NULL"), keys, probs), keys, "left")


def with_populations(df: DataFrame, populations: Mapping[str, Column]) -> DataFrame:
    """One copy of a row per population it belongs to, tagged ``population``."""
    tags = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in populations.items()]))
    return df.select(F.explode(tags).alias("population"), "*")


def level_outcomes(df: DataFrame, cols: Sequence[str], outcomes: Sequence[str]) -> DataFrame:
    """Per (feature, level): customers, outcome sums, their shares and rates in percent.

    The level counts are the only shuffle of rows; the shares are windows over levels.
    """
    rows = long_levels(df, cols, outcomes).withColumn("level", F.coalesce("level", F.lit("None")))
    counts = rows.groupBy("feature", "level").agg(
        F.count(F.lit(1)).alias("customers"), *[F.sum(o).cast("bigint").alias(o) for o in outcomes]
    )
    totals = counts.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n_levels"),
        F.sum("customers").alias("_customers"),
        *[F.sum(o).alias(f"_{o}") for o in outcomes],
    )
    shares = [pct2(F.col(c), F.col(f"_{c}")).alias(f"{c}_share") for c in ["customers", *outcomes]]
    rates = [pct2(F.col(o), F.col("customers")).alias(f"{o}_rate") for o in outcomes]
    return counts.join(F.broadcast(totals), "feature").select("feature", "level", "n_levels", "customers", *outcomes, *shares, *rates)


def group_number_stats(df: DataFrame, group: str, cols: Sequence[str]) -> DataFrame:
    """Count, mean, median, max, min, sd and sum of each feature per group, long form."""
    rows = long_numbers(df, cols, [F.col(group).cast("string").alias("grp")]).filter("grp IS NOT NULL")
    keys = ["grp", "feature"]
    moments = rows.groupBy(*keys).agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.max("value").alias("max"),
        F.min("value").alias("min"),
        F.stddev_samp("value").alias("std"),
        F.coalesce(F.sum("value"), F.lit(0.0)).alias("sum"),
    )
    return moments.join(group_quantiles(rows, keys, "value", {"median": 0.5}), keys, "left")


def group_level_shares(df: DataFrame, group: str, cols: Sequence[str], max_levels: int = 20) -> DataFrame:
    """Share of each level inside each group, zero where a group lacks it, long form.

    Only features with at most ``max_levels`` levels take part, so the zero grid is
    groups x (features x max_levels) and never a product of two data-sized frames.
    """
    kept = few_valued(df, [c for c in cols if c != group], max_levels)
    grp = F.col(group).cast("string").alias("grp")
    rows = long_levels(df, sorted(kept), [grp]).filter("grp IS NOT NULL AND level IS NOT NULL")
    counts = rows.groupBy("grp", "feature", "level").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("grp", "feature").agg(F.sum("n").alias("t"))
    levels = counts.groupBy("feature").agg(F.collect_set("level").alias("levels"))  # bounded by max_levels
    grid = totals.join(F.broadcast(levels), "feature").select("grp", "feature", "t", F.explode("levels").alias("level"))
    return grid.join(counts, ["grp", "feature", "level"], "left").select(
        "grp", "feature", "level", ratio(F.coalesce("n", F.lit(0)), F.col("t")).alias("share")
    )


def is_wide(cols: Sequence[str], tile: int = TILE) -> bool:
    """Whether so many columns are worked off as matrices of Arrow batches, and their correlations in tiles."""
    return len(cols) > 2 * tile


def wide_target_correlation(
    df: DataFrame, cols: Sequence[str], label: str = "status", name: str = "corr", center: Mapping[str, tuple[float, float]] | None = None
) -> DataFrame:
    """(feature, corr) for very many columns: one Arrow pass of products with the label.

    The same figures as :func:`target_correlation`, whose aggregates take long to plan and
    to compile for a thousand columns. ``center`` is that of :func:`pair_correlations`.
    """
    names = [label, *cols]
    center = wide_moments(df, names) if center is None else center
    total = _summed_products(df, names, [0], range(1, len(names)), center)
    return _named_pairs(_pearson_of_sums(total), (), names).select(F.col("col_b").alias("feature"), F.col("corr").alias(name))


def target_correlation(
    df: DataFrame, cols: Sequence[str], label: str = "status", name: str = "corr", center: Mapping[str, tuple[float, float]] | None = None
) -> DataFrame:
    """Pearson r of every column with the label, all in one aggregate per chunk."""
    if is_wide(cols):
        return wide_target_correlation(df, cols, label, name, center)
    y = F.col(label).cast("double")
    missing = F.lit(None).cast("double")
    return per_column(df, cols, {name: lambda x: pearson(F.nanvl(x.cast("double"), missing), y)})


#: variance, in units of the whole column's, below which a column counts as constant
_FLAT = 1e-13


def pair_correlations(
    df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), center: Mapping[str, tuple[float, float]] | None = None, least: float | None = None, tile: int = TILE,
) -> DataFrame:
    """(by..., col_a, col_b, corr) for every pair in column order, over complete pairs.

    ``least`` leaves out the pairs whose correlation, rounded to nine places, does not
    exceed it on either side. More than ``2 * tile`` columns without groups are worked off
    in tiles, see :func:`_tiled_correlations`; the results are the same.

    Each task adds up the cross products of its Arrow batches as one matrix product and
    sends a single row per pair; Spark sums those rows. With x centred and ``seen`` its
    0/1 mask, the products of x, x*x and ``seen`` hold every sum that a
    pairwise-complete correlation needs, so the table is read once however many
    columns and gaps it has. A plain aggregate would update three buffers per pair
    and row, and would need many passes for a wide table. ``center`` gives a mean and
    spread per column when they are known, which saves the pass that finds them.
    """
    cols, by = list(cols), list(by)
    if len(cols) < 2:
        groups = df.select(*by).limit(0) if by else df.sparkSession.range(0).select()
        return groups.select(*by, F.lit("").alias("col_a"), F.lit("").alias("col_b"), F.lit(0.0).alias("corr"))
    if not by and is_wide(cols, tile):
        return _named_pairs(_tiled_correlations(df, cols, center, least, tile), (), cols)
    numbers = df.select(*by, *[number(c).alias(f"_{i}") for i, c in enumerate(cols)])
    names = [f"_{i}" for i in range(len(cols))]
    if center is None:
        shift = {r["feature"]: (r["m"] or 0.0, r["s"] or 1.0) for r in per_column(numbers, names, {"m": F.avg, "s": F.stddev_pop}).collect()}
    else:
        shift = {n: center[c] for n, c in zip(names, cols)}
    z = numbers.select(*by, *[((F.col(c) - shift[c][0]) / shift[c][1]).alias(c) for c in names])
    sums = ["n", "sx", "sy", "sxx", "syy", "sxy"]
    keys = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in z.schema.fields[: len(by)])
    schema = (keys + ", " if keys else "") + "i int, j int, " + ", ".join(f"{s} double" for s in sums)
    total = z.mapInPandas(_cross_products(by, names), schema).groupBy(*by, "i", "j").agg(*[F.sum(s).alias(s) for s in sums])
    return _named_pairs(_exceeding(_pearson_of_sums(total, by), least), by, cols)


def _pearson_of_sums(total: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by..., i, j, corr) from the summed products of standardised columns."""
    n = F.col("n")
    mx, my = ratio(F.col("sx"), n), ratio(F.col("sy"), n)
    vx, vy = ratio(F.col("sxx"), n) - mx * mx, ratio(F.col("syy"), n) - my * my
    flat = (vx <= _FLAT) | (vy <= _FLAT)
    corr = F.when(~flat, ratio(ratio(F.col("sxy"), n) - mx * my, F.sqrt(vx * vy)))
    return total.select(*by, "i", "j", corr.alias("corr"))


def _exceeding(pairs: DataFrame, least: float | None) -> DataFrame:
    return pairs if least is None else pairs.filter(F.round(F.abs("corr"), 9) > least)


def _named_pairs(pairs: DataFrame, by: Sequence[str], cols: Sequence[str]) -> DataFrame:
    label = F.from_json(F.lit(json.dumps(list(cols))), "array<string>")  # folded to one literal
    return pairs.select(*by, F.element_at(label, F.col("i") + 1).alias("col_a"), F.element_at(label, F.col("j") + 1).alias("col_b"), "corr")


def _as_array(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The columns as doubles in one array: a row then goes to Python in one piece, not in a buffer for each column."""
    return df.selectExpr(f"array({', '.join(f'CAST({quoted(c)} AS DOUBLE)' for c in cols)}) AS x")


def _matrix_reader() -> Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]]:
    """The rows of Arrow batches of one array column, or of number columns, some at a time; missing is NaN."""

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            packed = pa.types.is_list(batch.schema.types[0])
            width = len(batch.column(0)[0]) if packed and batch.num_rows else batch.num_columns
            step = max(SLICE // width, 1)
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                if packed:
                    yield part.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                else:
                    yield np.column_stack([c.to_numpy(zero_copy_only=False) for c in part.columns]).astype("float64")

    return matrices  # made here, so that it goes to the workers with its code


def wide_moments(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and spread of many columns in one Arrow pass: they only shift and scale, so rounding does not matter."""
    k, matrices = len(cols), _matrix_reader()

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, m2 = (np.zeros(k) for _ in range(3))
        for x in matrices(batches):
            gaps = np.isnan(x)
            seen = len(x) - gaps.sum(axis=0)
            gappy = seen < len(x)
            here = np.where(gappy, 0.0, x.sum(axis=0) / len(x))
            here[gappy] = np.where(gaps[:, gappy], 0.0, x[:, gappy]).sum(axis=0) / np.maximum(seen[gappy], 1)
            off = x - here
            off[:, gappy] = np.where(gaps[:, gappy], 0.0, off[:, gappy])
            gap, total = here - mean, np.maximum(n + seen, 1)
            m2 += np.einsum("ij,ij->j", off, off) + gap * gap * n * seen / total
            mean, n = mean + gap * seen / total, n + seen
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k, dtype="int32")), pa.array(n), pa.array(mean), pa.array(m2)], names=["i", "n", "mean", "m2"])

    parts = _as_array(df, cols).mapInArrow(add_up, "i int, n double, mean double, m2 double").filter("n > 0")
    whole = parts.groupBy("i").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("mean")).alias("s"), F.sum(F.col("m2") + F.col("n") * F.col("mean") * F.col("mean")).alias("q"))
    found = {}
    for r in whole.collect():  # one row per column
        mean = r["s"] / r["n"]
        found[cols[r["i"]]] = mean, max(r["q"] / r["n"] - mean * mean, 0.0) ** 0.5 or 1.0
    return {c: found.get(c, (0.0, 1.0)) for c in cols}


def _summed_products(df: DataFrame, cols: Sequence[str], left: Sequence[int], right: Sequence[int], center: Mapping[str, tuple[float, float]]) -> DataFrame:
    """(i, j, sums) of the standardised columns of two blocks, read in one pass.

    A task sends a row for each pair of columns whatever its rows, so there are only a few tasks for each core.
    """
    read = list(dict.fromkeys([*left, *right]))
    sums = ["n", "sx", "sy", "sxx", "syy", "sxy"]
    shift, spread = (np.array([center[cols[i]][s] for i in read]) for s in (0, 1))
    rows = _as_array(df, [cols[i] for i in read]).coalesce(TASKS_OF_A_CORE * df.sparkSession.sparkContext.defaultParallelism)
    made = rows.mapInArrow(_tile_products(left, right, shift, spread), "i int, j int, " + ", ".join(f"{s} double" for s in sums))
    return made.groupBy("i", "j").agg(*[F.sum(s).alias(s) for s in sums])


def _tiled_correlations(df: DataFrame, cols: Sequence[str], center: Mapping[str, tuple[float, float]] | None, least: float | None, tile: int) -> DataFrame:
    """(i, j, corr) of all pairs of columns, one job for each pair of column blocks.

    A block has as many tiles of columns as ``GROUP_BYTES`` has room for their matrices. A
    task then reads the columns of two blocks, holds six matrices and sends a row for each
    pair in them, however many columns there are; up to a thousand columns are one block,
    so the table is read once. With more blocks, or without ``center``, it is stored first.
    Only the pairs that exceed ``least`` are kept. Every pair of blocks is a table of its
    own in the shared folder: some run at the same time, and one that fails is written
    again without touching the others.
    """
    spark = df.sparkSession
    side = tile * max(isqrt(GROUP_BYTES // (48 * tile * tile)), 1)
    blocks = [range(a, min(a + side, len(cols))) for a in range(0, len(cols), side)]
    if len(blocks) > 1 or center is None:  # then it is read several times
        df = materialize_wide(df.selectExpr(*[f"CAST({quoted(c)} AS DOUBLE) AS _{i}" for i, c in enumerate(cols)]), "numbers")
        center = None if center is None else {f"_{i}": center[c] for i, c in enumerate(cols)}
        cols = df.columns
    center = wide_moments(df, cols) if center is None else center
    tiles = [(a, b) for a in range(len(blocks)) for b in range(a, len(blocks))]
    folder = new_folder(spark, "correlation-tiles")

    def work(pair: tuple[int, int]) -> None:
        total = _summed_products(df, cols, blocks[pair[0]], blocks[pair[1]], center)
        _exceeding(_pearson_of_sums(total), least).write.mode("overwrite").parquet(f"{folder}/tile={pair[0] * len(blocks) + pair[1]}")

    with ThreadPoolExecutor(TILES_AT_ONCE) as pool:
        list(pool.map(inheritable_thread_target(spark)(work), tiles))
    return spark.read.schema("i int, j int, corr double, tile int").parquet(folder).drop("tile")


def _tile_products(left: Sequence[int], right: Sequence[int], shift: np.ndarray | None = None, spread: np.ndarray | None = None):
    """Adds up, over a task's batches, the products of the columns of two blocks, less ``shift`` and by ``spread``.

    The sums of a pair that depend on one of its columns only are kept once for each
    column; a matrix has them for the columns in which a gap was met, from there on.
    """
    p, q, same, matrices = len(left), len(right), list(left) == list(right), _matrix_reader()
    chosen = np.triu_indices(p, 1) if same else tuple(x.ravel() for x in np.indices((p, q)))

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sx, sy, sxx, syy, sxy = acc = np.zeros((6, p, q))
        own = np.zeros((3, len(set([*left, *right]))))  # values seen, their sum and that of their squares
        gappy = np.zeros(own.shape[1], bool)
        a, b = (lambda v: v[..., :p]), (lambda v: v[..., -q:])  # the two blocks of anything by column
        for x in matrices(batches):
            x = x.copy() if shift is None else (x - shift) / spread
            gaps = np.isnan(x)
            new = gaps.any(axis=0) & ~gappy
            if new.any():  # so far each of these was there in every row
                n[a(new)], sy[a(new)], syy[a(new)] = b(own)
                n[:, b(new)], sx[:, b(new)], sxx[:, b(new)] = a(own)[:, :, None]
                gappy |= new
            holes = np.flatnonzero(gappy)
            x[:, holes] = np.where(gaps[:, holes], 0.0, x[:, holes])
            squares = x * x
            own += [len(x) - gaps.sum(axis=0), x.sum(axis=0), squares.sum(axis=0)]
            if len(holes):
                ga, gb = a(gappy), b(gappy)
                wa, wb = (~f(gaps)[:, g] for f, g in ((a, ga), (b, gb)))
                wa, wb = wa.astype("float64"), wb.astype("float64")
                n[np.ix_(ga, gb)] += wa.T @ wb
                sx[:, gb] += a(x).T @ wb
                sxx[:, gb] += a(squares).T @ wb
                if not same:
                    sy[ga] += wa.T @ b(x)
                    syy[ga] += wa.T @ b(squares)
            sxy += a(x).T @ b(x)
        fa, fb = ~a(gappy), ~b(gappy)
        n[fa], sy[fa], syy[fa] = b(own)
        n[:, fb], sx[:, fb], sxx[:, fb] = a(own)[:, :, None]
        if same:
            sy[:], syy[:] = sx.T, sxx.T
        i, j = np.asarray(left, "int32")[chosen[0]], np.asarray(right, "int32")[chosen[1]]
        for at in range(0, len(i), 1 << 16):
            some = slice(at, at + (1 << 16))
            places = chosen[0][some], chosen[1][some]
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in [i[some], j[some], *(m[places] for m in acc)]], names=["i", "j", "n", "sx", "sy", "sxx", "syy", "sxy"])

    return add_up


def _cross_products(by: list[str], names: list[str]):
    k = len(names)
    upper = np.triu_indices(k, 1)
    most = max(1, GROUP_BYTES // (32 * k * k))

    def sums(acc: dict) -> Iterator[pd.DataFrame]:
        for key, (n, sx, sxx, sxy) in acc.items():
            out = pd.DataFrame(
                {
                    "i": upper[0], "j": upper[1], "n": n[upper], "sx": sx[upper], "sy": sx.T[upper],
                    "sxx": sxx[upper], "syy": sxx.T[upper], "sxy": sxy[upper],
                }
            )
            for b, v in zip(by, key if isinstance(key, tuple) else (key,)):
                out.insert(0, b, v)
            yield out[[*by, "i", "j", "n", "sx", "sy", "sxx", "syy", "sxy"]]
        acc.clear()

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        acc: dict = {}
        for pdf in batches:
            for key, part in pdf.groupby(by, dropna=False) if by else [((), pdf)]:
                x = part[names].to_numpy("float64")
                seen = ~np.isnan(x)
                x, w = np.where(seen, x, 0.0), seen.astype("float64")
                if key not in acc and len(acc) >= most:
                    yield from sums(acc)  # Spark adds up what a group sends in several parts
                total = acc.setdefault(key, np.zeros((4, k, k)))
                total += [w.T @ w, x.T @ w, (x * x).T @ w, x.T @ x]
        yield from sums(acc)

    return add_up


def top_partners(pairs: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` most correlated partners of each feature side by side.

    ``pairs`` has one row per pair of columns, a metadata-sized frame.
    """
    both = pairs.select(F.col("col_a").alias("feature"), F.col("col_b").alias("partner"), "corr").unionByName(
        pairs.select(F.col("col_b").alias("feature"), F.col("col_a").alias("partner"), "corr")
    )
    w = Window.partitionBy("feature").orderBy(F.abs("corr").desc_nulls_last(), F.asc("partner"))
    ranked = both.filter("corr IS NOT NULL").withColumn("k", F.row_number().over(w)).filter(F.col("k") <= k)
    cells = []
    for i in range(1, k + 1):
        cells.append(F.max(F.when(F.col("k") == i, F.col("partner"))).alias(f"feature_{i}"))
        cells.append(F.max(F.when(F.col("k") == i, F.col("corr"))).alias(f"corr_{i}"))
    return ranked.groupBy("feature").agg(*cells)


def outcome_rates(train: DataFrame, test: DataFrame, features: Sequence[str], ways: int, label: str = "status") -> DataFrame:
    """Segment size and outcome rate for every combination of ``ways`` features.

    Rows are first reduced to the cells of all features together; the grouping sets then
    copy cells and not rows, and the two small results are joined.
    """
    combos = list(combinations(features, ways))

    def rates(df: DataFrame, name: str) -> DataFrame:
        sets = [[F.col(c) for c in combo] for combo in combos]
        keep = df.select(*[F.col(f).cast("string").alias(f) for f in features], F.col(label).alias("_y"))
        whole = keep.groupBy(*features).agg(F.count(F.lit(1)).alias("_n"), F.sum("_y").alias("_y"))
        agg = whole.groupingSets(sets, *[F.col(f) for f in features]).agg(
            F.grouping_id().alias("_gid"), F.sum("_n").alias(f"n_{name}"), F.sum("_y").alias(f"y_{name}")
        )
        cells = []
        for j in range(ways):
            feature, level = None, None
            for combo in combos:
                here = F.col("_gid") == _grouping_mask(features, combo)
                feature = F.when(here, F.lit(combo[j])) if feature is None else feature.when(here, F.lit(combo[j]))
                level = F.when(here, F.col(combo[j])) if level is None else level.when(here, F.col(combo[j]))
            cells += [feature.alias(f"feature{j + 1}"), level.alias(f"level{j + 1}")]
        out = agg.select(*cells, f"n_{name}", f"y_{name}")
        for j in range(ways):
            out = out.filter(F.col(f"level{j + 1}").isNotNull())
        return out

    keys = [f"{p}{j + 1}" for j in range(ways) for p in ("feature", "level")]
    size = train.agg(F.count(F.lit(1)).alias("n")).scalar()
    joined = rates(train, "train").join(rates(test, "test"), keys)
    return joined.select(
        *keys,
        F.col("n_train").alias("seg_count"),
        pct2(F.col("n_train"), size).alias("seg_pct"),
        pct2(F.col("y_train"), F.col("n_train")).alias("rate_train"),
        pct2(F.col("y_test"), F.col("n_test")).alias("rate_test"),
    )


def _grouping_mask(features: Sequence[str], combo: Sequence[str]) -> int:
    """``grouping_id``: a bit is set for each column left out, first column highest."""
    mask = 0
    for f in features:
        mask = mask * 2 + (0 if f in combo else 1)
    return mask


def summarize_features(df: DataFrame, cols: Sequence[str], label: str | None = None) -> DataFrame:
    """Describe rows plus the outcome rate among customers that have a value."""
    base = describe(df, cols, probs={"p25": 0.25, "p50": 0.5, "p75": 0.75}).drop("missing_pct").join(
        missing_pct(df, cols), "feature"
    )
    if label is None:
        return base
    rate = per_column(df, cols, {"rate": lambda c: F.avg(F.when(c.isNotNull(), F.col(label)))})
    return base.join(rate.select("feature", F.round("rate", 4).alias("rate")), "feature")
