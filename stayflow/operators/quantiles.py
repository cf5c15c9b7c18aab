"""Exact, interpolated quantiles that never hold all values of a column in one task.

Two forms. ``exact_quantiles`` serves the fits: few columns, results as driver
literals. It narrows each wanted rank to a small value interval by counting, so only
the rows of those intervals are shuffled. ``group_quantiles`` serves reports with
any number of groups and stays a DataFrame.
"""
from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stayflow.functions.columns import present
from stayflow.operators.ordered import running_totals

#: distinct values one task may sort; larger intervals are split again
INTERVAL_LIMIT = 2_000_000
_CUTS = 200


@dataclass(frozen=True)
class _Interval:
    feature: str
    lo: float
    hi: float  # values v with lo <= v < hi
    before: int  # rows of the feature below lo
    ranks: tuple[int, ...]  # wanted 0-based ranks inside


def _edges(iv: Sequence[_Interval], cols: Sequence[str]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each column with intervals, by place: their lower and upper ends and their numbers, in order."""
    out = {}
    for j, c in enumerate(cols):
        own = sorted((x.lo, x.hi, i) for i, x in enumerate(iv) if x.feature == c)
        if own:
            lo, hi, at = zip(*own)
            out[j] = np.array(lo), np.array(hi), np.array(at, dtype="int32")
    return out


def _searcher(df: DataFrame, cols: Sequence[str], iv: Sequence[_Interval]):
    """The columns with intervals, and a function from Arrow batches of them to (numbers of intervals, values inside).

    The ends are searched as sorted arrays, batch by batch, so the plan stays the same
    for one interval and for a hundred thousand.
    """
    edges = _edges(iv, cols)
    wide = df.select(*[F.col(f"`{c}`").cast("double").alias(f"_{j}") for j, c in enumerate(cols) if j in edges])
    order = sorted(edges)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for batch in batches:
            for k, j in enumerate(order):
                lo, hi, at = edges[j]
                x = batch.column(k).to_numpy(zero_copy_only=False).astype("float64")
                x = x[~np.isnan(x)]  # nulls arrive as NaN
                place = np.searchsorted(lo, x, side="right") - 1
                ok = (place >= 0) & ((x < hi[place]) | (hi[place] == math.inf))
                yield at[place[ok]], x[ok]

    return wide, search


def _inside(df: DataFrame, cols: Sequence[str], iv: Sequence[_Interval]) -> DataFrame:
    """(_iv, value) of the values inside an interval."""
    wide, search = _searcher(df, cols, iv)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for at, x in search(batches):
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(x)], names=["_iv", "value"])

    return wide.mapInArrow(rows, "_iv int, value double")


def _part_counts(df: DataFrame, cols: Sequence[str], iv: Sequence[_Interval], edges: Sequence[Sequence[float]]) -> DataFrame:
    """(_iv, part, count): how many values of an interval lie between its edges.

    Values are found and counted by one function: two in a row would take two Python workers a task.
    """
    wide, search = _searcher(df, cols, iv)
    cuts = [np.asarray(e) for e in edges]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for iv, value in search(batches):
            order = np.argsort(iv, kind="stable")
            iv, value = iv[order], value[order]
            starts = np.flatnonzero(np.diff(iv, prepend=-1))
            for a, b in zip(starts, [*starts[1:], len(iv)]):
                part, n = np.unique(np.searchsorted(cuts[iv[a]], value[a:b], side="right"), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), iv[a], "int32")), pa.array(part.astype("int32")), pa.array(n.astype("int64"))], names=["_iv", "part", "n"])

    return wide.mapInArrow(count, "_iv int, part int, n bigint").groupBy("_iv", "part").agg(F.sum("n").alias("count"))


def _split(df: DataFrame, cols: Sequence[str], iv: Sequence[_Interval]) -> list[_Interval]:
    """Cut each interval at its approximate quantiles; keep the parts with wanted ranks."""
    rows = _inside(df, cols, iv)
    probs = [k / _CUTS for k in range(1, _CUTS)]
    cuts = {
        r["_iv"]: r["cuts"]
        for r in rows.groupBy("_iv").agg(F.percentile_approx("value", probs, 2000).alias("cuts")).collect()
    }
    edges: list[list[float]] = []
    for i, x in enumerate(iv):
        seen = cuts.get(i, [])
        # a repeated cut is a hot value: fence it off on its own
        fenced = set(seen) | {math.nextafter(v, math.inf) for v in seen}
        edges.append([x.lo] + sorted(v for v in fenced if x.lo < v < x.hi))
    counted: dict[int, dict[int, int]] = {}
    for r in _part_counts(df, cols, iv, edges).collect():
        counted.setdefault(r["_iv"], {})[r["part"]] = r["count"]
    out = []
    for i, x in enumerate(iv):
        before = x.before
        for k, lo in enumerate(edges[i], start=1):
            n = counted.get(i, {}).get(k, 0)
            inside = tuple(t for t in x.ranks if before <= t < before + n)
            if inside:
                hi = edges[i][k] if k < len(edges[i]) else x.hi
                out.append(_Interval(x.feature, lo, hi, before, inside))
            before += n
    return out


def _picker(intervals: Sequence[_Interval]):
    """Values at the wanted ranks of one interval, from its distinct values and counts.

    Only the two columns that matter are made into arrays, and one of them is put in order.
    """
    wanted = [(x.before, x.ranks) for x in intervals]

    def pick(table: pa.Table) -> pa.Table:
        iv = table.column("_iv")[0].as_py()
        before, ranks = wanted[iv]
        value, count = (table.column(c).to_numpy() for c in ("value", "count"))
        order = np.argsort(value, kind="stable")
        upto = before + count[order].cumsum()
        at = order[np.searchsorted(upto, np.asarray(ranks), side="right")]
        return pa.table({"_iv": np.full(len(ranks), iv, "int32"), "t": np.asarray(ranks, "int64"), "value": value[at]})

    return pick


def exact_quantiles(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], limit: int = INTERVAL_LIMIT
) -> dict[str, list[float | None]]:
    """Linear-interpolated quantiles of each column, nulls skipped, all-null gives None."""
    cols = list(cols)
    if not cols:
        return {}
    types = dict(df.dtypes)
    ok = {c: F.when(present(F.col(c), types[c]), F.col(c).cast("double")) for c in cols}
    head = df.agg(
        *[F.count(ok[c]).alias(f"n{i}") for i, c in enumerate(cols)],
        *[F.approx_count_distinct(ok[c]).alias(f"d{i}") for i, c in enumerate(cols)],
    ).first()
    n = {c: head[f"n{i}"] for i, c in enumerate(cols)}
    wide = {c for i, c in enumerate(cols) if head[f"d{i}"] > limit}
    wanted = {}
    for c in cols:
        spots = [p * (n[c] - 1) for p in probs] if n[c] else []
        wanted[c] = tuple(sorted({math.floor(s) for s in spots} | {math.ceil(s) for s in spots}))
    done: list[_Interval] = []
    todo = [_Interval(c, -math.inf, math.inf, 0, wanted[c]) for c in cols if n[c]]
    while todo:
        done += [x for x in todo if x.feature not in wide]
        todo = [x for x in todo if x.feature in wide]
        if not todo:
            break
        parts = _split(df, cols, todo)
        inside = _inside(df, cols, parts)
        spread = {
            r["_iv"]: r["d"] for r in inside.groupBy("_iv").agg(F.approx_count_distinct("value").alias("d")).collect()
        }
        todo = [x for i, x in enumerate(parts) if spread.get(i, 0) > limit]
        done += [x for i, x in enumerate(parts) if spread.get(i, 0) <= limit]
    found: dict[tuple[str, int], float] = {}
    if done:
        rows = _inside(df, cols, done)
        counts = rows.groupBy("_iv", "value").count()
        # an interval holds at most ``limit`` distinct values, so a task can sort one
        picked = counts.groupBy("_iv").applyInArrow(_picker(done), "_iv int, t bigint, value double")
        for r in picked.collect():  # at most two rows per column and probability
            found[(done[r["_iv"]].feature, r["t"])] = r["value"]
    out: dict[str, list[float | None]] = {}
    for c in cols:
        out[c] = []
        for p in probs:
            if not n[c]:
                out[c].append(None)
                continue
            spot = p * (n[c] - 1)
            lo, hi = found[(c, math.floor(spot))], found[(c, math.ceil(spot))]
            out[c].append(lo + (hi - lo) * (spot - math.floor(spot)))
    return out


def value_counts(rows: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """(by..., _v, _n): how often each group holds a value, null among them."""
    return rows.groupBy(*by, F.col(value).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_n"))


def group_quantiles(rows: DataFrame, by: Sequence[str], value: str, probs: Mapping[str, float]) -> DataFrame:
    """One row per group with a column per named probability.

    ``rows`` is long: group columns and one numeric value. Equal values are counted
    before anything is ordered, and a large group is spread over many slices.
    """
    return counted_quantiles(value_counts(rows.filter(F.col(value).isNotNull()), by, value), by, probs)


def counted_quantiles(counts: DataFrame, by: Sequence[str], probs: Mapping[str, float]) -> DataFrame:
    """The same from :func:`value_counts` without nulls."""
    by = list(by)
    spans = running_totals(counts, [F.col("_v")], ["_n"], by)
    sizes = spans.groupBy(*by).agg(F.sum("_n").alias("_size"))
    spots = F.array(
        *[F.struct(F.lit(name).alias("p"), (F.lit(float(p)) * (F.col("_size") - 1)).alias("at")) for name, p in probs.items()]
    )
    first, last = F.col("_n_before"), F.col("_n_before") + F.col("_n") - 1
    spread = spans.join(sizes, by)
    hit = F.filter(spots, lambda s: (F.ceil(s["at"]) >= first) & (F.floor(s["at"]) <= last))
    at = F.col("_s.at")
    ends = (
        spread.select(*by, "_v", first.alias("_first"), last.alias("_last"), F.explode(hit).alias("_s"))
        .groupBy(*by)
        .agg(
            *[
                F.max(F.when((F.col("_s.p") == name) & F.floor(at).between(F.col("_first"), F.col("_last")), F.col("_v"))).alias(f"lo_{name}")
                for name in probs
            ],
            *[
                F.max(F.when((F.col("_s.p") == name) & F.ceil(at).between(F.col("_first"), F.col("_last")), F.col("_v"))).alias(f"hi_{name}")
                for name in probs
            ],
            *[F.max(F.when(F.col("_s.p") == name, at - F.floor(at))).alias(f"fr_{name}") for name in probs],
        )
    )
    return ends.select(
        *by,
        *[(F.col(f"lo_{m}") + (F.col(f"hi_{m}") - F.col(f"lo_{m}")) * F.col(f"fr_{m}")).alias(m) for m in probs],
    )
