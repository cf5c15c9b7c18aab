"""Null-aware scalar helpers shared by all operators."""
from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

BLANK = r"^\s*$"


def blank_to_null(c: Column) -> Column:
    return F.when(~c.rlike(BLANK), c)


def truth(c: Column) -> Column:
    """A condition with null read as false (the last branch of a two-way choice)."""
    return F.coalesce(c, F.lit(False))


def flag(c: Column) -> Column:
    return F.when(truth(c), F.lit(1)).otherwise(F.lit(0))


def ratio(num: Column, den: Column) -> Column:
    """Null instead of an error or infinity when the divisor is zero."""
    return F.try_divide(num.cast("double"), F.nullif(den.cast("double"), F.lit(0.0)))


def ratio_or_zero(num: Column, den: Column) -> Column:
    return F.coalesce(ratio(num, den), F.lit(0.0))


def int_div(a: Column, b: Column) -> Column:
    """Whole-number division; null when the divisor is zero."""
    return F.call_function("div", a.cast("bigint"), F.nullif(b.cast("bigint"), F.lit(0).cast("bigint")))


def pct2(num: Column, den: Column) -> Column:
    """``100 * num / den`` of two counts, rounded half up to two places.

    Done on integers so that the last digit never depends on binary fractions.
    """
    num, den = num.cast("bigint"), den.cast("bigint")
    return int_div(num * 20000 + den, den * 2).cast("double") / 100


def safe_number(c: Column, to: str = "double") -> Column:
    return c.try_cast(to)


def present(c: Column, dtype: str) -> Column:
    """Not null, and for floating columns not NaN either."""
    return c.isNotNull() & ~F.isnan(c) if dtype in ("double", "float") else c.isNotNull()


def pearson(x: Column, y: Column) -> Column:
    """Pearson r over complete pairs; null when either side is constant."""
    xp, yp = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_pop(xp, yp), F.nullif(F.stddev_pop(xp) * F.stddev_pop(yp), F.lit(0.0)))


def map_levels(c: Column, pairs: Mapping[str, object], default: Column | None = None) -> Column:
    """Dictionary map; levels outside the dictionary get ``default`` (null if none)."""
    if not pairs:
        return default if default is not None else F.lit(None)
    chain = None
    for level, value in pairs.items():
        value = value if isinstance(value, Column) else F.lit(value)
        chain = F.when(c == level, value) if chain is None else chain.when(c == level, value)
    return chain if default is None else chain.otherwise(default)


def keep_listed(c: Column, levels: Sequence[str], other: str = "ALL_OTHER") -> Column:
    """Whitelist compared without case; listed levels keep their own spelling, null stays null."""
    return F.when(c.isNull() | F.upper(c).isin([v.upper() for v in levels]), c).otherwise(F.lit(other))


def contains_ci(c: Column, word: str) -> Column:
    return F.lower(c).contains(word.lower())


def first_match(c: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The label of the first word contained in ``c``; ``c`` itself when none is."""
    out = F.when(contains_ci(c, rules[0][0]), F.lit(rules[0][1]))
    for word, label in rules[1:]:
        out = out.when(contains_ci(c, word), F.lit(label))
    return out.otherwise(c)


def _tree(c: Column, cuts: Sequence[float]) -> Column:
    def node(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(c < F.lit(float(cuts[mid])), node(lo, mid)).otherwise(node(mid + 1, hi))

    return node(0, len(cuts))


def tree_index(c: Column, cuts: Sequence[float]) -> Column:
    """How many cuts are <= c (left-closed buckets 0..len(cuts)), by a balanced tree of
    comparisons; null stays null."""
    return F.when(c.isNotNull(), _tree(c, cuts))


def _even_index(c: Column, start: float, step: float, n: int) -> Column:
    """How many of ``start + k*step`` (k < n) lie below c, by division.

    The division may round across an edge, so both neighbours are compared again.
    """
    x = c.cast("double")
    guess = F.ceil((F.least(F.greatest(x, F.lit(start - step)), F.lit(start + n * step)) - start) / step).cast("int")
    low, high = F.lit(start) + (guess - 1) * step, F.lit(start) + guess * step
    k = guess + F.when(x > high, 1).when(x <= low, -1).otherwise(0)
    return F.least(F.greatest(k, F.lit(0)), F.lit(n))


def _even_step(cuts: Sequence[float]) -> float | None:
    steps = {b - a for a, b in zip(cuts, cuts[1:])}
    return steps.pop() if len(steps) == 1 and len(cuts) > 8 and all(float(e).is_integer() for e in cuts) else None


def just_above(cuts: Sequence[float]) -> list[float]:
    """Cuts moved up by the smallest step, which turns left-closed bins right-closed."""
    return [math.nextafter(e, math.inf) for e in cuts]


def cut(c: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bins ``(edges[i], edges[i+1]]``; outside or null gives null.

    ``c`` is compared several times: pass a plain column rather than a long expression.
    """
    finite, names = bins(edges, labels)
    step = _even_step(finite)
    index = _even_index(c, float(finite[0]), float(step), len(finite)) if step else _tree(c, just_above(finite))
    return F.when(c.isNotNull(), label_at(index, names))


def bins(edges: Sequence[float], labels: Sequence[str]) -> tuple[list[float], list[str | None]]:
    """Finite cuts, and the label of each bucket they make; None outside closed ends."""
    if len(labels) != len(edges) - 1:
        raise ValueError("one label per bin is needed")
    finite = [float(e) for e in edges if not math.isinf(e)]
    names: list[str | None] = list(labels)
    if not math.isinf(edges[0]):
        names = [None, *names]
    if not math.isinf(edges[-1]):
        names = [*names, None]
    return finite, names


def label_at(index: Column, names: Sequence[str | None]) -> Column:
    """The label of a 0-based bucket number; null for a null or unknown bucket."""
    return F.get(F.array(*[F.lit(n).cast("string") for n in names]), index.cast("int"))


def row_max(cols: Sequence[Column]) -> Column:
    """The largest value present; nulls and NaN are skipped."""
    seen = [F.when(~F.isnan(c), c) for c in cols]
    return F.greatest(*seen) if len(seen) > 1 else seen[0]


def row_sum(cols: Sequence[Column]) -> Column:
    """Nulls count as zero, so an all-null row sums to zero."""
    out = F.coalesce(cols[0], F.lit(0))
    for c in cols[1:]:
        out = out + F.coalesce(c, F.lit(0))
    return out


def row_mean(cols: Sequence[Column]) -> Column:
    """Mean of the values present; null when none is."""
    seen = row_sum([F.when(c.isNotNull(), 1) for c in cols])
    return ratio(row_sum(cols), seen)


def row_argmax(named: Mapping[str, Column], top: Column | None = None) -> Column:
    """The name holding the largest value, the earliest name on ties; ``top`` is that
    value when a column already holds it."""
    top = row_max(list(named.values())) if top is None else top
    chain = None
    for name, c in named.items():
        chain = F.when(c == top, F.lit(name)) if chain is None else chain.when(c == top, F.lit(name))
    return chain


def compare_to_history(now: Column, history: Sequence[Column], words=("same", "up", "down")) -> Column:
    """Now against the best of its history; a missing side reads as the last word."""
    best = row_max(history)
    same, more, less = words
    return (
        F.when(truth(now == best), F.lit(same)).when(truth(now > best), F.lit(more)).otherwise(F.lit(less))
    )


def clip(c: Column, lo: float, hi: float) -> Column:
    return F.when(c.isNotNull(), F.least(F.greatest(c.cast("double"), F.lit(float(lo))), F.lit(float(hi))))


def band(c: Column, bounds: Sequence[tuple[float, float | None, str]]) -> Column:
    """Left-closed bands ``[lo, hi)``; null outside all of them."""
    chain = None
    for lo, hi, label in bounds:
        cond = c >= lo if hi is None else (c >= lo) & (c < hi)
        chain = F.when(cond, F.lit(label)) if chain is None else chain.when(cond, F.lit(label))
    return chain
