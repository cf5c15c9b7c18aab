"""Arithmetic on ``yyyymm`` integers."""
from __future__ import annotations

from pyspark.sql import Column, functions as F


def add_months_int(ym: int, k: int) -> int:
    """Driver-side month shift, used to fill in query parameters."""
    index = ym // 100 * 12 + ym % 100 - 1 + k
    return index // 12 * 100 + index % 12 + 1


def next_months(ym: int, n: int = 6) -> list[int]:
    return [add_months_int(ym, k) for k in range(1, n + 1)]


def shift_month(ym: Column, k: int | Column) -> Column:
    """Column form of the same shift; December rolls over."""
    index = F.floor(ym / 100) * 12 + ym % 100 - 1 + (F.lit(k) if isinstance(k, int) else k)
    return (F.floor(index / 12) * 100 + index % 12 + 1).cast("int")


def month_label(ym: Column) -> Column:
    """201803 -> ``mar18``."""
    return F.lower(F.date_format(F.to_date(ym.cast("string"), "yyyyMM"), "MMMyy"))


def label_month(label: Column) -> Column:
    """``mar18`` -> 201803; two-digit years from 69 on belong to the last century."""
    year = F.substring(label, 4, 2).cast("int")
    century = F.when(year >= 69, F.lit("19")).otherwise(F.lit("20"))
    text = F.concat(F.initcap(F.substring(label, 1, 3)), century, F.substring(label, 4, 2))
    return F.date_format(F.to_date(text, "MMMyyyy"), "yyyyMM").cast("int")
