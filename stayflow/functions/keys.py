"""Composite customer key: corp (4) + house (6, zero padded) + cust (2).

A part that is longer than its place is an error: cut, two customers would become one.
Where numbers may outgrow their places, ``grow`` keeps all their digits instead.
"""
from __future__ import annotations

from pyspark.sql import Column, functions as F


def strip_zeros(c: Column) -> Column:
    """Leading zeros removed; a key part of zeros only reads as ``'0'``."""
    return F.coalesce(F.nullif(F.regexp_replace(c, "^0+", ""), F.lit("")), F.lit("0"))


def split_key(key: Column) -> dict[str, Column]:
    return {
        "corp": F.substring(key, 1, 4),
        "house": strip_zeros(F.substring(key, 5, 6)),
        "cust": strip_zeros(F.substring(key, 11, 1000)),
    }


def padded(part: Column, size: int, grow: bool = False) -> Column:
    text = part.cast("string")
    if grow:
        return F.when(F.length(text) >= size, text).otherwise(F.lpad(text, size, "0"))
    too_long = F.raise_error(F.concat(F.lit(f"key part longer than {size}: "), text)).cast("string")
    return F.when(F.length(text) > size, too_long).otherwise(F.lpad(text, size, "0"))


def build_key(corp: Column, house: Column, cust: Column, grow: bool = False) -> Column:
    return F.concat(corp.cast("string"), padded(house, 6, grow), padded(cust, 2, grow))
