"""Feature catalogue: what kind each column is and which value fills a gap.

A catalogue for a real snapshot has over a thousand names, so it is data and not
code: load it from a table with columns ``feature``, ``kind`` and ``default_value``,
or derive it from a schema.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from stayflow.operators.stats import categorical_columns, numeric_columns

KINDS = ("CAT", "NUM", "DNU", "TARGET")

#: columns of every cohort that are never features; further ones are DNU or TARGET rows of the catalogue
NOT_FEATURES = ("chc_id", "status", "dt")


@dataclass(frozen=True)
class Catalog:
    kinds: Mapping[str, str]
    defaults: Mapping[str, object]

    @classmethod
    def from_table(cls, table: DataFrame) -> "Catalog":
        """``table`` has one row per column name of the snapshot."""
        rows = table.collect()
        return cls({r["feature"]: r["kind"] for r in rows}, {r["feature"]: r["default_value"] for r in rows})

    @classmethod
    def from_schema(
        cls,
        df: DataFrame,
        targets: Sequence[str] = ("status",),
        unused: Sequence[str] = NOT_FEATURES,
        number_default: float = 0.0,
        text_default: str = "UNKNOWN",
    ) -> "Catalog":
        kinds = {c: "NUM" for c in numeric_columns(df)} | {c: "CAT" for c in categorical_columns(df)}
        kinds |= {c: "DNU" for c in kinds if c in unused}
        kinds |= {c: "TARGET" for c in targets if c in df.columns}
        defaults = {c: number_default if c in numeric_columns(df) else text_default for c in kinds}
        return cls(kinds, defaults)

    def of_kind(self, kind: str, within: Sequence[str]) -> list[str]:
        return [c for c in within if self.kinds.get(c) == kind]

    def unused(self, within: Sequence[str]) -> list[str]:
        return [c for c in within if self.kinds.get(c) in ("DNU", "TARGET")]

    def features(self, within: Sequence[str]) -> list[str]:
        return [c for c in within if self.kinds.get(c) in ("CAT", "NUM")]
