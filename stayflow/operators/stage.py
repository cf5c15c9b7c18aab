"""What a fit leaves behind: named expressions over the input columns, and plain state.

Stages are combined before anything runs: a union of fitted stages is one ``select``,
so a dozen transforms of a table still read it once. A stage made by :func:`build` knows
how it was made, so it can be saved as plain text and rebuilt without its training table.
"""
from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession


@dataclass(frozen=True)
class Fitted:
    outputs: Mapping[str, Column]
    state: Mapping[str, object] = field(default_factory=dict)
    helpers: Mapping[str, Column] = field(default_factory=dict)  # computed once, used by several outputs
    buckets: Mapping[str, tuple[str, Sequence[float]]] = field(default_factory=dict)  # name -> (column, cuts)
    recipe: tuple[Mapping[str, object], ...] = ()  # kind, arguments and affixes of each part

    def apply(self, df: DataFrame, keep: Sequence[str | Column] = ()) -> DataFrame:
        ready = df.withColumns(dict(self.helpers)) if self.helpers else df
        if self.buckets:
            ready = bucket_columns(ready, self.buckets)
        return ready.select(*keep, *[c.alias(n) for n, c in self.outputs.items()])

    def renamed(self, prefix: str | None = None, suffix: str | None = None) -> "Fitted":
        named = tuple({**r, "affixes": [*r["affixes"], [prefix, suffix]]} for r in self.recipe)
        return Fitted({affix(n, prefix, suffix): c for n, c in self.outputs.items()}, self.state, self.helpers, self.buckets, named)

    def only(self, names: Sequence[str]) -> "Fitted":
        return Fitted({n: self.outputs[n] for n in names}, self.state, self.helpers, self.buckets, self.recipe)

    def save(self, spark: SparkSession, path: str) -> None:
        """The recipe and the chosen outputs as a small table; only stages made by :func:`build` can be saved."""
        if not self.recipe:
            raise ValueError("a stage of plain expressions has nothing to save")
        save_state(spark, {"outputs": list(self.outputs), "recipe": list(self.recipe)}, path)


#: what rebuilds a stage from its saved arguments, by kind
BUILDERS: dict[str, Callable[..., "Fitted"]] = {}


def builder(kind: str):
    def register(f: Callable[..., Fitted]):
        BUILDERS[kind] = f
        return f

    return register


def build(kind: str, **args) -> Fitted:
    """A stage of a registered kind that remembers its kind and arguments."""
    made = BUILDERS[kind](**args)
    return replace(made, recipe=({"kind": kind, "args": args, "affixes": []},))


def load_fitted(spark: SparkSession, path: str) -> Fitted:
    """A saved stage, rebuilt without the data it was fitted on."""
    kept = load_state(spark, path)
    parts = []
    for r in kept["recipe"]:
        part = build(r["kind"], **r["args"])
        for prefix, suffix in r["affixes"]:
            part = part.renamed(prefix, suffix)
        parts.append(part)
    return union(*parts).only(kept["outputs"])


def bucket_columns(df: DataFrame, buckets: Mapping[str, tuple[str, Sequence[float]]]) -> DataFrame:
    """Adds bucket numbers (left-closed, null stays null) for many columns at once.

    Spark's bucketizer searches the cuts in one call per column. As comparison chains,
    a dozen bin columns make a generated method too long for the JVM to compile.
    """
    inf = float("inf")
    return Bucketizer(
        inputCols=[c for c, _ in buckets.values()],
        outputCols=list(buckets),
        splitsArray=[[-inf, *cuts, inf] for _, cuts in buckets.values()],
        handleInvalid="keep",
    ).transform(df)


def affix(name: str, prefix: str | None = None, suffix: str | None = None) -> str:
    return "_".join(p for p in (prefix, name, suffix) if p is not None)


def union(*fitted: Fitted) -> Fitted:
    outputs: dict[str, Column] = {}
    state: dict[str, object] = {}
    helpers: dict[str, Column] = {}
    buckets: dict[str, tuple[str, Sequence[float]]] = {}
    for f in fitted:
        clash = outputs.keys() & f.outputs.keys()
        if clash:
            raise ValueError(f"two stages produce {sorted(clash)}")
        outputs.update(f.outputs)
        state.update(f.state)
        helpers.update(f.helpers)
        buckets.update(f.buckets)
    return Fitted(outputs, state, helpers, buckets, tuple(r for f in fitted for r in f.recipe))


def save_state(spark: SparkSession, state: Mapping[str, object], path: str) -> None:
    """Fitted metadata as a small Parquet table of (name, json)."""
    rows = [(k, json.dumps(v)) for k, v in state.items()]
    spark.createDataFrame(rows, "name string, value string").coalesce(1).write.mode("overwrite").parquet(path)


def load_state(spark: SparkSession, path: str) -> dict[str, object]:
    return {r["name"]: json.loads(r["value"]) for r in spark.read.parquet(path).collect()}
