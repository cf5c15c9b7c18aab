"""Connected components of links between integer nodes, in rounds of joins.

Each round replaces the links of every node by links to its smallest neighbour: first
from the larger neighbours (large star), then from the smaller ones (small star). Once
every node has at most one smaller neighbour the links are trees, and a round is one join
that replaces each node's parent by the parent's parent, until only stars around the
smallest node of each component are left. The number of rounds grows with the logarithm
of the component's size. A hub's minimum is found by a map-side combined aggregate, and
its links are joined to that minimum, a join whose large partitions Spark splits; no
node's links are gathered in one place.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stayflow.session import materialize


def _shape(links: DataFrame) -> tuple[bool, bool]:
    """Whether a node has several smaller neighbours, and whether a smaller neighbour has one itself."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        links.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    several, deep = nodes.agg(F.max(F.col("up") > 1), F.max((F.col("up") > 0) & (F.col("down") > 0))).first()
    return bool(several), bool(deep)


def _large_star(links: DataFrame) -> DataFrame:
    """A row for each link; links may repeat."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    joined = both.join(least, both.a == least.u)
    return joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
    joined = links.join(least, links.a == least.u)
    # the link to the minimum itself stays, the others move from the node to the neighbour
    return joined.select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")).distinct()


def _shorten(trees: DataFrame) -> DataFrame:
    """Every node linked to its parent's parent, if there is one."""
    above = trees.select(F.col("a").alias("u"), F.col("b").alias("m"))
    return trees.join(above, trees.b == above.u, "left").select("a", F.coalesce("m", "b").alias("b"))


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (a, b) but the roots; root is the smallest node it can reach."""
    now = materialize(links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "star")
    several, deep = _shape(now)
    while several or deep:
        now = materialize(_small_star(_large_star(now)) if several else _shorten(now), "star")
        several, deep = _shape(now)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
