"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import sort_joined, stored


def _star(edges: DataFrame, keep_larger: bool) -> DataFrame:
    """Link neighbours of each node to the smallest of them.

    Minima are pre-aggregated, and the neighbours of a hub are joined to its one minimum, so
    that a node with very many edges is split like any other skewed join.
    """
    lowest = edges.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low")).withColumnRenamed("a", "_a")
    linked = edges.join(sort_joined(lowest), F.col("a") == F.col("_a"))
    if keep_larger:
        pairs = linked.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        pairs = linked.select(F.col("b").alias("a"), F.col("low").alias("b")).union(
            lowest.select(F.col("_a").alias("a"), F.col("low").alias("b"))
        )
    return pairs.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest id reachable from each node that has an edge.

    ``edges`` has two id columns; direction, loops and repeated rows do not matter, rows with
    a null are left out. Nodes without an edge are not returned. Nothing but one count and
    one checksum a round reaches the driver; rounds grow with the logarithm of the longest path.
    """
    a, b = edges.columns
    pairs = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
    pairs = pairs.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))).distinct()
    pairs = stored(pairs, "edges")
    seen = None
    for _ in range(most_rounds):
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        pairs = stored(_star(_star(both, keep_larger=True), keep_larger=False), "edges")
        mark = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        seen = mark
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
