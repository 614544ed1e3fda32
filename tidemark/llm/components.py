"""Connected components by alternating star contractions.

Works on edges only: each round joins the edges with the least neighbour of
their ends, and is written to the shared scratch folder, so that lineage stays
short and no node, component or edge set ever reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import staged


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root``, its component's least node, for all nodes that are not roots.

    Edges may repeat, point either way, or loop.
    """
    edges = _distinct(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")))
    edges = staged(edges, "components")
    before = None
    while (now := _digest(edges)) != before:
        before = now
        edges = staged(_small_star(_large_star(edges)), "components")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _distinct(edges: DataFrame) -> DataFrame:
    return edges.where("u <> v").distinct()


def _digest(edges: DataFrame):
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    return row[0], row[1]


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's least neighbour."""
    both = edges.union(edges.select("v", "u"))
    least = staged(
        both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "components-least"
    )
    return _distinct(
        both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the least of them."""
    edges = staged(edges, "components-large")
    least = staged(edges.groupBy("u").agg(F.min("v").alias("m")), "components-least")
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _distinct(moved.union(least.select("u", F.col("m").alias("v"))))
