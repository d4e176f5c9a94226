"""Connected components by alternating large-star and small-star steps, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicmart.session import materialise


def _attach(edges: DataFrame, node: str, other: str) -> DataFrame:
    """``edges`` with ``root``, the least of each node and its neighbours. The minima are summed
    up before the shuffle and written, so that the join can split a node with very many edges."""
    least = edges.groupBy(F.col(node).alias("of")).agg(F.min(other).alias("least"))
    least = materialise(least.select("of", F.least("of", "least").alias("root")), "star")
    return edges.join(least, edges[node] == least["of"])


def _are_stars(pairs: DataFrame) -> bool:
    """Whether every node either has one edge to a lesser node or only edges from greater ones."""
    ends = pairs.select(F.col("hi").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionByName(pairs.select(F.col("lo").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    roles = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return roles.filter("up > 1 or up = 1 and down = 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b), component the least node reached.

    Loops and repeated edges do no harm; rows with a null end are ignored. Every round is
    written to the shared scratch folder, so lineage stays short and a lost executor costs one
    round. Only whether to go on reaches the driver.
    """
    pairs = edges.filter("a is not null and b is not null and a != b")
    pairs = pairs.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
    pairs = materialise(pairs.distinct(), "edges")
    while not _are_stars(pairs):
        both = pairs.unionByName(pairs.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        large = _attach(both, "hi", "lo").filter("lo > hi").select(F.col("lo").alias("hi"), F.col("root").alias("lo"))
        large = materialise(large.distinct(), "large-star")
        small = _attach(large, "hi", "lo")
        moved = small.filter("lo != root").select(F.col("lo").alias("hi"), F.col("root").alias("lo"))
        small = small.select("hi", F.col("root").alias("lo")).unionByName(moved)
        pairs = materialise(small.distinct(), "small-star")
    stars = pairs.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    roots = pairs.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return stars.unionByName(roots)
