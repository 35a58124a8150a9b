"""Connected components of a graph as tables, by alternating large-star and small-star steps.

Kiveris et al., "Connected Components in MapReduce and Beyond" (2014). A node's neighbours are never gathered: each step
takes a minimum for each node, with map-side combine, and joins it back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import NO_HOT, SALT_ROWS, hot_keys, salted_join, written


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for each node of undirected edges (a, b): the component is its smallest node."""
    both = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    held = written(both, name)
    state = _state(held)
    while True:
        # Large star: each larger neighbour of a node goes to the least of the node and its neighbours.
        twice = held.select(F.col("a").alias("u"), F.col("b").alias("v")).union(held.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = twice.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count(F.lit(1)).alias("n"))
        hot = hot_keys(least, ["u"], "n") if state[0] > SALT_ROWS else NO_HOT  # no key has more rows than there are
        large = salted_join(twice.where("v > u"), least.drop("n"), ["u"], F.col("v"), hot).select(F.col("v").alias("a"), F.col("m").alias("b"))
        # Small star: a node and its smaller neighbours go to the least of them.
        large = written(large.where("a != b").distinct(), f"{name}-large")
        lower = large.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n"))
        hot = hot_keys(lower, ["a"], "n") if state[0] > SALT_ROWS else NO_HOT
        lower = lower.drop("n")
        small = salted_join(large, lower, ["a"], F.col("b"), hot).select(F.col("b").alias("a"), F.col("m").alias("b")).union(lower.select("a", F.col("m").alias("b")))
        held = written(small.where("a != b").distinct(), name, last=[held, large])
        new = _state(held)
        if new == state:
            break
        state = new
    return held.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")).union(
        held.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
