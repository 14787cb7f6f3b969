"""Connected components of an edge list by alternating large-star and small-star steps.

Both steps only take minima per node and join them back, so no node's neighbours ever meet in one task
beyond what a skewed join can split; each step is written to the shared folder, which cuts the lineage.
Ends when a round leaves the edges as they were: every node then points at the smallest of its component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release, scratch_table


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = scratch_table(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "cc-min")
    out = scratch_table(both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "cc-large")
    release(least)
    return out


def _small_star(edges: DataFrame) -> DataFrame:
    least = scratch_table(edges.groupBy("a").agg(F.min("b").alias("m")), "cc-min")
    moved = edges.join(least, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    out = scratch_table(moved.unionAll(least.select("a", F.col("m").alias("b"))).distinct(), "cc-small")
    release(least)
    return out


def connected_components(edges: DataFrame) -> DataFrame:
    """`edges` has comparable columns a and b. Returns a, b: each node that is not the smallest of its component, and that smallest."""
    now = scratch_table(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc-edges")
    seen = _signature(now)
    while seen[0]:
        large = _large_star(now)
        small = _small_star(large)
        release(now, large)
        now, before, seen = small, seen, _signature(small)
        if seen == before:
            break
    return now
