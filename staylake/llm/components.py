"""Connected components by alternating large-star and small-star steps.

Every step is a minimum per node (combined before the shuffle) and a join of
edges with those minima; minima and edges are written tables in the shared
folder, so a plan never grows and a lost executor costs one step.  The edge
count never exceeds that of the input, whatever the shape of a component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylake.llm.common import stored


def _minima(pairs: DataFrame) -> DataFrame:
    """Per node u the smallest of u and its neighbours v."""
    return stored(pairs.groupBy("u").agg(F.min("v").alias("m"))
                  .select("u", F.least("u", "m").alias("m")), "component-minima")


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % (1 << 31))).first()
    return tuple(row)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of an edge (a, b of one type).

    The component is the smallest node reachable.  Null ends, self-links and
    repeated links change nothing; an empty input gives an empty result.
    """
    stars = stored(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("a is not null and b is not null and u <> v").distinct(), "component-edges")
    mark = _mark(stars)
    while mark[0]:
        both = stars.select("u", "v").union(stars.select(F.col("v").alias("u"),
                                                         F.col("u").alias("v")))
        # large star: every larger neighbour of u gets u's smallest
        large = stored(both.join(_minima(both), "u").where("v > u")
                       .select(F.col("v").alias("u"), F.col("m").alias("v"))
                       .distinct(), "component-edges")
        # small star: u and its smaller neighbours get the smallest of them
        smallest = _minima(large)
        stars = stored(large.join(smallest, "u").where("v <> m")
                       .select(F.col("v").alias("u"), F.col("m").alias("v"))
                       .union(smallest.select("u", F.col("m").alias("v")))
                       .distinct(), "component-edges")
        before, mark = mark, _mark(stars)
        if before == mark:
            break
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
