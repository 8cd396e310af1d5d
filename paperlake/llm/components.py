"""Connected components of a graph whose edges are rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperlake.session import materialize


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component``: the smallest node reachable from each node that has an edge.

    Each round points every node at the smallest of its neighbours and itself and
    replaces edges by those between what their ends point at. Pointers only go
    down, so the smallest node of a component never moves and is what remains of
    it. The number of rounds is about the logarithm of the longest path; rounds
    are written to the shared folder, and nothing is collected. Edges with a null
    end and loops are left out.
    """
    spark = edges.sparkSession
    left = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b")
    left = materialize(left.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    pointers: list[DataFrame] = []
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
        point = materialize(lowest.select("node", F.least("node", "low").alias("to")), "pointers")
        pointers.append(point)
        ends = left.join(point.toDF("a", "x"), "a").join(point.toDF("b", "y"), "b").filter("x <> y")
        left = materialize(ends.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
    if not pointers:
        kind = edges.schema[a].dataType
        return spark.createDataFrame([], f"node {kind.simpleString()}, component {kind.simpleString()}")

    def follow(found: DataFrame, point: DataFrame) -> DataFrame:
        moved = found.join(point.toDF("component", "to"), "component", "left")
        return moved.select("node", F.coalesce("to", "component").alias("component"))

    return reduce(follow, pointers[1:], pointers[0].toDF("node", "component"))
