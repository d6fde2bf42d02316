"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import observed, release


def _written(edges: DataFrame) -> tuple[DataFrame, dict]:
    return observed(edges, digest=F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")))


def connected_components(pairs: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``pairs(a, b)``; the root is the smallest node of the component.

    Every round hangs nodes below the smallest neighbour they know of, until each component is a star. All state is
    two-column tables in the shared checkpoint folder; nothing about nodes or links comes to the driver but a count and
    a hash sum, by which a round without change is noticed; they are taken while the links are written. No other job is run.
    """
    edges, before = _written(pairs.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct())
    while before["n"]:
        ends = F.array(F.struct(F.col("hi").alias("x"), F.col("lo").alias("y")), F.struct(F.col("lo").alias("x"), F.col("hi").alias("y")))
        both = edges.select(F.explode(ends).alias("e")).select("e.x", "e.y")
        least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.join(least, "x").where("y > x").select(F.col("y").alias("hi"), F.col("m").alias("lo")).distinct()
        smallest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(smallest, "hi").select(
            F.when(F.col("lo") == F.col("m"), F.col("hi")).otherwise(F.col("lo")).alias("hi"), F.col("m").alias("lo")
        )
        last, (edges, after) = edges, _written(small.where("hi <> lo").distinct())
        release(last)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(roots)
