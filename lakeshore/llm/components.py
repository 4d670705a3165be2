"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def connected_components(edges: DataFrame, name: str) -> DataFrame:
    """``id, component`` (the smallest id of the component) for the ends of ``edges`` (a, b).

    A large-star step links every greater neighbour of a node to the smallest of its
    neighbourhood, a small-star step every smaller one; both keep the components and a few
    rounds leave stars. The minima are partial aggregates and the joins back are on the nodes,
    so a hub's edges are spread. Each round is written to the shared folder.
    """
    now = materialize(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                      .distinct(), f"{name}_edges")
    mark = _mark(now)
    turn = 0
    while mark[0]:
        turn += 1
        both = now.union(now.select("v", "u"))  # (node, neighbour)
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(large.filter("u <> v"), f"{name}_large{turn}")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").filter("u <> v").distinct())
        now = materialize(small, f"{name}_small{turn}")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("id"), F.col("v").alias("component"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
