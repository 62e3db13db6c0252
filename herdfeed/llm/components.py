"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step on edges ``(u, v)`` with ``v < u``; hot nodes are combined before shuffles."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    near = both.join(least, "u")
    if large:
        out = near.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = near.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return out.filter("u != v").distinct()


def connected_components(links: DataFrame, label: str = "components") -> DataFrame:
    """``(node, root)`` for every node of the links ``(a, b)``: ``root`` is the smallest node
    that links reach. NULL ends and self-links are ignored; repeated links count once; an
    empty table gives none. Only two numbers a round come to the driver."""
    edges = written(links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), label)
    state = _state(edges)
    while state[0]:
        edges = written(_star(_star(edges, True), False), label)
        if (new := _state(edges)) == state:
            break
        state = new
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
