"""Connected components of links between whole-number nodes, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """(node, component) for every node with a link; a component's name is its smallest node.

    Each round points nodes to smaller ones: first all larger neighbours of a node, then a node and its
    smaller neighbours, to the smallest. The work of a round is one grouping and one join, both on a
    node, where adaptive execution splits nodes with very many links; nothing comes to the driver.
    """
    edges = links.select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).where("u > v").distinct()
    edges = materialize(edges, "edges")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        large = both.join(least, both.u == least.w).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "w")
        joined = large.join(least, large.u == least.w)
        small = joined.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select(F.col("w").alias("u"), F.col("m").alias("v"))
        )
        edges = materialize(small.distinct(), "edges")
        before, state = state, _state(edges)
        if state == before:
            break
    # Stars now: every node points to its component's smallest.
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
