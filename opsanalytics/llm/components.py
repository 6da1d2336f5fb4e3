"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsanalytics.llm.store import saved


def _oriented(edges: DataFrame) -> DataFrame:
    return edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct()


def _state(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v); a component is named by its least node.

    Neighbour lists are never gathered: a step joins edges with each node's least
    neighbour, so a hub's edges can be split, and every step starts from a stored table."""
    edges = saved(_oriented(edges), "edges")
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = saved(both.groupBy("u").agg(F.min("v").alias("m")), "least")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        large = saved(_oriented(large), "large")
        least = saved(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").select(F.explode(F.array(
            F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        edges = saved(_oriented(small), "edges")
        before, state = state, _state(edges)
        if before == state:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
