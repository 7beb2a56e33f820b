"""Connected components of a table of links, by alternating star contractions.

Every round halves the distance of nodes to the smallest node of their
component, so the number of rounds grows with the logarithm of the size. Each
result is written to the shared checkpoint folder; a node with very many links
is split by Spark's skew join, as both sides of a join come from tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazette.llm.common import drop_scratch, scratch


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (a, b); component: its smallest node.

    Links with a null end and links of a node to itself are ignored. Nodes
    without links are not returned: they are components of their own.
    """
    edges = scratch(
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    before = _state(edges)
    while before.n:
        both = edges.union(edges.select("b", "a"))
        nearest = scratch(both.groupBy("a").agg(F.min("b").alias("m"))).select(
            F.col("a").alias("b"), F.least("a", "m").alias("m")
        )
        large = scratch(edges.join(nearest, "b").select("a", F.col("m").alias("b")).distinct())
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(lowest, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = scratch(moved.union(lowest.select("a", F.col("m").alias("b"))).distinct())
        now = _state(after)
        for old in (edges, nearest, large):
            drop_scratch(old)
        edges = after
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select("b", "b").distinct()
    )


def _state(edges: DataFrame):
    return edges.agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")
    ).first()


def name_components(prints: DataFrame, classes: DataFrame, key: list[str], links: DataFrame) -> DataFrame:
    """``prints`` with the components that ``links`` make of ``classes`` (key, id, least).

    ``component`` is the id of a class, ``component_id`` the least of all in reach.
    """
    found = components(links)
    grouped = scratch(
        classes.join(found, classes["id"] == found["node"], "left").select(
            *key, "least", F.coalesce("component", "id").alias("component")
        )
    )
    smallest = scratch(grouped.groupBy("component").agg(F.min("least").alias("component_id")))
    named = scratch(grouped.drop("least").join(smallest, "component"))
    return prints.join(named, key)
