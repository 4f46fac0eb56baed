"""Connected components of links, distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import store


def _state(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges."""
    return tuple(edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))"), F.expr("sum(xxhash64(v, u) % 1000003)")).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of ``links`` (u, v): the smallest node reachable.

    Alternates two steps that keep components: every node's larger neighbours move to its smallest neighbour, then
    every node and its smaller neighbours move to the smallest of them. Each is one pre-aggregated minimum and one
    join whose large side adaptive execution can split, so a node with very many links is not one task. Edges never
    grow in number beyond the nodes and links given; no step brings them to the driver.
    """
    edges = store(links.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
        edges = store(small.select("e.u", F.col("e.m").alias("v")).filter("u != v").distinct(), "links")
        state, before = _state(edges), state
        if state == before:
            break
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
