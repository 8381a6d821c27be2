"""Connected components of a graph that no single task can hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.settings import settle


def _with_least(edges: DataFrame, least: Column) -> DataFrame:
    """Each edge (u, v) with ``m``, the least value at its node u.

    The least values are written before they are joined: then both sides of the
    join are dealt out by it alone, and a node with very many edges can be split.
    """
    return edges.join(settle(edges.groupBy("u").agg(least.alias("m")), "least"), "u")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node goes to the least of node and neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    led = _with_least(both, F.least(F.min("v"), F.col("u")))
    return led.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours go to the least of those."""
    led = _with_least(edges, F.min("v"))
    return (
        led.select("u", F.col("m").alias("v"))
        .unionByName(led.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        .distinct()
    )


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``(node, component)`` of every node that has an edge: the least node it can reach.

    ``edges`` has two columns of one ordered type.  Large and small stars take turns
    until nothing moves; each round is written to the shared folder.
    """
    a, b = edges.columns
    edges = (
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    edges = settle(edges, "edges")
    before = None
    for _ in range(max_rounds):
        now = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if now == before:
            break
        before = now
        edges = settle(_small_star(settle(_large_star(edges).distinct(), "edges")), "edges")
    else:
        raise RuntimeError(f"components still moved after {max_rounds} rounds")
    return (
        edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")))
        .distinct()
    )
