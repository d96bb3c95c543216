"""Connected components of a graph given by links, on Spark.

Alternating large-star and small-star steps: each replaces links by links
to the smallest neighbour until every component is a star around its
smallest node.  Steps only group and join the link table, each one is
checkpointed, and the driver sees nothing but a count and a checksum.  The
joins are inner sort-merge joins with one row per node on one side, so
adaptive execution splits a node with very many links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textgraph.llm.common import durable


def _state(links: DataFrame) -> tuple:
    r = links.agg(F.count(F.lit(1)).alias("n"),
                  F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return r.n, r.s


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Large star: every larger neighbour of a node links to the smallest of
    the node and its neighbours.  Small star: so do the smaller ones."""
    if large:
        seen = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        seen = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = seen.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    met = seen.join(least, "a")
    if large:
        out = met.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = met.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))
    return out.where(F.col("a") != F.col("b")).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """``links`` (a, b), any direction, repeats allowed; returns (node,
    component), the smallest reachable node, for nodes that have a link."""
    now = durable(links.where(F.col("a") != F.col("b"))
                  .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = _state(now)
    while state[0]:
        now = durable(_star(_star(now, large=True), large=False))
        before, state = state, _state(now)
        if state == before:
            break
    return (now.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()))
