"""Edge-table building blocks: de-duplication, degrees, node sets.

All are joins, set operations and aggregates on ``edges(src, dst)``;
only scalars (the node count) reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_edges(edges: DataFrame) -> DataFrame:
    """``(src, dst)`` without repeats."""
    return edges.select("src", "dst").distinct()


def out_degree(edges: DataFrame, id_col: str = "id", n: str = "out_degree") -> DataFrame:
    """``(id, out_degree)``: out-edges per source (as given; de-duplicate
    first for the edge-list form)."""
    return edges.groupBy(F.col("src").alias(id_col)).agg(F.count(F.lit(1)).alias(n))


def node_ids(edges: DataFrame) -> DataFrame:
    """``(id)``: every id that occurs as source or target."""
    return edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()


def node_count(edges: DataFrame, n: str = "n") -> DataFrame:
    """One row ``(n)``: number of distinct ids among sources and targets."""
    return node_ids(edges).agg(F.count(F.lit(1)).alias(n))


def dangling_nodes(edges: DataFrame) -> DataFrame:
    """``(id)``: targets that are never a source (targets minus sources)."""
    return (edges.select(F.col("dst").alias("id")).distinct()
            .join(edges.select(F.col("src").alias("id")).distinct(), "id", "left_anti"))


def implicit_nodes(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """``(id)``: targets named by an edge that have no row of their own."""
    return (edges.select(F.col("dst").alias("id")).distinct()
            .join(rows.select("id"), "id", "left_anti"))


def rank_init(edges: DataFrame) -> DataFrame:
    """``(id, rank)``: every node of the edge list with rank ``1/n`` (the
    node count is one scalar)."""
    ids = node_ids(edges)
    n = ids.count()
    return ids.select("id", (F.lit(1.0) / F.lit(n)).alias("rank"))
