"""Adapters from the driver's parquet tables to the operators' inputs.

Text: ``documents(doc_id, text)`` -- a document is the unit (the analogue
of a file); its text may hold many lines.

Graph: a directed graph on the dense ids ``1..n``, ``n = |part| +
|supplier| + |nation|``; part ``k`` is node ``k + 1``, supplier ``k`` is
node ``|part| + k + 1`` and nation ``k`` is node ``|part| + |supplier| + k +
1``.  Every ``lineitem`` row is an edge: supplier -> part with return flag
``A``, part -> supplier with any other.  Every ``supplier`` row is an edge
to its nation (weight 1).  Nations have no out-edges, so they are dangling;
rows of their own exist for parts and suppliers only, so nations are also
the targets without a row.  Edge rows repeat when a pair occurs in several
line items; the weighted form keeps one row per pair with the smallest
whole quantity as its weight.

Only the needed columns are selected, so the parquet scans are pruned to
them; ``lineitem`` is scanned once per edge frame and no row is left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textgraph.plans.partitioning import spread_coarse


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id bigint, text string)``, spread over the cores when the
    scan is coarser than them."""
    return spread_coarse(table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"])


def part_total(spark: SparkSession, sf_dir: str) -> int:
    """``|part|``: the id offset of supplier nodes (a scalar)."""
    return table(spark, sf_dir, "part").count()


def row_total(spark: SparkSession, sf_dir: str) -> int:
    """``|part| + |supplier|``: the id offset of nation nodes (a scalar)."""
    return part_total(spark, sf_dir) + table(spark, sf_dir, "supplier").count()


def node_total(spark: SparkSession, sf_dir: str) -> int:
    """``n = |part| + |supplier| + |nation|`` (a scalar: three row counts)."""
    return row_total(spark, sf_dir) + table(spark, sf_dir, "nation").count()


def _edge_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", "l_quantity", "l_returnflag")
    supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    parts, rows = part_total(spark, sf_dir), row_total(spark, sf_dir)
    back = F.col("l_returnflag") == "A"
    part_node = F.col("l_partkey") + F.lit(1)
    supp_node = F.lit(parts) + F.col("l_suppkey") + F.lit(1)
    items = li.select(F.when(back, supp_node).otherwise(part_node).alias("src"),
                      F.when(back, part_node).otherwise(supp_node).alias("dst"), "l_quantity")
    homes = supp.select((F.lit(parts) + F.col("s_suppkey") + F.lit(1)).alias("src"),
                        (F.lit(rows) + F.col("s_nationkey") + F.lit(1)).cast("bigint").alias("dst"),
                        F.lit(1.0).alias("l_quantity"))
    return items.unionByName(homes)


def edge_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(src, dst)`` bigint, one row per line item and supplier (pairs repeat)."""
    return _edge_rows(spark, sf_dir).select("src", "dst")


def weighted_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(src, dst, w)``: one row per pair, ``w`` the smallest whole
    quantity of its rows."""
    return (_edge_rows(spark, sf_dir).groupBy("src", "dst")
            .agg(F.min(F.col("l_quantity").cast("int")).cast("bigint").alias("w")))


def quantity_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(src, dst, least, most)``: one row per pair with its smallest and
    largest whole quantity."""
    whole = F.col("l_quantity").cast("int")
    return (_edge_rows(spark, sf_dir).groupBy("src", "dst")
            .agg(F.min(whole).cast("bigint").alias("least"), F.max(whole).cast("bigint").alias("most")))


def node_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id)``: the nodes with a row of their own, parts and suppliers."""
    off = part_total(spark, sf_dir)
    parts = table(spark, sf_dir, "part").select((F.col("p_partkey") + 1).alias("id"))
    supps = table(spark, sf_dir, "supplier").select((F.lit(off) + F.col("s_suppkey") + 1).alias("id"))
    return parts.unionByName(supps)
