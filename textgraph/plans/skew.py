"""Skew-safe layout of an edge table for iterative joins.

An iterative graph operator joins per-node values (ranks, distances) with
the edge table on the source id every iteration.  A source holding a large
share of all edges would make that join one enormous task, so sources are
*salted*: a source with ``d`` distinct targets is spread over
``ceil(d / group_edges)`` salt values chosen by a hash of the target, and
its per-node value is replicated once per salt on the (small) node side.
Every (source, salt) group then holds about ``group_edges`` edges at most.

The edge table is laid out once, as buckets by (src, salt) in the shared
folder (:mod:`textgraph.plans.buckets`), so iterations only move the node side,
whatever the session's settings; a layout with a path of its own is found ready
by a later application.  The salt counts of hot sources are broadcast to the
edges only when their number is below ``broadcast_rows`` (checked with a count);
beyond it they are joined with a shuffle in a checkpoint job of its own that is
planned adaptively, so that a hot source's side of the join is split.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textgraph.plans.buckets import Buckets, delete_path, has_spec, open_buckets, shared_path, write_buckets
from textgraph.plans.lineage import materialize

DEFAULT_GROUP_EDGES = 100_000
DEFAULT_BROADCAST_ROWS = 1_000_000     # (bigint, int) rows: ~16 MB at most


@dataclass
class EdgeLayout:
    edges: DataFrame       # (src, salt, dst, *payload), in buckets by (src, salt)
    fanout: DataFrame      # (src, nsalt, *per-source aggregates), one row per source
    partitions: int
    path: str
    keep: bool             # the caller named the path

    def release(self) -> None:
        """Deletes the files, unless the caller named the path."""
        if not self.keep:
            delete_path(self.edges.sparkSession, self.path)


def source_fanout(edges: DataFrame, per_source: dict | None, group_edges: int) -> DataFrame:
    """``(src, nsalt, *per_source)``, one row per source."""
    aggs = [F.count(F.lit(1)).alias("_ndst")] + [c.alias(k) for k, c in (per_source or {}).items()]
    return (edges.groupBy("src").agg(*aggs)
            .withColumn("nsalt", F.greatest(F.lit(1), F.ceil(F.col("_ndst") / F.lit(group_edges))).cast("int"))
            .drop("_ndst"))


def with_salt(edges: DataFrame, fanout: DataFrame, cols: list[str],
              broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """``edges`` (``cols``) plus ``salt``: a hash of the target below the
    source's salt count."""
    hot = fanout.where(F.col("nsalt") > 1).select("src", "nsalt")
    n_hot = hot.count()
    if n_hot == 0:
        # a computed column, not the literal 0: a folded constant would leave
        # the layout partitioned by (src, 0) instead of (src, salt), and every
        # iteration would shuffle the edges again to match the node side
        return edges.select(*cols, F.pmod(F.xxhash64("dst"), F.lit(1)).cast("int").alias("salt"))
    side = F.broadcast(hot) if n_hot <= broadcast_rows else hot
    salted = (edges.select(*cols).join(side, "src", "left")
              .select(*cols, F.pmod(F.xxhash64("dst"), F.coalesce("nsalt", F.lit(1))).cast("int").alias("salt")))
    return salted if n_hot <= broadcast_rows else materialize(salted)


def salted_layout(edges: DataFrame, payload: list[str], per_source: dict | None = None,
                  group_edges: int = DEFAULT_GROUP_EDGES,
                  broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                  partitions: int | None = None, path: str | None = None) -> EdgeLayout:
    """``edges`` must hold one row per (src, dst).

    ``per_source`` maps output names to aggregate columns computed per
    source along with the target count (e.g. the out-degree).
    ``partitions`` defaults to ``spark.sql.shuffle.partitions``.  A ``path`` keeps
    the layout: if it holds one already, that is opened and ``edges`` is not read
    (the caller answers for its being of the same edges).
    """
    spark = edges.sparkSession
    root = path.rstrip("/") if path else shared_path(spark, "edges")
    own = {"payload": payload, "per_source": sorted(per_source or {})}
    if path and has_spec(spark, f"{root}/edges"):
        laid, spec = open_buckets(spark, f"{root}/edges")
        fanout, _ = open_buckets(spark, f"{root}/fanout")
        if {k: spec[k] for k in own} != own:
            raise ValueError(f"{path} holds a layout of another kind: {spec}")
        return EdgeLayout(laid.frame, fanout.frame, spec["partitions"], root, True)
    if partitions is None:
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    edges = edges.persist(StorageLevel.MEMORY_AND_DISK)   # read by both passes below
    try:
        fanout = write_buckets(source_fanout(edges, per_source, group_edges), ["src"], partitions, f"{root}/fanout",
                               own if path else None)
        salted = with_salt(edges, fanout.frame, ["src", "dst", *payload], broadcast_rows)
        laid: Buckets = write_buckets(
            salted.select("src", "salt", "dst", *payload).repartition(partitions, "src", "salt"),
            ["src", "salt"], partitions, f"{root}/edges", own if path else None)
    finally:
        edges.unpersist()
    return EdgeLayout(laid.frame, fanout.frame, partitions, root, bool(path))


def replicate_by_salt(nodes: DataFrame, id_col: str, nsalt_col: str, keep: list[str]) -> DataFrame:
    """One row per (node, salt) for nodes with out-edges: ``(src, salt, *keep)``."""
    return nodes.where(F.col(nsalt_col) > 0).select(
        F.col(id_col).alias("src"),
        F.explode(F.sequence(F.lit(0), F.col(nsalt_col) - 1)).alias("salt"),
        *keep)
