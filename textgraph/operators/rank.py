"""PageRank in the reference's two forms, on one Spark-native core.

Formula of one iteration (``alpha`` is the *jump* probability, so the
damping factor is ``1 - alpha``)::

    rank'(v) = (1 - alpha) * (sum over edges u->v of rank(u) * mult(u,v) / outdeg(u)
                              + share(v)) + alpha / n

``share(v)`` is ``dangling_mass / n`` where ``dangling_mass`` is the summed
rank of the present nodes without out-edges.

* **edge-list form** (:func:`pagerank_edges`): the nodes are the ids seen
  in the edges; edges are de-duplicated; start rank ``1/n`` with ``n`` the
  node count; every node gets the share and every node keeps its row.
* **adjacency form** (:func:`pagerank_adjacency`, :func:`pagerank_rows`):
  rows ``(id, out, rank)`` with given start ranks and a given ``n``;
  repeated targets count as often as they occur.  A target without a row
  of its own gets one (rank = its contributions) and is dangling from the
  next iteration on; the dangling share goes to the ids ``1..n`` only, and
  those ids get rows once some present node is dangling.

Plan of one iteration (all DataFrame operators, nothing through the
driver): the node state is stored in buckets by id, the edges are laid out once
in buckets by (src, salt) (:mod:`textgraph.plans.skew`).
Node values are replicated per salt and exchanged to the edge layout, the
per-target sums are a partial + final aggregate, joined back to the state
without moving it.  The dangling mass of a state is observed while that
state is being written (``DataFrame.observe``), so it reaches the next
iteration as a scalar without a job of its own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from textgraph.plans.buckets import Buckets, write_buckets
from textgraph.plans.history import History
from textgraph.plans.skew import (
    DEFAULT_GROUP_EDGES,
    EdgeLayout,
    replicate_by_salt,
    salted_layout,
    source_fanout,
    with_salt,
)

DEFAULT_ALPHA = 0.1


@dataclass
class RankGraph:
    """Prepared inputs of the iteration: laid-out edges, the stored node state
    ``(id, rank, present, in_range, is_target, nsalt, outdeg)`` and the
    dangling mass / count of that state (scalars observed while the state
    was written)."""
    layout: EdgeLayout
    held: Buckets
    n: float
    alpha: float
    mass: float = 0.0
    n_dangling: int = 0

    @property
    def state(self) -> DataFrame:
        return self.held.frame

    def release(self) -> None:
        self.layout.release()


def _edge_multiset(edges: DataFrame, dedupe: bool) -> DataFrame:
    """Ids keep their type (bigint usually, strings accepted); both ends of
    an edge must have the same type."""
    e = edges.select("src", F.col("dst").cast(edges.schema["src"].dataType).alias("dst"))
    if dedupe:
        return e.distinct().withColumn("mult", F.lit(1).cast("bigint"))
    return e.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("mult"))


def prepare(rows: DataFrame | None, edges: DataFrame, n: int | None, alpha: float,
            dedupe: bool, share_to_range: bool,
            group_edges: int = DEFAULT_GROUP_EDGES, edge_partitions: int | None = None,
            layout_path: str | None = None) -> RankGraph:
    """Build the node state and the edge layout.

    ``rows`` is ``(id, rank)`` (adjacency form) or ``None`` (edge-list form:
    all ids present with rank ``1/n``, ``n`` counted).  With
    ``share_to_range`` the dangling share goes to ids ``1..n`` only.
    """
    spark = edges.sparkSession
    em = _edge_multiset(edges, dedupe)
    layout = salted_layout(em, ["mult"], {"outdeg": F.sum("mult")}, group_edges=group_edges,
                           partitions=edge_partitions, path=layout_path)
    fan = layout.fanout

    no_rank = F.lit(None).cast("double")
    parts = [
        fan.select(F.col("src").alias("id"), no_rank.alias("r0"), F.lit(True).alias("row"),
                   F.lit(False).alias("tgt"), "nsalt", "outdeg"),
        layout.edges.select(F.col("dst").alias("id"), no_rank.alias("r0"), F.lit(False).alias("row"),
                  F.lit(True).alias("tgt"), F.lit(0).alias("nsalt"), F.lit(0).cast("bigint").alias("outdeg")),
    ]
    id_type = em.schema["src"].dataType
    if rows is not None:
        parts.append(rows.select(F.col("id").cast(id_type).alias("id"), F.col("rank").cast("double").alias("r0"),
                                 F.lit(True).alias("row"), F.lit(False).alias("tgt"),
                                 F.lit(0).alias("nsalt"), F.lit(0).cast("bigint").alias("outdeg")))
    if share_to_range:
        if n is None:
            raise ValueError("n is required when the share goes to ids 1..n")
        parts.append(spark.range(1, int(n) + 1).select(
            F.col("id").cast(id_type).alias("id"), no_rank.alias("r0"), F.lit(False).alias("row"), F.lit(False).alias("tgt"),
            F.lit(0).alias("nsalt"), F.lit(0).cast("bigint").alias("outdeg")))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    u = u.groupBy("id").agg(F.max("r0").alias("r0"), F.max("row").alias("present"),
                            F.max("tgt").alias("is_target"), F.max("nsalt").alias("nsalt"),
                            F.max("outdeg").alias("outdeg"))
    cached = None
    if rows is None:
        # every id is a node; n is the node count (one scalar)
        u = cached = u.withColumn("present", F.lit(True)).persist(StorageLevel.MEMORY_AND_DISK)
        n = u.count()
        start = F.lit(1.0 / n) if n else F.lit(0.0)    # no edges: no nodes
    else:
        start = F.coalesce(F.col("r0"), F.lit(0.0))
    if share_to_range:
        num = F.col("id").cast("bigint")
        in_range = (num >= 1) & (num <= F.lit(int(n)))
    else:
        in_range = F.lit(True)
    state = u.select("id", F.when(F.col("present"), start).alias("rank"), "present",
                     in_range.alias("in_range"), "is_target", "nsalt", "outdeg")
    held, mass, nd = _store_observed(state)
    if cached is not None:
        cached.unpersist()
    return RankGraph(layout, held, float(n or 1), float(alpha), mass, nd)


def _contributions(g: RankGraph, state: DataFrame) -> DataFrame:
    """``(dst, c)``: summed rank shares arriving at each target."""
    share = replicate_by_salt(state.where(F.col("present")), "id", "nsalt",
                              [(F.col("rank") / F.col("outdeg")).alias("_s")])
    # to as many partitions as the layout has, which a later session may set otherwise
    share = share.repartition(g.layout.partitions, "src", "salt")
    return (share.join(g.layout.edges, ["src", "salt"])
            .groupBy("dst").agg(F.sum(F.col("_s") * F.col("mult")).alias("c")))


def _store_observed(state: DataFrame) -> tuple[Buckets, float, int]:
    """Stores ``state`` in as many buckets by id as the per-target sums have
    partitions, and observes, in the same job, the summed
    rank and the number of its dangling nodes (present, no out-edge)."""
    dangling = F.col("present") & (F.col("nsalt") == 0)
    seen = Observation()
    partitions = int(state.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = write_buckets(state.observe(
        seen,
        F.coalesce(F.sum(F.when(dangling, F.col("rank"))), F.lit(0.0)).alias("mass"),
        F.count(F.when(dangling, F.lit(1))).alias("n_dangling")), ["id"], partitions)
    m = seen.get
    return out, float(m["mass"]), int(m["n_dangling"])


def _dangling(state: DataFrame) -> DataFrame:
    """One row ``(mass, n_dangling)``."""
    d = state.where(F.col("present") & (F.col("nsalt") == 0))
    return d.agg(F.coalesce(F.sum("rank"), F.lit(0.0)).alias("mass"),
                 F.count(F.lit(1)).alias("n_dangling"))


def step(g: RankGraph, state: DataFrame, mass: float, n_dangling: int) -> DataFrame:
    """One iteration from ``state`` whose dangling mass and count are
    given; returns the next state (not yet materialised)."""
    c = _contributions(g, state)
    gets_share = F.col("in_range") & F.lit(n_dangling > 0)
    present = F.col("present") | F.col("is_target") | gets_share
    total = F.coalesce(F.col("c"), F.lit(0.0)) + \
        F.when(gets_share, F.lit(mass) / F.lit(g.n)).otherwise(F.lit(0.0))
    rank = F.when(present, F.lit(1.0 - g.alpha) * total + F.lit(g.alpha / g.n))
    return (state.join(c, state["id"] == c["dst"], "left")
            .select("id", rank.alias("rank"), present.alias("present"), "in_range",
                    "is_target", "nsalt", "outdeg"))


def run(g: RankGraph, iters: int, history: bool = False,
        snapshot_path: str | None = None, resume_from: int = 0) -> DataFrame:
    """Iterate; returns ``(id, rank)`` or, with ``history``, ``(iteration,
    id, rank)`` for iterations 1..iters.  ``snapshot_path`` also writes each
    iteration as parquet in ``iteration=k`` (replacing that folder alone);
    ``resume_from=k`` continues after iteration ``k`` of that path, with the
    result of an uninterrupted run."""
    held, mass, nd = g.held, g.mass, g.n_dangling
    kept = History(g.state.sparkSession, snapshot_path, ["id", "rank"], history)

    def follow(state: DataFrame) -> None:
        nonlocal held, mass, nd
        before = held
        held, mass, nd = _store_observed(state)
        before.delete()

    try:
        if resume_from:
            old = kept.restart(held.frame, resume_from).select(
                F.col("id").alias("_id"), F.col("rank").alias("_rank"))
            follow(held.frame.join(old, F.col("id") == F.col("_id"), "left").select(
                "id", F.col("_rank").alias("rank"), F.col("_id").isNotNull().alias("present"),
                "in_range", "is_target", "nsalt", "outdeg"))
        for i in range(resume_from + 1, iters + 1):
            follow(step(g, held.frame, mass, nd))
            kept.add(i, held.frame.where(F.col("present")))
    finally:
        g.release()     # the states are stored, the edges no longer needed
    state = held.frame
    if history:
        return kept.rows(state, iters)
    return state.where(F.col("present")).select("id", "rank")


# ---------------------------------------------------------------------------
# user-level operators


def pagerank_edges(edges: DataFrame, iters: int, alpha: float = DEFAULT_ALPHA,
                   history: bool = False, group_edges: int = DEFAULT_GROUP_EDGES,
                   snapshot_path: str | None = None, resume_from: int = 0, **layout_opts) -> DataFrame:
    """Edge-list PageRank: ``edges(src, dst)`` -> ``(id, rank)``.
    ``layout_opts``: ``edge_partitions``, ``layout_path`` (keeps the edge layout
    there, for this and later applications)."""
    g = prepare(None, edges, None, alpha, dedupe=True, share_to_range=False,
                group_edges=group_edges, **layout_opts)
    return run(g, iters, history, snapshot_path, resume_from)


def pagerank_rows(rows: DataFrame, edges: DataFrame, n: int, alpha: float,
                  iters: int = 4, dedupe: bool = False, history: bool = False,
                  snapshot_path: str | None = None, resume_from: int = 0,
                  group_edges: int = DEFAULT_GROUP_EDGES, **layout_opts) -> DataFrame:
    """Adjacency-form PageRank on long-form input: ``rows(id, rank)`` and
    the rows' out-edges ``edges(src, dst)`` (repeats count twice unless
    ``dedupe``).  A node is dangling when it has no out-edge."""
    g = prepare(rows, edges, n, alpha, dedupe=dedupe, share_to_range=True,
                group_edges=group_edges, **layout_opts)
    return run(g, iters, history, snapshot_path, resume_from)


def adjacency_edges(nodes: DataFrame) -> DataFrame:
    """``(src, dst)`` of adjacency rows ``(id, out array)``; NULL or empty
    lists give no edge."""
    return nodes.select(F.col("id").alias("src"), F.explode("out").alias("dst"))


def pagerank_adjacency(nodes: DataFrame, n: int, alpha: float, iters: int = 4,
                       history: bool = False, snapshot_path: str | None = None, resume_from: int = 0,
                       group_edges: int = DEFAULT_GROUP_EDGES, **layout_opts) -> DataFrame:
    """Adjacency-form PageRank on ``nodes(id, out array<bigint>, rank)``;
    returns ``(id, out, rank)`` -- the structure is unchanged, rows created
    for targets have ``out`` NULL (with ``history``: ``(iteration, id,
    rank)``)."""
    ranks = pagerank_rows(nodes.select("id", "rank"), adjacency_edges(nodes), n, alpha,
                          iters, history=history, snapshot_path=snapshot_path, resume_from=resume_from,
                          group_edges=group_edges, **layout_opts)
    if history:
        return ranks
    structure = nodes.select("id", "out")
    return ranks.join(structure, "id", "left").select("id", "out", "rank")


def _one_pass(em: DataFrame, ranks: DataFrame, group_edges: int = DEFAULT_GROUP_EDGES) -> DataFrame:
    """``(dst, c)``: the rank shares of ``ranks (id, rank)`` summed per target,
    in one salted join and one aggregate; nothing is cached or laid out."""
    fan = source_fanout(em, {"outdeg": F.sum("mult")}, group_edges)
    share = ranks.join(fan, ranks["id"] == fan["src"]).select(
        "id", "nsalt", (F.col("rank") / F.col("outdeg")).alias("_s"))
    salted = with_salt(em, fan, ["src", "dst", "mult"])
    return (salted.join(replicate_by_salt(share, "id", "nsalt", ["_s"]), ["src", "salt"])
            .groupBy("dst").agg(F.sum(F.col("_s") * F.col("mult")).alias("c")))


def pagerank_scatter(rows: DataFrame, edges: DataFrame, n: int | None = None,
                     dedupe: bool = False) -> DataFrame:
    """Pass 1 of the first adjacency-form iteration: ``(id, rank)`` with the
    summed contributions of every row and target, plus the row ``(-1,
    dangling mass)`` when some row is dangling (the jump is not applied).  Where ``rows`` carry ``out``, so does the result (NULL for rows
    that they lack), so it can be written as adjacency text."""
    em = _edge_multiset(edges, dedupe)
    kind = em.schema["src"].dataType
    carried = [c for c in ("out",) if c in rows.columns]
    rows = rows.select(F.col("id").cast(kind).alias("id"), F.col("rank").cast("double").alias("rank"), *carried)
    c = _one_pass(em, rows.select("id", "rank"))
    sources = em.select("src").distinct()
    mass = rows.join(sources, F.col("id") == F.col("src"), "left_anti").agg(
        F.sum("rank").alias("rank"), F.count(F.lit(1)).alias("_n"))
    virtual = mass.where(F.col("_n") > 0).select(
        F.lit(-1).cast(kind).alias("id"), F.coalesce("rank", F.lit(0.0)).alias("rank"))
    # every row, source and target has a row in the result
    known = (rows.select("id", F.lit(0.0).alias("c")).unionByName(c.select(F.col("dst").alias("id"), "c"))
             .unionByName(sources.select(F.col("src").alias("id"), F.lit(0.0).alias("c"))))
    out = known.groupBy("id").agg(F.sum("c").alias("rank")).unionByName(virtual)
    if carried:
        out = out.join(rows.select("id", *carried), "id", "left").select("id", "out", "rank")
    return out


def rank_contributions(edges: DataFrame, ranks: DataFrame, dedupe: bool = True) -> DataFrame:
    """``(id, contrib)``: for every target, the sum of ``rank(src) *
    mult / outdeg(src)`` over its in-edges (edges de-duplicated unless
    told otherwise)."""
    c = _one_pass(_edge_multiset(edges, dedupe), ranks)
    return c.select(F.col("dst").alias("id"), F.col("c").alias("contrib"))


def dangling_mass(ranks: DataFrame, edges: DataFrame) -> DataFrame:
    """One row ``(mass)``: summed rank of the nodes without out-edges."""
    srcs = edges.select(F.col("src").alias("id")).distinct()
    return (ranks.join(srcs, "id", "left_anti")
            .agg(F.coalesce(F.sum("rank"), F.lit(0.0)).alias("mass")))
