"""Level-synchronous frontier search with weighted distances.

State per node: ``dist`` (NULL = unreached) and ``color`` (0 WHITE, 1 GRAY,
2 BLACK).  One iteration: every GRAY node offers ``dist + w`` to each of
its targets (which arrive GRAY) and turns BLACK; per node the smallest
distance and the darkest colour win.

This is the reference's operator, *not* a shortest-path algorithm: a BLACK
node whose distance improves later is never expanded again, so weighted
results can exceed the true shortest distance.  With all weights 1 it is
plain breadth-first search (hop counts), see :func:`bfs_hops`.

Delta iteration: the node states are a *base*, stored once in buckets by id,
and the *changes* since, one small table per iteration.  An iteration joins
the frontier (the GRAY rows among the last changes), replicated per salt, with
the edge layout (:mod:`textgraph.plans.skew`), reduces the offers per target
by a partial + final ``min``, looks up the old states of the touched nodes only, and
appends the rows that changed -- so what is written follows the frontier, not
the graph.  As distances only fall and colours only darken, the versions of a
node merge by ``min`` and ``max`` in any order.  A lookup of few nodes filters the
base by their ids, which reads only their buckets; other lookups join the base by
its buckets, without exchanging it.  Every ``COMPACT_ROUNDS`` iterations, or when
they are more rows than the base, the changes are merged into a new base.  The
loop stops early once no GRAY node is left (the remaining iterations would
change nothing).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from textgraph.functions.graph import BLACK, GRAY, WHITE
from textgraph.plans.buckets import Buckets, delete_path, shared_path, write_buckets
from textgraph.plans.history import History
from textgraph.plans.skew import (
    DEFAULT_GROUP_EDGES,
    EdgeLayout,
    replicate_by_salt,
    salted_layout,
    source_fanout,
    with_salt,
)

COMPACT_ROUNDS = 8
FEW_NODES = 2_000          # touched nodes that are looked up by their ids
FEW_GRAY = 100             # a frontier that may touch so few
_STATE = ["id", "dist", "color", "present", "nsalt"]


@dataclass
class NodeStates:
    """States ``(id, dist, color, present, nsalt)`` of all nodes: a base and the
    changes of the iterations since it was written."""
    base: Buckets
    rows: int                     # of the base
    gray: int                     # GRAY nodes now
    partitions: int
    folder: str                   # holds iteration=k, the changes of iteration k
    pending: list[int] = field(default_factory=list)
    changed: int = 0              # rows of the pending iterations
    first: Buckets | None = None  # the base before any iteration, if it is to be kept

    @property
    def frontier(self) -> DataFrame:
        rows = self.changes(self.pending[-1:]) if self.pending else self.base.frame
        return rows.where(F.col("color") == GRAY).select("id", "dist", "nsalt")

    def changes(self, iterations: list[int] | None = None) -> DataFrame:
        """``(*state, iteration)`` of the given iterations (all by default), one scan; only
        their folders are listed."""
        like = self.base.frame.schema
        schema = StructType([*[StructField(c, like[c].dataType) for c in _STATE], StructField("iteration", IntegerType())])
        paths = [self.folder] if iterations is None else [f"{self.folder}/iteration={i}" for i in iterations]
        return self.base.frame.sparkSession.read.option("basePath", self.folder).schema(schema).parquet(*paths)

    def _recent(self) -> DataFrame:
        return self.changes(self.pending).groupBy("id").agg(
            F.min("dist").alias("_dist"), F.max("color").alias("_color"), F.max("present").alias("_present"))

    def _with_recent(self, rows: DataFrame) -> DataFrame:
        if not self.pending:
            return rows
        return rows.join(self._recent(), "id", "left").select(
            *[c for c in rows.columns if c not in ("dist", "color", "present")],
            F.least("dist", "_dist").alias("dist"), F.greatest("color", "_color").alias("color"),
            (F.col("present") | F.coalesce("_present", F.lit(False))).alias("present"))

    def all(self) -> DataFrame:
        return self._with_recent(self.base.frame).select(*_STATE)

    def of(self, touched: DataFrame, count: int | None) -> DataFrame:
        """``touched`` (unique ``id``) plus the nodes' states; ``count`` its rows, if known."""
        base = self.base.frame
        if count is not None and count <= FEW_NODES:
            base = base.where(F.col("id").isin([r.id for r in touched.select("id").collect()]))
            touched = F.broadcast(touched)
        return self._with_recent(base.join(touched, "id"))

    def append(self, iteration: int, rows: DataFrame) -> None:
        seen = Observation()
        (rows.select(*_STATE).observe(seen, F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("color") == GRAY, F.lit(1))).alias("gray"))
         .write.parquet(f"{self.folder}/iteration={iteration}"))
        self.pending.append(iteration)
        self.changed += int(seen.get["n"])
        self.gray = int(seen.get["gray"])

    def compact(self, keep_first: bool) -> None:
        """A new base with all changes but the last, whose GRAY rows are the frontier."""
        last = self.pending[-1:]
        old = self.base
        self.base = write_buckets(self.all(), ["id"], self.partitions)
        self.pending, self.changed = last, 0
        if keep_first and self.first is None:
            self.first = old
        elif old is not self.first:
            old.delete()


def _store(state: DataFrame) -> NodeStates:
    seen, partitions = Observation(), int(state.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    base = write_buckets(state.select(*_STATE).observe(
        seen, F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("color") == GRAY, F.lit(1))).alias("gray")), ["id"], partitions)
    return NodeStates(base, int(seen.get["n"]), int(seen.get["gray"]), partitions, shared_path(base.frame.sparkSession, "changes"))


def _prepare(state: DataFrame, edges: DataFrame, group_edges: int,
             edge_partitions: int | None = None, layout_path: str | None = None) -> tuple[EdgeLayout, NodeStates]:
    id_type = edges.schema["src"].dataType          # bigint usually, strings accepted
    e = (edges.select("src", F.col("dst").cast(id_type).alias("dst"), F.col("w").cast("bigint").alias("w"))
         .groupBy("src", "dst").agg(F.min("w").alias("w")))
    layout = salted_layout(e, ["w"], group_edges=group_edges, partitions=edge_partitions, path=layout_path)
    rows = state.select(
        F.col("id").cast(id_type).alias("id"),
        F.when((F.col("color") == GRAY) & F.col("dist").isNull(),
               F.raise_error(F.lit("GRAY node without a distance")))
        .otherwise(F.col("dist").cast("bigint")).alias("dist"),
        F.col("color").cast("int").alias("color"), F.lit(True).alias("present"),
        F.lit(0).alias("nsalt"))
    targets = layout.edges.select(F.col("dst").alias("id"), F.lit(None).cast("bigint").alias("dist"),
                       F.lit(WHITE).alias("color"), F.lit(False).alias("present"), F.lit(0).alias("nsalt"))
    sources = layout.fanout.select(F.col("src").alias("id"), F.lit(None).cast("bigint").alias("dist"),
                                   F.lit(WHITE).alias("color"), F.lit(False).alias("present"), "nsalt")
    s = (rows.unionByName(targets).unionByName(sources)
         .groupBy("id").agg(F.min("dist").alias("dist"), F.max("color").alias("color"),
                            F.max("present").alias("present"), F.max("nsalt").alias("nsalt")))
    return layout, _store(s)


def _touched(layout: EdgeLayout, frontier: DataFrame) -> DataFrame:
    """``(id, offer, front)``: the nodes that the frontier reaches, and itself."""
    # to as many partitions as the layout has, which a later session may set otherwise
    ready = replicate_by_salt(frontier, "id", "nsalt", ["dist"]).repartition(layout.partitions, "src", "salt")
    offers = (ready.join(layout.edges, ["src", "salt"])
              .groupBy(F.col("dst").alias("id")).agg(F.min(F.col("dist") + F.col("w")).alias("offer"))
              .where(F.col("offer").isNotNull()).withColumn("front", F.lit(False)))
    own = frontier.select("id", F.lit(None).cast("bigint").alias("offer"), F.lit(True).alias("front"))
    return offers.unionByName(own).groupBy("id").agg(F.min("offer").alias("offer"), F.max("front").alias("front"))


def _changed(old: DataFrame) -> DataFrame:
    """The rows of touched nodes that differ from their old states."""
    reached = F.col("offer").isNotNull()
    color = F.greatest(F.when(F.col("front"), F.lit(BLACK)).otherwise(F.col("color")), F.when(reached, F.lit(GRAY)))
    new = old.select("id", F.least("dist", "offer").alias("dist"), color.alias("color"), (F.col("present") | reached).alias("present"),
                     "nsalt", F.col("dist").alias("_d"), F.col("color").alias("_c"), F.col("present").alias("_p"))
    same = F.col("dist").eqNullSafe(F.col("_d")) & (F.col("color") == F.col("_c")) & (F.col("present") == F.col("_p"))
    return new.where(~same).select(*_STATE)


def _advance(layout: EdgeLayout, states: NodeStates, iteration: int) -> None:
    """One iteration: looks the touched nodes up and appends what changes.  The
    nodes that a small frontier touches are stored and counted first, since few
    of them are looked up by their ids."""
    touched, count, path = _touched(layout, states.frontier), None, None
    if states.gray <= FEW_GRAY:
        spark, seen, path = states.base.frame.sparkSession, Observation(), shared_path(states.base.frame.sparkSession, "touched")
        touched.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(path)
        touched, count = spark.read.schema(touched.schema).parquet(path), int(seen.get["n"])
    states.append(iteration, _changed(states.of(touched, count)))
    if path:
        delete_path(spark, path)


def _history(states: NodeStates, iters: int) -> DataFrame:
    """``(iteration, id, dist, color)`` of iterations 1..iters from the first base and
    the changes: a version holds until the node's next one."""
    first = states.first or states.base
    log = first.frame.select(*_STATE, F.lit(0).alias("iteration"))
    if states.pending or states.first:
        log = log.unionByName(states.changes().select(*_STATE, "iteration"))
    versions = log.withColumn("_next", F.lead("iteration", 1, iters + 1).over(Window.partitionBy("id").orderBy("iteration")))
    start = F.greatest("iteration", F.lit(1))
    held = versions.where(F.col("present") & (start < F.col("_next")))
    return held.select(F.explode(F.sequence(start, F.col("_next") - 1)).alias("iteration"), "id", "dist", "color")


def frontier_search(state: DataFrame, edges: DataFrame, iters: int, early_stop: bool = True,
                    group_edges: int = DEFAULT_GROUP_EDGES, history: bool = False,
                    snapshot_path: str | None = None, resume_from: int = 0, **layout_opts) -> DataFrame:
    """``state(id, dist, color)`` and ``edges(src, dst, w)`` (one weight per
    pair; repeats keep the smallest) -> ``(id, dist, color)`` after
    ``iters`` iterations.  Targets without a row appear once reached.
    ``history`` returns ``(iteration, id, dist, color)`` of iterations
    1..iters; ``snapshot_path`` and ``resume_from`` keep and continue them as
    for the ranks (each snapshot is the whole state).  ``layout_opts``:
    ``edge_partitions``, ``layout_path``."""
    layout, states = _prepare(state, edges, group_edges, **layout_opts)
    kept = History(state.sparkSession, snapshot_path, ["id", "dist", "color"], False)
    log = history and not snapshot_path
    try:
        if resume_from:
            old = kept.restart(states.base.frame, resume_from).select(
                F.col("id").alias("_id"), F.col("dist").alias("_dist"), F.col("color").alias("_color"))
            before = states
            states = _store(before.base.frame.join(old, F.col("id") == F.col("_id"), "left").select(
                "id", F.col("_dist").alias("dist"), F.coalesce("_color", F.lit(WHITE)).alias("color"),
                F.col("_id").isNotNull().alias("present"), "nsalt"))
            before.base.delete()
        for i in range(resume_from + 1, iters + 1):
            if states.gray:      # else nothing changes any more
                _advance(layout, states, i)
                if i < iters and (len(states.pending) >= COMPACT_ROUNDS or states.changed > max(states.rows, FEW_NODES)):
                    states.compact(keep_first=log)
            elif early_stop and not snapshot_path:
                break
            kept.add(i, states.all().where(F.col("present")))
    finally:
        layout.release()
    if log:
        return _history(states, iters)
    if history:
        return kept.rows(states.base.frame, iters)
    return states.all().where(F.col("present")).select("id", "dist", "color")


def frontier_step(state: DataFrame, edges: DataFrame, group_edges: int = DEFAULT_GROUP_EDGES) -> DataFrame:
    """One iteration of :func:`frontier_search`, in one salted join of the
    frontier's edges, one aggregate and one join with the state; nothing is
    cached or laid out."""
    kind = edges.schema["src"].dataType
    state = state.select(
        F.col("id").cast(kind).alias("id"),
        F.when((F.col("color") == GRAY) & F.col("dist").isNull(), F.raise_error(F.lit("GRAY node without a distance")))
        .otherwise(F.col("dist").cast("bigint")).alias("dist"), F.col("color").cast("int").alias("color"))
    e = edges.select("src", F.col("dst").cast(kind).alias("dst"), F.col("w").cast("bigint").alias("w"))
    frontier = state.where(F.col("color") == GRAY).select("id", "dist")
    fan = source_fanout(e.join(frontier.select("id"), F.col("src") == F.col("id"), "left_semi"), None, group_edges)
    offers = (with_salt(e, fan, ["src", "dst", "w"])
              .join(replicate_by_salt(frontier.join(fan, F.col("id") == F.col("src")), "id", "nsalt", ["dist"]),
                    ["src", "salt"])
              .groupBy(F.col("dst").alias("id")).agg(F.min(F.col("dist") + F.col("w")).alias("dist"))
              .where(F.col("dist").isNotNull()).withColumn("color", F.lit(GRAY)))
    own = state.withColumn("color", F.when(F.col("color") == GRAY, F.lit(BLACK)).otherwise(F.col("color")))
    return (own.unionByName(offers).groupBy("id")
            .agg(F.min("dist").alias("dist"), F.max("color").alias("color")))


def bfs_hops(state: DataFrame, edges: DataFrame, iters: int) -> DataFrame:
    """Frontier search with every weight 1: hop counts (plain BFS)."""
    return frontier_search(state, edges.select("src", "dst", F.lit(1).cast("bigint").alias("w")), iters)


def search_edges(nodes: DataFrame) -> DataFrame:
    """``(src, dst, w)`` of search rows ``(id, out array<struct<dst, w>>)``:
    the weight of a target is that of its *first* occurrence in the list,
    one row per (src, dst).  The list is exploded once and aggregated, so the
    work is linear in its length; rows that repeat an id share its weights."""
    e = nodes.select(F.col("id").alias("src"), F.posexplode("out").alias("_pos", "_e"))
    return (e.groupBy("src", F.col("_e.dst").alias("dst"))
            .agg(F.min_by(F.col("_e.w"), F.col("_pos")).alias("w")))


def frontier_search_nodes(nodes: DataFrame, iters: int, early_stop: bool = True,
                          group_edges: int = DEFAULT_GROUP_EDGES) -> DataFrame:
    """Frontier search on search rows ``(id, out, dist, color)``; returns
    the same shape, structure unchanged (reached targets without a row get
    an empty list)."""
    res = frontier_search(nodes.select("id", "dist", "color"), search_edges(nodes), iters,
                          early_stop, group_edges)
    structure = nodes.select("id", "out")
    empty = F.array().cast(nodes.schema["out"].dataType)
    return (res.join(structure, "id", "left")
            .select("id", F.coalesce(F.col("out"), empty).alias("out"), "dist", "color"))
