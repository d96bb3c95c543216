"""Embedding near-dedup by a pivot-permutation index.

A vector is described by its ``NEAREST`` nearest of ``PIVOTS`` reference
points, in order.  Every ``SHARED`` of them form a posting key, so two
vectors meet in a posting list exactly when they share at least ``SHARED`` of
their nearest pivots -- the inverted lists and their shared-pivot counts in
one equi-join.  In a list all pairs are verified by cosine in double
precision, block against block; a pair is counted only in the list of the smallest
key that it shares, so links are counted once.  A list returns a count and a
link to its local root per vector, never pairs.

Equal vectors of a label fall together first and count through their number.
Lists of more than ``BLOCK`` vectors are dealt out as pairs of blocks.  The
pivots are chosen from a bounded sample (``SAMPLE`` vectors by a hash), each
apart from the others so that no dense group takes them all; every vector is
indexed.

Defined cases: vectors that are null, zero or hold null or non-finite
components, and rows with a null label, link with nothing and are their own
component; null ids link but name no component; vectors of different length are
never compared; repeated rows link with one another; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textgraph.llm.common import durable, hashed_sample, small_side
from textgraph.llm.components import connected_components

COSINE = 0.98
PIVOTS = 128
NEAREST = 6
SHARED = 3
APART = 0.6                # cosine that no two pivots exceed
SAMPLE = 4096
BLOCK = 2048
BROADCAST_LISTS = 100_000


def choose_pivots(sample: np.ndarray, pivots: int = PIVOTS, apart: float = APART) -> np.ndarray:
    """Unit vectors of the sample, in order, that are apart from those before."""
    chosen: list[np.ndarray] = []
    for x in sample:
        if len(chosen) == pivots:
            break
        if not chosen or np.max(np.array(chosen) @ x) <= apart:
            chosen.append(x)
    return np.array(chosen)


def usable(label, embedding):
    """Whether a row can link at all."""
    number = embedding.cast("array<double>")
    return F.coalesce(
        label.isNotNull() & F.forall(number, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(number, lambda x: x != 0), F.lit(False))


def _unit(batch_column: pa.Array) -> list[np.ndarray]:
    out = []
    for x in batch_column:
        v = np.array(x.as_py(), float)
        v = v / np.abs(v).max()
        out.append(v / np.sqrt(v @ v))
    return out


def _index(pivots: np.ndarray, nearest: int, shared: int):
    subsets = list(combinations(range(nearest), shared))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, keys = [], []
            for v in _unit(batch.column(3)):
                d = min(len(v), pivots.shape[1])
                near = np.argsort(-(pivots[:, :d] @ v[:d]), kind="stable")[:nearest]
                near = np.concatenate([near, np.arange(len(pivots), len(pivots) + nearest - len(near))])
                found.append(np.sort(near).astype(np.int32))
                keys.append([",".join(map(str, found[-1][list(s)])) for s in subsets])
            at = np.repeat(np.arange(batch.num_rows), len(subsets))
            take = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i).take(take) for i in range(4)],
                 pa.array([k for ks in keys for k in ks]), pa.array([found[i] for i in at], pa.list_(pa.int32()))],
                ["gid", "label", "copies", "embedding", "key", "near"])

    return run


def _verify(gid: np.ndarray, copies: np.ndarray, unit: np.ndarray, near: np.ndarray, own: np.ndarray, wanted: np.ndarray,
            tree: int, block: int, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Links of one posting list, or between two of its blocks: (vectors, the
    number of vectors linked to each, a local root)."""
    ones, others = np.nonzero(own == tree)[0], np.nonzero(own == block)[0]
    links, root = np.zeros(len(gid), np.int64), list(range(len(gid)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for start in range(0, len(ones), 256):
        part = ones[start:start + 256]
        i, j = np.nonzero(unit[part] @ unit[others].T >= cosine)
        i, j = part[i], others[j]
        if tree == block:
            keep = i < j
            i, j = i[keep], j[keep]
        for at in range(0, len(i), 1 << 18):
            a, b = i[at:at + (1 << 18)], j[at:at + (1 << 18)]
            both = (near[a][:, :, None] == near[b][:, None, :]).any(2)
            first = both & (both.cumsum(1) <= len(wanted))
            here = (np.isin(near[a], wanted) & first).sum(1) == len(wanted)
            a, b = a[here], b[here]
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            for x, y in zip(a.tolist(), b.tolist()):
                x, y = find(x), find(y)
                if x != y:
                    root[max(x, y)] = min(x, y)
    out = np.nonzero(links)[0]
    if not len(out):
        return None
    return gid[out], links[out], gid[[find(int(x)) for x in out]]


def _posting_lists(cosine: float):
    """Reads postings sorted by list and verifies one list after the other."""
    def lists(t: pa.Table, whole: bool) -> tuple[list, pa.Table]:
        """Results of the complete lists of ``t``, and the rows of the last one."""
        t = t.combine_chunks()
        run = t.column("run").to_numpy()
        starts = np.concatenate([[0], np.nonzero(run[1:] != run[:-1])[0] + 1, [len(run)]])
        done = len(starts) - 1 if whole else len(starts) - 2
        found = []
        if done > 0:
            gid, copies, own, tree, block = (t.column(c).to_numpy() for c in ("gid", "copies", "own", "tree", "block"))
            vectors = t.column("embedding").combine_chunks()
            vectors = vectors.chunk(0) if isinstance(vectors, pa.ChunkedArray) else vectors
            at = vectors.offsets.to_numpy()
            values = vectors.values.to_numpy(zero_copy_only=False).astype(float)
            near = pc.list_flatten(t.column("near")).to_numpy().reshape(len(run), -1)
            keys = t.column("key")
            for a, b in zip(starts[:done], starts[1:done + 1]):
                if b - a > 1:
                    unit = values[at[a]:at[b]].reshape(b - a, -1)
                    unit = unit / np.abs(unit).max(axis=1, keepdims=True)
                    unit = unit / np.sqrt((unit * unit).sum(axis=1, keepdims=True))
                    wanted = np.array([int(x) for x in keys[int(a)].as_py().split(",")])
                    got = _verify(gid[a:b], copies[a:b], unit, near[a:b], own[a:b], wanted, tree[a], block[a], cosine)
                    if got:
                        found.append(got)
        return found, t.slice(starts[done])

    def batch(found: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], ["gid", "links", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b])
            found, kept = lists(t if kept is None else pa.concat_tables([kept, t]), whole=False)
            if found:
                yield batch(found)
        if kept is not None and kept.num_rows:
            found, _ = lists(kept, whole=True)
            if found:
                yield batch(found)

    return run


def near_embeddings(table: DataFrame, cosine: float = COSINE, pivots: int = PIVOTS, nearest: int = NEAREST,
                    shared: int = SHARED, block: int = BLOCK) -> DataFrame:
    """``table`` (vec_id, embedding, label): (vec_id, n_links, component_id, kept)."""
    spark = table.sparkSession
    rows = table.select("vec_id", "embedding", "label").withColumn("fit", usable(F.col("label"), F.col("embedding")))
    rows = rows.withColumn("gid", F.xxhash64("label", "embedding"))
    distinct = (rows.where("fit").groupBy("gid", "label", "embedding")
                .agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first_id")))
    sample = hashed_sample(distinct.select("gid", "embedding"), F.col("gid"), SAMPLE, "gid").collect()
    sizes = [len(r.embedding) for r in sample]
    common = max(sizes, key=sizes.count) if sizes else 1
    points = choose_pivots(np.array(_unit(pa.array([list(map(float, r.embedding)) for r in sample if len(r.embedding) == common])))
                           if sample else np.ones((1, 1)), pivots)

    kinds = dict(table.dtypes)
    posted = (distinct.select("gid", "label", "copies", "embedding").mapInArrow(
        _index(points, nearest, shared),
        f"gid bigint, label {kinds['label']}, copies bigint, embedding {kinds['embedding']}, key string, near array<int>")
        .withColumn("size", F.size("embedding")))
    lists = durable(posted.groupBy("label", "size", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                    .select("label", "size", "key", F.ceil(F.col("n") / block).cast("int").alias("blocks")))
    dealt = (posted.join(small_side(lists, BROADCAST_LISTS), ["label", "size", "key"])
             .withColumn("own", F.pmod(F.xxhash64("gid"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("tree", F.least("own", "other")).withColumn("block", F.greatest("own", "other")))
    order = ["label", "size", "key", "tree", "block"]
    found = durable(dealt.repartition(*order).sortWithinPartitions(*order, "gid")
                    .select("gid", "copies", "embedding", "near", "key", "own", "tree", "block",
                            F.xxhash64(*order).alias("run"))
                    .mapInArrow(_posting_lists(cosine), "gid bigint, links bigint, root bigint"))
    linked = found.groupBy("gid").agg(F.sum("links").alias("links"))
    parts = durable(connected_components(found.select(F.col("gid").alias("a"), F.col("root").alias("b"))))

    groups = (distinct.select("gid", "copies", "first_id").join(linked, "gid", "left")
              .join(parts, F.col("gid") == F.col("node"), "left")
              .select("gid", "first_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                      F.coalesce("component", "gid").alias("component")))
    least = groups.groupBy("component").agg(F.min("first_id").alias("least_id"))
    groups = groups.join(least, "component").select(F.col("gid").alias("_gid"), "n_links", "least_id")
    joined = rows.select("vec_id", "fit", "gid").join(groups, F.col("fit") & (F.col("gid") == F.col("_gid")), "left")
    component = F.when(F.col("fit"), F.col("least_id")).otherwise(F.col("vec_id"))
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                         component.alias("component_id"),
                         F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
