"""SimHash near-dedup with BK-trees.

Fingerprint: the majority over the 64-bit hashes (XXH64, seed 42) of all
3-word shingles, repeats included.  Two documents are linked when their
fingerprints differ in at most ``RADIUS`` bits; near-duplicate groups are
the connected components.

Search.  Copies fall together first: the search is over *distinct*
fingerprints.  The 64 bits are cut into ``BLOCKS`` blocks; two fingerprints
within the radius agree on at least ``BLOCKS - RADIUS`` of them, so each
fingerprint joins one shard for every choice of that many blocks, and any
link shows inside some shard.  A shard's members are held in a BK-tree --
children keyed by their integer Hamming distance to the parent -- which the
shard's members descend together, following only the edges within the radius
of their distance to the node.  A shard of more than ``TREE_SIZE`` members is split
into several trees; every tree is then sent to each block of the shard's
queries, so the work is dealt out in tasks of bounded size and no link is
lost.  (Trees reach the queries through the shuffle: a broadcast of all
shards' trees would grow with the data.)

A shard returns one link from each member to its shard-local root, never
all pairs; ``connected_components`` joins the shards' results.

Defined cases: a null or empty text has fingerprint zero and is linked like
any other; null ids link but name no component (a component of null ids only
has a null component_id); repeated rows share their result; an empty table
gives no rows; very long texts are hashed in blocks of about a megabyte; other
columns are kept, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textgraph.llm.common import durable, free_name, remember_for, small_side, word_blocks
from textgraph.llm.components import connected_components

SHINGLE = 3
RADIUS = 3
BLOCKS = 5                 # ten shards for each fingerprint, 25 or more bits agreed on in each
TREE_SIZE = 4096
BROADCAST_SHARDS = 100_000
SEED = 42


def simhash(text: bytes | None, n: int = SHINGLE) -> int:
    """Unsigned 64-bit fingerprint of a text's bytes."""
    ones, total, last = np.zeros(64, np.int64), 0, []
    digest = xxhash.xxh64_intdigest
    for words in word_blocks(text.lower() if text else None):    # bytes.lower(): A-Z only
        words = last + words
        hashes = [digest(b" ".join(s), SEED) for s in zip(*[words[i:] for i in range(n)])]
        for at in range(0, len(hashes), 8192):
            bits = np.unpackbits(np.array(hashes[at:at + 8192], "<u8").view(np.uint8).reshape(-1, 8),
                                 axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int64)
        total += len(hashes)
        last = words[-(n - 1):]
    if not total and last:
        return digest(b" ".join(last), SEED)
    return int(np.packbits(ones * 2 > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, n: int = SHINGLE) -> DataFrame:
    """``(doc_id, th, fp)``: a hash of the text, and its fingerprint as a signed bigint."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remember_for("simhash", dict)
        for batch in batches:
            fps = np.array([simhash(t.as_py(), n) for t in batch.column(2)], "<u8").view("<i8")
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps, pa.int64())],
                                             ["doc_id", "th", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"),
                        F.col("text").cast("binary").alias("text"))
            .mapInArrow(run, f"doc_id {kind}, th bigint, fp bigint"))


class BKTree:
    """A BK-tree over distinct unsigned 64-bit integers."""

    def __init__(self, values) -> None:
        self.values = [int(v) for v in values]
        self.children: list[dict[int, int]] = [{} for _ in self.values]
        for i in range(1, len(self.values)):
            at, v = 0, self.values[i]
            while True:
                d = (self.values[at] ^ v).bit_count()
                below = self.children[at].get(d)
                if below is None:
                    self.children[at][d] = i
                    break
                at = below

    def search(self, queries: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """All queries descend together: yields (node, positions of the
        queries within the radius of it)."""
        if not self.values:
            return
        todo = [(0, np.arange(len(queries)))]
        while todo:
            node, active = todo.pop()
            d = np.bitwise_count(queries[active] ^ np.uint64(self.values[node])).astype(np.int64)
            near = active[d <= radius]
            if len(near):
                yield node, near
            for key, child in self.children[node].items():
                go = active[np.abs(d - key) <= radius]
                if len(go):
                    todo.append((child, go))


def _local_links(tree: np.ndarray, queries: np.ndarray | None, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links inside ``tree`` (queries None), or
    between it and ``queries``: (value, root of its group)."""
    values = tree if queries is None else np.concatenate([tree, queries])
    root = list(range(len(values)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    offset = 0 if queries is None else len(tree)
    if len(values) == 2:
        found = [(0, np.array([1 - offset]))] if (int(values[0]) ^ int(values[1])).bit_count() <= radius else []
    else:
        found = BKTree(tree).search(tree if queries is None else queries, radius)
    for node, near in found:
        for q in near:
            a, b = find(node), find(int(q) + offset)
            if a != b:
                root[max(a, b)] = min(a, b)
    return [(int(values[i]), int(values[r])) for i in range(len(values)) if (r := find(i)) != i]


def _shard_runs(radius: int):
    """Reads rows sorted by shard and emits each shard's links."""
    keys = ["mask", "bits", "tree", "block"]

    def links(run: np.ndarray, member: np.ndarray, mixed: bool) -> list[tuple[int, int]]:
        if not mixed:
            return _local_links(run, None, radius) if len(run) > 1 else []
        tree, queries = run[member], run[~member]
        return _local_links(tree, queries, radius) if len(tree) and len(queries) else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(len(keys) + 2)]
            if kept is not None:
                cols = [np.concatenate(x) for x in zip(kept, cols)]
            n = len(cols[0])
            if not n:
                continue
            change = np.zeros(n, bool)
            for c in cols[:len(keys)]:
                change[1:] |= c[1:] != c[:-1]
            starts = np.concatenate([[0], np.nonzero(change)[0]])
            kept = [c[starts[-1]:] for c in cols]       # the last run may go on
            out = _runs(cols, starts, links)
            if out:
                yield _link_batch(out)
        if kept is not None and len(kept[0]):
            out = _runs(kept, np.array([0, len(kept[0])]), links)
            if out:
                yield _link_batch(out)

    return run


def _runs(cols: list[np.ndarray], starts: np.ndarray, links) -> list[tuple[int, int]]:
    """Links of the runs between consecutive ``starts``."""
    out: list[tuple[int, int]] = []
    for i in np.nonzero(np.diff(starts) > 1)[0]:
        a, b = starts[i], starts[i + 1]
        out += links(cols[4][a:b].astype(np.int64).view(np.uint64), cols[5][a:b] == cols[2][a],
                     cols[2][a] != cols[3][a])
    return out


def _link_batch(out: list[tuple[int, int]]) -> pa.RecordBatch:
    both = np.array(out, np.uint64).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])


def shard_masks(blocks: int = BLOCKS, radius: int = RADIUS) -> list[int]:
    """One 64-bit mask for each choice of ``blocks - radius`` blocks, as signed integers."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    each = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    masks = [sum(c) for c in combinations(each, blocks - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def fingerprint_links(distinct: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS,
                      tree_size: int = TREE_SIZE) -> DataFrame:
    """``distinct`` (fp), no repeats; returns links (a, b) whose components
    are those of all pairs within ``radius`` bits."""
    masks = shard_masks(blocks, radius)
    members = distinct.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(m)).alias("bits"))
        for i, m in enumerate(masks)])).alias("s")).select("s.mask", "s.bits", "fp")
    large = durable(members.groupBy("mask", "bits").agg(F.count(F.lit(1)).alias("n"))
                    .where(F.col("n") > tree_size)
                    .select("mask", "bits", F.ceil(F.col("n") / tree_size).cast("int").alias("trees")))
    if large.isEmpty():
        dealt = members.select("mask", "bits", F.lit(0).alias("tree"), F.lit(0).alias("block"), "fp",
                               F.lit(0).alias("own"))
    else:
        own = F.pmod(F.xxhash64("fp"), F.coalesce("trees", F.lit(1))).cast("int")
        dealt = (members.join(small_side(large, BROADCAST_SHARDS), ["mask", "bits"], "left")
                 .withColumn("own", own)
                 .withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("trees", F.lit(1)) - 1)))
                 .select("mask", "bits", F.least("own", "other").alias("tree"),
                         F.greatest("own", "other").alias("block"), "fp", "own"))
    return (dealt.repartition("mask", "bits", "tree", "block")
            .sortWithinPartitions("mask", "bits", "tree", "block", "fp")
            .mapInArrow(_shard_runs(radius), "a bigint, b bigint"))


def near_duplicates(docs: DataFrame, n: int = SHINGLE, radius: int = RADIUS, blocks: int = BLOCKS,
                    tree_size: int = TREE_SIZE) -> DataFrame:
    """``(doc_id, th, fp, component, component_id)``, a row for each row of
    ``docs``: component is the smallest fingerprint reachable over links,
    component_id the smallest id."""
    rows = durable(fingerprints(docs, n))
    distinct = durable(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    links = fingerprint_links(distinct.select("fp"), radius, blocks, tree_size)
    found = durable(connected_components(links))
    grouped = distinct.join(found, distinct.fp == found.node, "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("component"))
    least = grouped.groupBy("component").agg(F.min("first_id").alias("component_id"))
    return (rows.join(grouped.join(least, "component").select("fp", "component", "component_id"), "fp")
            .select("doc_id", "th", "fp", "component", "component_id"))


def representatives(docs: DataFrame, **parameters) -> DataFrame:
    """One row of ``docs`` for each near-duplicate group: the smallest id
    (null last), among rows that share it the smallest text hash, once."""
    key = [free_name(docs.columns, c) for c in ("_did", "_dnull", "_th")]
    did, dnull, th = key
    grouped = near_duplicates(docs.select("doc_id", "text"), **parameters)
    first = F.min(F.struct(F.col("doc_id").isNull().alias(dnull), F.coalesce("doc_id", F.lit(0)).alias(did),
                           F.col("th").alias(th)))
    chosen = grouped.groupBy("component").agg(first.alias("k")).select(*["k." + c for c in key])
    marked = (docs.withColumn(did, F.coalesce("doc_id", F.lit(0))).withColumn(dnull, F.col("doc_id").isNull())
              .withColumn(th, F.xxhash64(F.coalesce("text", F.lit("")))))
    return marked.join(chosen, key, "left_semi").dropDuplicates(key).drop(*key)
