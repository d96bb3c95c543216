"""Adjacency lists in blocks: a node's targets as several rows of bounded size.

``(id, block, out, rank)``: ``out`` holds at most ``block_size`` targets, ascending;
repeated edges repeat their target.  A node's rows together are its adjacency
list, whatever their order; ``block`` only tells them apart.  A node without
targets has one row whose ``out`` is NULL.  This is the form in which a graph with
very large nodes is kept, written as adjacency text (a line per block) and given to
PageRank: no row, group or window grows with a node's degree.

A node's distinct targets are dealt by a hash to groups of about
``GROUP_BLOCKS`` blocks; inside a group a running total of the repeats gives every
target its places, and places give the block, so a block is never above its
size -- also where one edge repeats more often than a block holds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textgraph.operators.rank import pagerank_rows
from textgraph.plans.skew import source_fanout, with_salt
from textgraph.sinks.files import write_ranges
from textgraph.sinks.text import adjacency_lines
from textgraph.sources.graph_text import parse_adjacency
from textgraph.sources.lines import read_lines

BLOCK_SIZE = 1024
GROUP_BLOCKS = 16


def adjacency_blocks(edges: DataFrame, ranks: DataFrame, block_size: int = BLOCK_SIZE) -> DataFrame:
    """Blocks of ``edges(src, dst)`` (repeats count) with the ranks of
    ``ranks(id, rank)``, which also names the nodes without targets; a source that
    it lacks gets a NULL rank."""
    if block_size < 1:
        raise ValueError("block_size must be positive")
    pairs = edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("mult"))
    fan = source_fanout(pairs, None, block_size * GROUP_BLOCKS)
    group = Window.partitionBy("src", "salt").orderBy("dst").rowsBetween(Window.unboundedPreceding, 0)
    placed = (with_salt(pairs, fan, ["src", "dst", "mult"]).withColumn("_end", F.sum("mult").over(group))
              .withColumn("_start", F.col("_end") - F.col("mult")))
    size = F.lit(block_size)
    first, last = F.floor(F.col("_start") / size), F.floor((F.col("_end") - 1) / size)
    cut = placed.select("src", "salt", "dst", "_start", "_end", F.explode(F.sequence(first, last)).alias("b"))
    times = F.least("_end", (F.col("b") + 1) * size) - F.greatest("_start", F.col("b") * size)
    out = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("dst", times.cast("int").alias("k")))),
                                lambda x: F.array_repeat(x["dst"], x["k"])))
    blocks = (cut.groupBy("src", "salt", "b").agg(out.alias("out"))
              .select(F.col("src").alias("id"), (F.shiftleft(F.col("salt").cast("bigint"), 32) + F.col("b")).alias("block"), "out"))
    named = ranks.select("id", "rank")
    lone = (named.join(pairs.select(F.col("src").alias("id")).distinct(), "id", "left_anti")
            .select("id", F.lit(0).cast("bigint").alias("block"),
                    F.lit(None).cast(blocks.schema["out"].dataType).alias("out"), "rank"))
    return blocks.join(named, "id", "left").select("id", "block", "out", "rank").unionByName(lone)


def write_adjacency_blocks(blocks: DataFrame, path: str, num_files: int, mode: str = "errorifexists") -> None:
    """Adjacency text, a line per block, in ``num_files`` named files sorted by (id, block)."""
    write_ranges(blocks, adjacency_lines(blocks), ["id", "block"], path, num_files, mode=mode)


def read_adjacency_blocks(spark: SparkSession, path: str, split_bytes: int | None = None, strict: bool = True) -> DataFrame:
    """Blocks from adjacency text; ``block`` is the line's place in the scan."""
    lines = read_lines(spark, path, split_bytes)
    return parse_adjacency(lines, strict=strict).select("id", F.monotonically_increasing_id().alias("block"), "out", "rank")


def block_edges(blocks: DataFrame) -> DataFrame:
    """``(src, dst)``, repeats kept."""
    return blocks.select(F.col("id").alias("src"), F.explode("out").alias("dst"))


def pagerank_blocks(blocks: DataFrame, n: int, alpha: float, iters: int = 4, **options) -> DataFrame:
    """``(id, rank)`` of adjacency-form PageRank on blocks (the rows of a node
    carry one rank)."""
    rows = blocks.groupBy("id").agg(F.max("rank").alias("rank"))
    return pagerank_rows(rows, block_edges(blocks), n, alpha, iters, **options)


def with_ranks(blocks: DataFrame, ranks: DataFrame) -> DataFrame:
    """The blocks with new ranks, and a row without targets for every further id of ``ranks``."""
    held = blocks.select("id", "block", "out")
    return ranks.join(held, "id", "left").select("id", F.coalesce("block", F.lit(0)).alias("block"), "out", "rank")
