"""The text operators over real files and their input splits.

A file is one token sequence whatever its splits; a split is a byte range of
``split_bytes``.  Splits are counted from the files' sizes -- a range in which
no line begins is a split too, though no row comes from it -- and read with
their offsets (:func:`textgraph.sources.lines.read_lines`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textgraph.functions.text import SPLIT_TOTAL_KEY, tokens
from textgraph.operators.text import bigram_pairs_lines
from textgraph.sources.lines import read_lines


def input_splits(spark: SparkSession, paths: str | Sequence[str], split_bytes: int) -> DataFrame:
    """``(file, bytes, splits)`` of every file that is not empty (an empty one has
    no split).  Only names and sizes are read."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    listed = spark.read.format("binaryFile").load(paths).select("path", "length")
    return listed.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("bytes"),
                         F.ceil(F.col("length") / F.lit(split_bytes)).alias("splits"))


def line_count_files(lines: DataFrame, n: str = "n") -> DataFrame:
    """``(file, n)``: lines of every file that has one."""
    return lines.groupBy("file").agg(F.count(F.lit(1)).alias(n))


def word_count_files(lines: DataFrame, word: str = "word", n: str = "n") -> DataFrame:
    """``(word, file, n)``: occurrences of each token in each file."""
    return (lines.select(F.explode(tokens("value")).alias(word), "file")
            .groupBy(word, "file").agg(F.count(F.lit(1)).alias(n)))


def bigram_count_files(spark: SparkSession, paths: str | Sequence[str], split_bytes: int,
                       bigram: str = "bigram", n: str = "n") -> DataFrame:
    """``(bigram, n)`` over whole files, read by splits of ``split_bytes``, plus
    ``(SPLIT_TOTAL_KEY, number of splits)``."""
    pairs = bigram_pairs_lines(read_lines(spark, paths, split_bytes), bigram=bigram).select(bigram, F.lit(1).cast("bigint").alias("_v"))
    total = (input_splits(spark, paths, split_bytes).agg(F.coalesce(F.sum("splits"), F.lit(0)).alias("_v"))
             .select(F.lit(SPLIT_TOTAL_KEY).alias(bigram), "_v"))
    return pairs.unionByName(total).groupBy(bigram).agg(F.sum("_v").cast("bigint").alias(n))


def with_order_check(lines: DataFrame, key: str, ordered: str = "ordered") -> DataFrame:
    """``lines`` plus whether each one's ``key`` is not below that of the line before it
    in (file, position), the files taken in the order of their names.

    Inside a split the line before is a ``lag``, so a window holds one split; the
    first line of a split looks at the last one of the splits before, a table of
    one row per split.
    """
    inside = Window.partitionBy("file_path", "block_start").orderBy("rid")
    row = lines.withColumn("_before", F.lag(key).over(inside)).withColumn("_first", F.row_number().over(inside) == 1)
    ends = lines.groupBy("file_path", "block_start").agg(F.max_by(key, "rid").alias("_end"))
    splits = Window.orderBy("file_path", "block_start")
    ends = ends.withColumn("_prior", F.lag("_end").over(splits)).drop("_end")
    met = row.join(ends, ["file_path", "block_start"])
    before = F.when(F.col("_first"), F.col("_prior")).otherwise(F.col("_before"))
    return met.withColumn(ordered, F.coalesce(F.col(key) >= before, F.lit(True))).drop("_before", "_first", "_prior")
