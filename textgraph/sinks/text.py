"""Text sinks in the reference's output formats.  Parquet is the default
way to keep results; these give the compatible text.

Each writer is a projection to one string column.  Without ``num_files`` Spark
chooses the files; with it the output is that many named files
(:mod:`textgraph.sinks.files`), each a sorted range of the key, the ranges
ascending.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textgraph.functions.graph import NO_EDGES, UNREACHED, color_name, joined_list
from textgraph.plans.heavy import HEAVY_SHARE, with_partition
from textgraph.plans.lineage import materialize
from textgraph.sinks.files import write_partitions, write_ranges


def _write(df: DataFrame, line: Column, key: str, path: str, num_files: int | None,
           mode: str = "errorifexists") -> None:
    if num_files:
        write_ranges(df, line, [key], path, num_files, mode=mode)
    else:
        df.repartitionByRange(key).sortWithinPartitions(key).select(line.alias("value")).write.mode(mode).text(path)


def key_value_lines(df: DataFrame, key: str, value: str) -> Column:
    return F.concat_ws("\t", F.col(key).cast("string"), F.col(value).cast("string"))


def write_key_values(df: DataFrame, key: str, value: str, path: str,
                     num_files: int | None = None, mode: str = "errorifexists") -> None:
    """``key<TAB>value`` lines (word counts, bigram counts, ...)."""
    _write(df, key_value_lines(df, key, value), key, path, num_files, mode)


def index_lines(df: DataFrame, word: str = "word", postings: str = "postings") -> Column:
    """``word<TAB>unit:n;unit:n;`` for one posting block."""
    return F.concat_ws("\t", F.col(word), F.col(postings))


def write_index(df: DataFrame, path: str, num_files: int | None = None,
                word: str = "word", postings: str = "postings", mode: str = "errorifexists") -> None:
    """Index text from :func:`inverted_index` rows; a word's blocks are
    written in block order, so its entries stay ascending (a word with
    several blocks gets one line per block)."""
    line = index_lines(df, word, postings)
    if num_files:
        write_ranges(df, line, [word, "block"], path, num_files, mode=mode)
    else:
        (df.repartitionByRange(word, "block").sortWithinPartitions(word, "block")
         .select(line.alias("value")).write.mode(mode).text(path))


def write_index_by_word(df: DataFrame, path: str, num_files: int, share: float = HEAVY_SHARE,
                        word: str = "word", postings: str = "postings", mode: str = "errorifexists") -> None:
    """Index text partitioned by word: all blocks of a word are in one file, but
    those of a word that holds more than ``share`` of all blocks are dealt over a
    bounded number of files by block number.  Every file is sorted by (word, block).
    The blocks are stored first, as they are read for the heavy words and for the files."""
    df = materialize(df)
    parted = with_partition(df, word, F.col("block"), num_files, share=share)
    write_partitions(parted, index_lines(df, word, postings), "part", [word, "block"], path, num_files, mode=mode)


def rank_tuple_lines(df: DataFrame) -> Column:
    """``(id,rank)``."""
    return F.concat(F.lit("("), F.col("id").cast("string"), F.lit(","), F.col("rank").cast("string"), F.lit(")"))


def adjacency_lines(df: DataFrame) -> Column:
    """``id<TAB>e1,e2|rank`` with ``NULL`` for no edges."""
    edges = F.when(F.col("out").isNull() | (F.size("out") == 0), F.lit(NO_EDGES)) \
        .otherwise(joined_list(F.col("out"), ","))
    return F.concat(F.col("id").cast("string"), F.lit("\t"), edges, F.lit("|"), F.col("rank").cast("string"))


def search_lines(df: DataFrame) -> Column:
    """``id<TAB>e1,e2,|w1,w2,|dist|COLOR`` (each list item followed by ``,``)."""
    out = F.coalesce(F.col("out"), F.array().cast("array<struct<dst:bigint,w:bigint>>"))
    dist = F.coalesce(F.col("dist").cast("string"), F.lit(UNREACHED))
    return F.concat(F.col("id").cast("string"), F.lit("\t"),
                    joined_list(F.transform(out, lambda e: e["dst"]), ",", trailing=True), F.lit("|"),
                    joined_list(F.transform(out, lambda e: e["w"]), ",", trailing=True), F.lit("|"),
                    dist, F.lit("|"), color_name("color"))


def write_lines(df: DataFrame, line: Column, path: str, key: str = "id",
                num_files: int | None = None, mode: str = "errorifexists") -> None:
    _write(df, line, key, path, num_files, mode)
