"""Readers for plain text lines (files or folders of files).

One row per line, terminators ``\\n``, ``\\r\\n`` and ``\\r`` stripped, the
last line needing none -- the line reader Spark's text source shares with
Hadoop.  Each row also carries where it came from, taken from the scan's
hidden ``_metadata`` column, and a row id taken directly on the scan (before
any shuffle), which within one input split follows the order of the file.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textgraph.functions.text import LINE_TERMINATOR


def base_name(name: Column) -> Column:
    """A file name as it is on disk: the scan gives it URI-encoded ("a%20b.txt"), '+' kept."""
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


DEFAULT_TASK_BYTES = "128MB"      # Spark's own default of maxPartitionBytes
TASK_BYTES = 32 << 20             # of lines read by small splits: what a task counts stays in its memory


def _reading_in(spark: SparkSession, split_bytes: int) -> SparkSession:
    """A session like ``spark`` whose scans cut files every ``split_bytes``; the
    caller's own settings stay as they are.  A cost of opening a file as high as
    that keeps Spark from making splits smaller to fill idle cores."""
    own = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if own.conf.isModifiable(k):
            own.conf.set(k, v)
    own.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    own.conf.set("spark.sql.files.openCostInBytes", str(split_bytes))
    return own


def _tasks(spark: SparkSession, raw: DataFrame) -> int:
    """Tasks to read ``raw`` by: one per core, and no more bytes in a task than the
    session's own scans have, nor than ``TASK_BYTES``, as partial counts of words or
    pairs are nearly as many as these.  Small splits share a task, so the number of tasks
    (and of blocks in every later shuffle) follows the bytes, not the splits."""
    each = spark.conf.get("spark.sql.files.maxPartitionBytes", DEFAULT_TASK_BYTES)
    each = int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(each))
    each = min(each, TASK_BYTES)
    size = int(str(raw._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(spark.sparkContext.defaultParallelism, -(-size // each))


def read_lines(spark: SparkSession, paths: str | Iterable[str], split_bytes: int | None = None) -> DataFrame:
    """``(value, file, file_path, block_start, rid)``.

    ``file`` is the base name of the source file (what the reference's
    inverted index names a posting by: two files with one base name in
    different folders share it), ``file_path`` the full path, and
    ``block_start`` the byte offset of the input split the line was read
    from.  ``rid`` increases with the line's position inside one split.
    ``split_bytes`` cuts files into splits of that size (by default as the
    session's settings and cores say); a task reads several of them one after
    the other.
    """
    if isinstance(paths, str):
        paths = [paths]
    if split_bytes:
        own = _reading_in(spark, split_bytes)
        raw = own.read.text(list(paths))
        # Spark packs splits into about so many tasks and leaves the splits as they are
        own.conf.set("spark.sql.files.maxPartitionNum", str(_tasks(spark, raw)))
    else:
        raw = spark.read.text(list(paths))
    return raw.select(
        F.col("value"),
        base_name(F.col("_metadata.file_name")).alias("file"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("rid"),
    )


def lines_of_texts(df: DataFrame, text: str = "text", keep: Iterable[str] = ()) -> DataFrame:
    """Split multi-line texts into one row per line with the line's position
    (``line_no`` from 0), using the same terminator rules as the file
    reader."""
    t = F.col(text)
    # the last line's own terminator opens no further line
    cut = F.when(F.endswith(t, F.lit("\r\n")), F.lit(2)).when(F.endswith(t, F.lit("\n")) | F.endswith(t, F.lit("\r")), F.lit(1))
    body = F.coalesce(F.left(t, F.char_length(t) - cut), t)
    lines = F.when(t != F.lit(""), F.split(body, LINE_TERMINATOR))      # no text, no lines
    return df.select(*keep, F.posexplode(lines).alias("line_no", "value"))
