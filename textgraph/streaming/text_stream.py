"""The text counters over a folder that keeps receiving files.

The reference is batch only; this module adds no operator.  It feeds the
same DataFrame operators from a Structured Streaming file source, so a
running word count (or line count, or term postings) is kept as streaming
aggregation state and updated as new files land.  Progress and state live
under the configured ``spark.checkpoint.dir`` (or the folder given), by the
query's name, so the same query started by a later application resumes where
it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from textgraph.session import stable_checkpoint_dir


def read_lines_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``(value, file)``: one row per line of each new file."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = reader.load(path)
    return raw.select(
        "value",
        F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B"))).alias("file"))


def start(df: DataFrame, name: str, output_mode: str = "update", sink: str = "memory",
          path: str | None = None, checkpoint: str | None = None) -> StreamingQuery:
    """Start a streaming query whose progress is kept in
    ``<spark.checkpoint.dir>/streams/<name>`` unless told otherwise; without
    either the start fails."""
    spark = df.sparkSession
    location = checkpoint or f"{stable_checkpoint_dir(spark).rstrip('/')}/streams/{name}"
    w = (df.writeStream.queryName(name).outputMode(output_mode).format(sink)
         .option("checkpointLocation", location))
    if path:
        w = w.option("path", path)
    return w.start()
