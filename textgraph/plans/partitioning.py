"""Input parallelism.

A scan has as many partitions as its input splits.  A large table stored
in many files or row groups needs nothing; a table stored as one or a few
unsplittable row groups would run all per-row work (tokenising, pairing,
partial aggregation) in as many tasks.  ``spread_coarse`` then hashes the
rows over the session's cores by a key.  That shuffles the input once, so it
is done only for inputs of at most ``SPREAD_BYTES`` (Spark's own size
estimate of the scan); a larger table is read by the splits it has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

SPREAD_BYTES = 8 << 30


def spread_coarse(df: DataFrame, keys: Sequence[str], most_bytes: int = SPREAD_BYTES) -> DataFrame:
    try:
        cores = df.sparkSession.sparkContext.defaultParallelism
        splits = df.rdd.getNumPartitions()      # plans the scan, runs no job
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:                           # e.g. a remote (Connect) session
        return df
    if splits >= cores or size > most_bytes:
        return df
    return df.repartition(cores, *keys)
