"""Cutting lineage with reliable checkpoints.

An intermediate result that is read more than once, or that ends a long plan,
is written to the session's checkpoint folder, so that a lost executor only
recomputes work since then.  An eager reliable checkpoint computes the frame
and writes it in one pass, so nothing is persisted around it.  Frames whose
hash partitioning the next step relies on are stored as buckets instead
(:mod:`textgraph.plans.buckets`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from textgraph.session import checkpoint_dir


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once, write it to the checkpoint folder and return a
    frame that reads from there."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
