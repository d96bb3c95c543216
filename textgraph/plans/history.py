"""Per-iteration results as one table partitioned by iteration.

A history is a folder with an ``iteration=k`` partition per iteration.  Writing an
iteration replaces that partition alone, so the same path can be used again;
reading is one scan of the table, pruned to the iterations of this run.  A
path given by the caller is a snapshot that a later run can continue from;
without one the table is in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from textgraph.plans.buckets import shared_path


class History:
    """Collects ``(iteration, *columns)`` of iterations 1..k, if there is a
    path or ``keep`` is set."""

    def __init__(self, spark: SparkSession, path: str | None, columns: list[str], keep: bool) -> None:
        self.given, self.columns = path, columns
        self.path = path.rstrip("/") if path else shared_path(spark, "history") if keep else None

    def add(self, k: int, rows: DataFrame) -> None:
        if self.path:
            rows.select(*self.columns).write.mode("overwrite").parquet(f"{self.path}/iteration={k}")

    def _table(self, spark: SparkSession, like: DataFrame) -> DataFrame:
        fields = [StructField(c, like.schema[c].dataType) for c in self.columns]
        return spark.read.schema(StructType([*fields, StructField("iteration", IntegerType())])).parquet(self.path)

    def restart(self, like: DataFrame, k: int) -> DataFrame:
        """The rows of iteration ``k``, written by an earlier run."""
        if not self.given:
            raise ValueError("resume_from needs snapshot_path")
        return self._table(like.sparkSession, like).where(F.col("iteration") == k).select(*self.columns)

    def rows(self, like: DataFrame, iters: int) -> DataFrame:
        """All iterations 1..iters; ``like`` gives the types."""
        if not iters:
            return like.where(F.lit(False)).select(F.lit(0).alias("iteration"), *self.columns)
        table = self._table(like.sparkSession, like)
        return table.where(F.col("iteration").between(1, iters)).select("iteration", *self.columns)
