"""Dense ordinals of the distinct values of a column, computed in parallel.

The distinct values are range partitioned and sorted inside each partition;
every row takes its position inside its partition from the id that
``monotonically_increasing_id`` gives it there, and adds the number of rows
of all earlier partitions.  Those per-partition totals form one row per
partition -- a size bounded by the partition count, not by the data -- so
they alone are summed in a single window and broadcast back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textgraph.plans.lineage import materialize

_LOW_BITS = (1 << 33) - 1   # monotonically_increasing_id: partition << 33 | row


def dense_ordinal(df: DataFrame, col: str, out: str = "ordinal") -> DataFrame:
    """``(col, out)``: 0-based rank of each distinct non-null value."""
    keys = (df.select(col).where(F.col(col).isNotNull()).distinct()
            .repartitionByRange(col).sortWithinPartitions(col)
            .select(col, F.spark_partition_id().alias("_pid"),
                    F.monotonically_increasing_id().alias("_mid")))
    # fixed once, since both uses below must see the same ids
    keys = materialize(keys)
    sizes = keys.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_pid", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"))
    return (keys.join(F.broadcast(offsets), "_pid")
            .select(col, (F.col("_off") + F.col("_mid").bitwiseAND(F.lit(_LOW_BITS))).alias(out)))
