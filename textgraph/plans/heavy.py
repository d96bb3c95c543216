"""Heavy keys, and a partition function that knows them.

A key that makes up a large share of all rows overloads the one partition it
is hashed to.  ``heavy_keys`` finds such keys without shuffling the key space:
every task keeps a frequent-items sketch of bounded size, the sketches are
merged, and only the few candidates they name are then counted exactly.  A
sketch that tracks ``16 / share`` items reports every key above ``share`` of
the rows, so the exact count loses none.

``with_partition`` sends a key to one partition -- a hash of the key -- unless
it is heavy; a heavy key's rows go to ``ceil(n / (share * rows))`` consecutive
partitions, dealt by a second column.  The function depends on values only (the
hash is the first 32 bits of MD5), so every run and every engine agrees.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAVY_SHARE = 1 / 256
_LEAST_TRACKED, _MOST_TRACKED = 1024, 1_000_000


def heavy_keys(df: DataFrame, key: str, share: float = HEAVY_SHARE) -> tuple[DataFrame, int]:
    """``(key, n)`` of the string keys that hold more than ``share`` of the
    non-null keyed rows (at most ``1 / share`` keys), and the number of those rows."""
    tracked = min(_MOST_TRACKED, max(_LEAST_TRACKED, math.ceil(16 / share)))
    if 16 / share > _MOST_TRACKED:
        raise ValueError(f"share below {16 / _MOST_TRACKED}")
    keyed = df.where(F.col(key).isNotNull()).select(F.col(key).alias("k"))
    top = keyed.agg(F.expr(f"approx_top_k(k, {tracked // 4}, {tracked})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    spark, total = df.sparkSession, int(top.n)
    names = [r["item"] for r in top.top or []]
    if not names:
        return spark.range(0).select(F.lit("").alias(key), F.lit(0).cast("bigint").alias("n")), total
    few = spark.range(1).select(F.explode(F.array(*[F.lit(x) for x in names])).alias("k"))
    exact = keyed.join(F.broadcast(few), "k", "left_semi").groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    return exact.where(F.col("n") > share * total).select(F.col("k").alias(key), "n"), total


def key_hash(key: Column) -> Column:
    """Unsigned 32 bits of the key's MD5 (bigint)."""
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("bigint")


def with_partition(df: DataFrame, key: str, spread: Column, partitions: int, heavy: tuple[DataFrame, int] | None = None,
                   share: float = HEAVY_SHARE, part: str = "part") -> DataFrame:
    """``df`` plus ``part`` (int, 0 to ``partitions`` - 1); a heavy key's rows are dealt
    by a hash of ``spread`` as text.  ``heavy`` is the result of :func:`heavy_keys` on
    ``df``, where the caller has it already."""
    found, total = heavy or heavy_keys(df, key, share)
    fans = found.select(F.col(key).alias("_heavy"), F.ceil(F.col("n") / F.lit(max(share * total, 1.0))).alias("_fan"))
    turn = F.when(F.col("_fan") > 1, F.pmod(key_hash(F.coalesce(spread.cast("string"), F.lit(""))), F.least("_fan", F.lit(partitions))))
    # at most 1 / share heavy keys, so their side is bounded
    met = df.join(F.broadcast(fans), F.col(key) == F.col("_heavy"), "left")
    return met.withColumn(part, F.pmod(key_hash(F.col(key)) + F.coalesce(turn, F.lit(0)), F.lit(partitions)).cast("int")).drop("_heavy", "_fan")
