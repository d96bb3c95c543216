"""Mixing sources to target weights.

Words are summed per source (map-side combined, one row per source), the
targets share all words by weight, no target passing ``MOST`` times its
source: what a capped source cannot take is shared again by weight among the
others until none is above its cap.  A document of a source with repetition
rate ``r = target / source words`` is emitted ``floor(r)`` times, plus once
more if a number in [0, 1) hashed from the seed and its id is below the
fraction of ``r`` -- a Bernoulli copy that reruns and lost tasks repeat
exactly.

Only the per-source table is joined to the documents; it is broadcast when a
count finds at most ``BROADCAST_SOURCES`` sources, else joined by shuffle.

Defined cases: a null text has no words; null sources form one source, last
in order; a source without words has target and rate 0; an empty table gives
no rows; repeated rows draw the same number and each counts; a null id draws
as the empty string.  Input columns called as a new one (size, source_size,
target, copies, taken) are kept if the new ones get a prefix, else replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textgraph.llm.common import durable, free_name, small_side, whole_order, word_total

WEIGHTS = (1, 2, 3)        # by the source's place in code-point order, repeating
MOST = 3                   # no target above this many times its source
BROADCAST_SOURCES = 10_000
SEED = "mix-1"


def source_targets(totals: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """``totals``: (source, source_size), a row per source.  Adds ``target``."""
    named = totals.where(F.col("source").isNotNull())
    ranks = whole_order(named.select("source"), "source", out="place")
    last = ranks.count()
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.pmod("place", F.lit(len(weights))) + 1).cast("int"))
    ranked = (named.join(ranks, "source").unionByName(
        totals.where(F.col("source").isNull()).withColumn("place", F.lit(last).cast("bigint")))
        .select("source", "source_size", weight.alias("weight")))
    ranked = durable(ranked)
    whole = ranked.agg(F.sum("source_size")).first()[0] or 0
    share = 0.0
    while True:            # scalars only; the set of capped sources grows each time
        above = F.col("weight") * F.lit(share) > F.col("source_size") * most
        free, used = ranked.agg(
            F.sum(F.when(~above, F.col("weight"))), F.sum(F.when(above, F.col("source_size") * most))).first()
        again = (whole - float(used or 0)) / free if free else share
        if again == share:
            break
        share = again
    capped = F.col("source_size") * float(most)
    return ranked.select("source", "source_size", F.least(F.col("weight") * F.lit(share), capped).alias("target"))


def draw(doc_id: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the seed and the id alone."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(1 << 52)


def mix_sources(docs: DataFrame, weights=WEIGHTS, most: int = MOST, seed: str = SEED, prefix: str = "") -> DataFrame:
    """``docs`` (doc_id, text, source, ...) with size, source_size, target,
    copies and taken (named with ``prefix``); ``emit_copies`` writes the
    copies out."""
    fresh = [prefix + c for c in ("size", "source_size", "target", "copies", "taken")]
    size, source_size, target, copies, taken = fresh
    docs = docs.select(*[c for c in docs.columns if c not in fresh])
    sized = docs.withColumn(size, word_total(F.col("text")))
    totals = sized.groupBy("source").agg(F.sum(size).alias("source_size"))
    met = free_name(sized.columns, "_source")
    targets = durable(source_targets(durable(totals), weights, most)).select(
        F.col("source").alias(met), F.col("source_size").alias(source_size), F.col("target").alias(target))
    rate = F.when(F.col(source_size) > 0, F.col(target) / F.col(source_size)).otherwise(F.lit(0.0))
    whole = F.floor(rate)
    extra = (draw(F.col("doc_id"), seed) < rate - whole).cast("bigint")
    return (sized.join(small_side(targets, BROADCAST_SOURCES), F.col("source").eqNullSafe(F.col(met)))
            .drop(met).withColumn(copies, whole + extra).withColumn(taken, F.col(size) * F.col(copies)))


def emit_copies(mixed: DataFrame, copies: str = "copies") -> DataFrame:
    """Each document as often as ``copies`` says."""
    copy = free_name(mixed.columns, "_copy")
    return (mixed.where(F.col(copies) > 0)
            .withColumn(copy, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(copies)))).drop(copy))
