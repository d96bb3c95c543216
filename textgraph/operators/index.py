"""Term postings and the inverted index.

``term_postings`` is the long, scalable form: one row per (word, unit)
with the term frequency.  ``inverted_index`` renders the reference's
posting text ``unit:n;unit:n;`` -- but never for a whole word at once: a
stop word occurs in nearly every unit, so its list grows with the corpus.
The list of a word is cut into blocks of at most ``block_size`` units
(consecutive in unit order), one row per (word, block).  Concatenating a
word's rows in block order gives exactly the reference's line for it; every
row, and every group Spark has to hold, is bounded by ``block_size``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from textgraph.functions.text import tokens
from textgraph.plans.dense_index import dense_ordinal

BROADCAST_UNITS = 100_000       # units whose ordinals are broadcast; more are joined by shuffle


def term_postings(df: DataFrame, text: str = "value", unit: str = "file",
                  word: str = "word", n: str = "n") -> DataFrame:
    """``(word, unit, n)``: occurrences of each token in each unit.

    One entry per (word, unit) however the unit was split on input (the
    partial aggregate merges the pieces).
    """
    return (df.select(F.explode(tokens(text)).alias(word), F.col(unit))
            .groupBy(word, unit).agg(F.count(F.lit(1)).alias(n)))


def posting_block(posts: DataFrame, unit: str, block_size: int) -> DataFrame:
    """Adds ``block``: units in ascending order, ``block_size`` per block.

    An integral unit is its own ordinal (distinct values, so a block holds
    at most ``block_size`` of them; where ids are sparse, blocks hold fewer);
    any other unit type is first given its dense rank in ascending order by a
    distributed sort.  Block numbers therefore depend on the unit's type, the
    order of blocks does not.  Postings without a unit are left out.
    """
    if block_size < 1:
        raise ValueError("block_size must be positive")
    posts = posts.where(F.col(unit).isNotNull())
    if isinstance(posts.schema[unit].dataType, IntegralType):
        # floor division, exact for any bigint (negative ids included)
        u = f"CAST(`{unit}` AS BIGINT)"
        return posts.withColumn("block", F.expr(f"({u} - pmod({u}, {block_size})) div {block_size}"))
    ordinals = dense_ordinal(posts.select(unit), unit, "_ord")
    if ordinals.limit(BROADCAST_UNITS + 1).count() <= BROADCAST_UNITS:
        ordinals = F.broadcast(ordinals)        # else few units would be few join keys
    return (posts.join(ordinals, unit)
            .withColumn("block", F.expr(f"_ord div {block_size}"))
            .drop("_ord"))


def inverted_index(posts: DataFrame, unit: str = "file", block_size: int = 256,
                   word: str = "word", n: str = "n", postings: str = "postings") -> DataFrame:
    """``(word, block, postings)`` with ``postings`` = ``unit:n;`` for each
    unit of the block in ascending unit order."""
    blocked = posting_block(posts.select(word, unit, n), unit, block_size)
    entry = F.struct(F.col(unit).alias("u"), F.col(n).alias("n"))
    text = F.array_join(
        F.transform(F.sort_array(F.collect_list(entry)),
                    lambda e: F.concat(e["u"].cast("string"), F.lit(":"),
                                       e["n"].cast("string"), F.lit(";"))),
        "")
    return blocked.groupBy(word, "block").agg(text.alias(postings))


def postings_sorted(posts: DataFrame, unit: str = "file", word: str = "word") -> DataFrame:
    """Postings in (word, unit) order: a range-partitioned global sort on
    the composite key, so one hot word spreads over several ranges."""
    return posts.orderBy(word, unit)
