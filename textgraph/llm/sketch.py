"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch keeps every distinct shingle hash below ``FRACTION`` of the 64-bit
range; where none falls below, the single smallest hash stands in, so only a
text without words has an empty sketch.  Because the threshold is the same
for every document, sketches of very unequal documents compare directly --
the kept hashes of A that are in B's sketch estimate how much of A is in B --
and the sketch of a union is the union of sketches (``merge_sketches``).

A shingle is five consecutive words; a text of fewer words is one shingle,
its whole sequence.  All columns are built-in functions.

``edited_fingerprints`` compares each document with an edited version of
itself that ends in the next document's beginning, and with that next
document.  The order of the table is found from the ids alone
(``whole_order``); texts are shuffled once, keyed by (id, text hash), and
what travels to the preceding document is only the needed beginning and the
next document's sketch.

Defined cases: a null text is empty; null ids come first; rows that repeat
both id and text are one document and get the same result each; rows that
share an id but not the text are ordered by text hash; a single document is
its own next; an empty table gives no rows; two texts without words have
likeness 1, a text without words and any other 0; a very long text costs time
and memory in proportion to its words; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textgraph.llm.common import durable, whole_order, word_array

SHINGLE = 5
FRACTION = 1 / 8


def shingle_hashes(words: Column, n: int = SHINGLE) -> Column:
    """64-bit hashes of the word shingles; fewer than ``n`` words: of the whole sequence."""
    at = lambda i: F.xxhash64(*[F.get(words, i + F.lit(j)) for j in range(n)])
    return (F.when(F.size(words) >= n, F.transform(F.sequence(F.lit(0), F.size(words) - n), at))
            .when(F.size(words) > 0, F.array(F.xxhash64(words)))
            .otherwise(F.array().cast("array<bigint>")))


def below_threshold(hashes: Column, fraction: float = FRACTION) -> Column:
    """The sketch of a set of hashes, ascending."""
    limit = F.lit(-(1 << 63) + int(fraction * (1 << 64)))
    kept = F.array_distinct(F.filter(hashes, lambda h: h < limit))
    return F.when(F.size(hashes) == 0, hashes).when(F.size(kept) > 0, F.array_sort(kept)).otherwise(
        F.array(F.array_min(hashes)))


def with_sketch(docs: DataFrame, text: str = "text", out: str = "sketch", n: int = SHINGLE,
                fraction: float = FRACTION) -> DataFrame:
    """``docs`` plus the sketch of ``text``, an ascending array<bigint>."""
    words = docs.withColumn("_words", word_array(F.col(text)))
    hashed = words.withColumn("_hashes", shingle_hashes(F.col("_words"), n)).drop("_words")
    return hashed.withColumn(out, below_threshold(F.col("_hashes"), fraction)).drop("_hashes")


def merge_sketches(df: DataFrame, key: str, sketch: str = "sketch", fraction: float = FRACTION) -> DataFrame:
    """One sketch per key: that of all its documents together.  The sketches are
    fixed first: Spark moves a filter on their size below an explode, and would
    compute them again for it."""
    each = durable(df.select(key, sketch)).select(key, F.explode(sketch).alias("h")).distinct()
    return each.groupBy(key).agg(below_threshold(F.collect_set("h"), fraction).alias(sketch))


def common(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of shingles that two documents have in common (Jaccard)."""
    union = F.size(a) + F.size(b) - common(a, b)
    return F.when(union == 0, F.lit(1.0)).otherwise(common(a, b) / union)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the shingles of ``a`` that are in ``b``."""
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(common(a, b) / F.size(a))


def fingerprint_text(sketch: Column) -> Column:
    """The sketch as text: 16 hexadecimal digits per hash, ascending."""
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


_KEY = ["did", "dnull", "th"]    # a document: its id (split so that nulls join) and its text's hash


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, in_edited, in_next)`` of each row: ``near_*`` are
    likenesses, ``in_*`` how much of the document is in the other text."""
    docs = docs.select(F.coalesce("doc_id", F.lit(0)).alias("did"), F.col("doc_id").isNull().alias("dnull"),
                       F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"),
                       F.coalesce("text", F.lit("")).alias("text"))
    order = durable(whole_order(docs.select(F.expr("not dnull").alias("named"), *_KEY,
                                            F.length("text").alias("n")), "named", "did", "th"))
    total = order.count()
    before = order.select(*[F.col(c).alias("to_" + c) for c in _KEY],
                          F.floor(F.col("n") / 4).cast("int").alias("q"),
                          F.pmod(F.col("ordinal") + 1, F.lit(max(total, 1))).alias("ordinal"))
    asks = order.join(before, "ordinal").select(*_KEY, *["to_" + c for c in _KEY], "q")

    sketched = with_sketch(docs)
    answers = (asks.join(sketched, _KEY)
               .select(*[F.col("to_" + c).alias(c) for c in _KEY],
                       F.substring(F.col("text"), F.lit(1), F.col("q")).alias("head"),
                       F.col("sketch").alias("next_sketch"))
               # rows that repeat id and text answer alike
               .groupBy(*_KEY).agg(F.first("head").alias("head"), F.first("next_sketch").alias("next_sketch")))
    both = sketched.join(answers, _KEY)
    n = F.length("text")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - F.floor(n / 4).cast("int")), F.col("head"))
    both = with_sketch(both.withColumn("edited", edited), "edited", "edited_sketch")
    own, other, after = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    return both.select(
        F.when(~F.col("dnull"), F.col("did")).alias("doc_id"), n.cast("bigint").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint_text(own).alias("fingerprint"), fingerprint_text(other).alias("edited_fingerprint"),
        likeness(own, other).alias("near_edited"), likeness(own, after).alias("near_next"),
        containment(own, other).alias("in_edited"), containment(own, after).alias("in_next"))
