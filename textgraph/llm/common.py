"""What several operators share: words, whole-table order, model tables.

A *word* is a maximal run of bytes other than ASCII white space (``\\x20``,
``\\x09``-``\\x0D``); ``bytes.split()`` and the pattern below agree on that.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textgraph.plans.lineage import materialize
from textgraph.sources.tables import table

WORD_GAP = r"[ \t\n\x0B\f\r]+"
_SPACES = " \t\n\x0b\x0c\r"
LONG_WORD = 256             # bytes (or signs); what a worker remembers of words leaves longer ones out
SAMPLE_PARTITIONS = 64      # of the labelled rows that a model is learned from
_LOW_BITS = (1 << 33) - 1   # monotonically_increasing_id: partition << 33 | row


_remembered: dict = {}


def remember_for(operator: str, forget: Callable[[], None]) -> None:
    """To be called as a task begins that remembers words beyond its end: what the
    worker process still remembers for another operator is dropped, so workers that
    live through several stages hold the words of one."""
    if _remembered.get("operator", operator) != operator:
        _remembered["forget"]()
    _remembered.update(operator=operator, forget=forget)


def documents(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(*(cols or ("doc_id", "text")))


def durable(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder."""
    return materialize(df)


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id's decimal text falls in ``fold``; a null id does not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def word_total(text: Column) -> Column:
    """Number of words (bigint); a null text has none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(_SPACES))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, WORD_GAP))).cast("bigint")


def word_array(text: Column) -> Column:
    """The words in order; a null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_GAP), lambda w: w != "")


def word_blocks(data: bytes | None, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a text in consecutive lists, each from about ``size``
    bytes, so that a very long text is never one huge list."""
    if not data:
        return
    if len(data) <= size:
        if words := data.split():
            yield words
        return
    rest, at = b"", 0
    while at < len(data):
        piece = rest + data[at:at + size]
        at += size
        if at < len(data) and not piece[-1:].isspace():
            words = piece.split()
            rest = words.pop() if words else piece
        else:
            words, rest = piece.split(), b""
        if words:
            yield words
    if rest:
        yield rest.split()


def whole_order(df: DataFrame, *cols: str, out: str = "ordinal") -> DataFrame:
    """The distinct rows of ``df`` numbered 0.. in ascending order of
    ``cols``: range partitions, positions inside them, and one offset per
    partition (a table bounded by the partition count)."""
    rows = durable(df.distinct().repartitionByRange(*cols).sortWithinPartitions(*cols)
                   .select("*", F.spark_partition_id().alias("_pid"),
                           F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW_BITS)).alias("_pos")))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (rows.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
               .select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")))
    return (rows.join(F.broadcast(offsets), "_pid")
            .withColumn(out, F.col("_off") + F.col("_pos")).drop("_pid", "_pos", "_off"))


def free_name(columns: list[str], name: str) -> str:
    """``name``, with underscores in front until no column has it (case aside, as Spark compares names)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def small_side(df: DataFrame, most: int) -> DataFrame:
    """``df`` with a broadcast hint if a count finds at most ``most`` rows."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def hashed_sample(df: DataFrame, key: Column, most: int, *order: str) -> DataFrame:
    """At most ``most`` rows of ``df``: the smallest by a hash of ``key``, then by
    ``order``.  A count sets a hash bound that about a fifth more rows meet, so
    no more than those are ever sorted or sent anywhere."""
    hashed = df.withColumn("_hash", F.xxhash64(key).bitwiseAND(F.lit((1 << 62) - 1)))
    total = df.count()
    if total > most:
        hashed = hashed.where(F.col("_hash") < int((1 << 62) * min(1.0, (1.2 * most + 100) / total)))
    return hashed.orderBy("_hash", *order).limit(most).drop("_hash")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int,
                    folds: int = 5, fold: int = 0) -> DataFrame:
    """``(doc_id, text, y)`` of at most ``most`` labelled rows outside the
    held-out fold, chosen by a hash of the id.  Rows that repeat id and label count
    once, and an id with several texts gives the one of the smallest hash, so one id
    can neither crowd the others out nor swell the sample.  The bound makes the
    chosen labels broadcastable, so only the chosen texts are shuffled."""
    usable = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()
                           & ~held_out(F.col("doc_id"), folds, fold))
              .select("doc_id", F.col(label).cast("int").alias("y")).distinct())
    chosen = hashed_sample(usable, F.col("doc_id"), most, "doc_id", "y")
    met = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    one = met.groupBy("doc_id", "y").agg(F.min(F.struct(F.xxhash64("text").alias("h"), F.col("text").alias("text"))).alias("t"))
    # in small partitions whatever the session coalesces, as the texts become many features in a worker
    return one.select("doc_id", "t.text", "y").repartition(SAMPLE_PARTITIONS, "doc_id")
