"""Text counting operators: word count, line count, bigram count and the
counters the reference writes next to them.

Two input shapes are accepted:

* **line streams** from :func:`textgraph.sources.lines.read_lines` -- one
  row per line, with ``file``/``block_start``/``rid`` telling the order;
* **unit tables** -- one row per unit (e.g. a document) whose text may hold
  many lines; the unit is the analogue of a file.

Every count is ``explode`` + ``groupBy().agg(count)``, so Spark plans a
partial (map-side) aggregate before the shuffle and a final one after it:
a token that makes up a third of the input is collapsed to one row per task
before it is exchanged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textgraph.functions.text import (
    BIGRAM_SEPARATOR,
    LINE_TOTAL_KEY,
    SPLIT_TOTAL_KEY,
    adjacent_tokens,
    first_token_of,
    last_token_of,
    lines_in,
    tokens,
)


def tokenize(df: DataFrame, text: str = "text", keep: Sequence[str] = (),
             token: str = "token", pos: str = "pos") -> DataFrame:
    """One row per token: ``(*keep, pos, token)``, ``pos`` counted from 0
    inside the row (bigint)."""
    return df.select(*keep, F.posexplode(tokens(text)).alias(pos, token)) \
        .withColumn(pos, F.col(pos).cast("bigint"))


def word_count(df: DataFrame, text: str = "value", word: str = "word",
               n: str = "n") -> DataFrame:
    """``(word, n)``: occurrences of every token (case-sensitive)."""
    return (df.select(F.explode(tokens(text)).alias(word))
            .groupBy(word).agg(F.count(F.lit(1)).alias(n)))


def line_count(df: DataFrame, text: str = "value", rows_are_lines: bool = True,
               n: str = "n") -> DataFrame:
    """One row ``(n)``: number of lines, blank lines included.

    For a line stream every row is a line; for a unit table the lines of
    each text are counted by the line reader's rules.
    """
    if rows_are_lines:
        return df.agg(F.count(F.lit(1)).alias(n))
    return df.agg(F.coalesce(F.sum(lines_in(text)), F.lit(0)).cast("bigint").alias(n))


def word_count_with_total(df: DataFrame, text: str = "value",
                          rows_are_lines: bool = True, word: str = "word",
                          n: str = "n") -> DataFrame:
    """Word count plus the row ``(LINE_TOTAL_KEY, number of lines)``.

    As in the reference every row emits its own line count under the key
    next to its tokens, so one scan and one shuffle serve both; a real token
    equal to the key merges with it.  A null text has no tokens; as a row of a
    line stream it is a line all the same, as a unit it has none.
    """
    per_row = F.lit(1).cast("bigint") if rows_are_lines else F.coalesce(lines_in(text), F.lit(0))
    counted = df.select(F.coalesce(tokens(text), F.array().cast("array<string>")).alias("_t"), per_row.alias("_lines"))
    # the key goes behind a row's tokens and carries its lines, a token carries 1
    each = counted.select(
        F.posexplode(F.concat("_t", F.array(F.lit(LINE_TOTAL_KEY)))).alias("_pos", word), F.size("_t").alias("_n"), "_lines")
    return (each.groupBy(word)
            .agg(F.sum(F.when(F.col("_pos") == F.col("_n"), F.col("_lines")).otherwise(F.lit(1))).cast("bigint").alias(n)))


# ---------------------------------------------------------------------------
# bigrams


def _pairs(df: DataFrame, text: str, bigram: str) -> DataFrame:
    """One row per pair of consecutive tokens of each row.  The token array
    is projected first: the pair expression reads it twice, and inside a
    generator Spark would otherwise split the text each time."""
    return (df.select(tokens(text).alias("_t"))
            .select(F.explode(adjacent_tokens("_t")).alias("_p"))
            .select(F.concat("_p.a", F.lit(BIGRAM_SEPARATOR), "_p.b").alias(bigram)))


def bigram_count(df: DataFrame, text: str = "text", bigram: str = "bigram",
                 n: str = "n") -> DataFrame:
    """``(bigram, n)`` for a unit table: pairs of consecutive tokens inside
    each row's whole text (so pairs cross line breaks but never units)."""
    return (_pairs(df, text, bigram)
            .groupBy(bigram).agg(F.count(F.lit(1)).alias(n)))


def _line_pairs(lines: DataFrame, text: str, file: str, block: str, rid: str, bigram: str,
                splits: bool) -> DataFrame:
    """:func:`bigram_pairs_lines`; with ``splits`` every split (whose file and block
    are not null) gives a row ``SPLIT_TOTAL_KEY`` besides, also one without tokens."""
    inner = _pairs(lines, text, bigram)

    ends = lines.select(F.col(file).alias("_f"), F.col(block).alias("_b"), F.col(rid).alias("_r"),
                        F.nullif(first_token_of(text), F.lit("")).alias("_first"),
                        F.nullif(last_token_of(text), F.lit("")).alias("_last"))
    if not splits:
        ends = ends.where(F.col("_first").isNotNull())
    ends = ends.repartition("_f", "_b")         # one exchange for the window and the ends of splits
    joined = F.concat("_p", F.lit(BIGRAM_SEPARATOR), "_first")      # null if either is
    before = F.expr("lag(_last) IGNORE NULLS OVER (PARTITION BY _f, _b ORDER BY _r)")
    across_lines = ends.select("_first", before.alias("_p")).select(joined.alias(bigram)).where(F.col(bigram).isNotNull())

    held = F.when(F.col("_first").isNotNull(), F.col("_r"))
    per_split = ends.groupBy("_f", "_b").agg(F.min_by("_first", held).alias("_first"), F.max_by("_last", held).alias("_last"))
    # the nearest split before that has a token
    before = F.expr("lag(_last) IGNORE NULLS OVER (PARTITION BY _f ORDER BY _b)")
    named = F.col("_f").isNotNull() & F.col("_b").isNotNull()
    each = [joined, *([F.when(named, F.lit(SPLIT_TOTAL_KEY))] if splits else [])]
    across_splits = (per_split.select("_f", "_b", "_first", before.alias("_p"))
                     .select(F.explode(F.array(*each)).alias(bigram)).where(F.col(bigram).isNotNull()))
    return inner.unionByName(across_lines).unionByName(across_splits)


def bigram_pairs_lines(lines: DataFrame, text: str = "value", file: str = "file_path",
                       block: str = "block_start", rid: str = "rid",
                       bigram: str = "bigram") -> DataFrame:
    """One row per bigram occurrence of a line stream, the whole file being
    one token sequence (pairs cross line breaks and split borders).

    Three parts, each parallel:

    1. pairs inside a line -- tokenised on the scan, no shuffle;
    2. pairs across lines of one input split -- ``lag`` of the last token of
       the previous token-bearing line, windowed by (file, split), so one
       window holds at most one split's lines, and only their end tokens;
    3. pairs across split borders -- ``lag`` over one row per split, windowed
       by file, so a huge file contributes one small row per split.

    Parts 2 and 3 cut the first and last token out of a line instead of splitting
    the whole line again.  They share one scan and one shuffle of these tokens.  Part 3
    needs no window over lines: a split's end tokens are a ``min_by`` and a ``max_by``.

    Bounds: a window of part 2 holds the lines of one split.  A file that
    cannot be split (compressed text) is a single split, so such a file's lines
    (two tokens each) are one window group; recompress large ones to a splittable form.
    """
    return _line_pairs(lines, text, file, block, rid, bigram, splits=False)


def bigram_count_lines(lines: DataFrame, text: str = "value", file: str = "file_path",
                       block: str = "block_start", rid: str = "rid",
                       bigram: str = "bigram", n: str = "n") -> DataFrame:
    """``(bigram, n)`` for a line stream (see :func:`bigram_pairs_lines`)."""
    return (bigram_pairs_lines(lines, text, file, block, rid, bigram)
            .groupBy(bigram).agg(F.count(F.lit(1)).alias(n)))


def input_unit_count(df: DataFrame, units: Sequence[str] = ("file_path", "block_start"),
                     n: str = "n") -> DataFrame:
    """One row ``(n)``: number of distinct input units -- input splits
    ``(file_path, block_start)`` for a line stream (the reference's map
    tasks), or a key column such as ``doc_id`` for a unit table."""
    return df.agg(F.count_distinct(*[F.col(u) for u in units]).alias(n))


def bigram_count_with_total(df: DataFrame, text: str = "text", units: Sequence[str] = ("doc_id",),
                            bigram: str = "bigram", n: str = "n") -> DataFrame:
    """Bigram count of a unit table plus ``(SPLIT_TOTAL_KEY, units)``.

    The unit count reads only the key column(s), so the second scan is
    pruned to them; a real bigram equal to the key merges with it.
    """
    pairs = _pairs(df, text, bigram).select(bigram, F.lit(1).cast("bigint").alias("_v"))
    total = input_unit_count(df, units, "_v").select(F.lit(SPLIT_TOTAL_KEY).alias(bigram), "_v")
    return (pairs.unionByName(total).groupBy(bigram)
            .agg(F.sum("_v").cast("bigint").alias(n)))


def bigram_count_lines_with_total(lines: DataFrame, text: str = "value",
                                  file: str = "file_path", block: str = "block_start",
                                  rid: str = "rid", bigram: str = "bigram",
                                  n: str = "n") -> DataFrame:
    """Line-stream bigram count plus ``(SPLIT_TOTAL_KEY, input splits)``.  The splits
    are counted where their end tokens meet, so the lines are not read for them again."""
    pairs = (_line_pairs(lines, text, file, block, rid, bigram, splits=True)
             .select(bigram, F.lit(1).cast("bigint").alias("_v")))
    least = lines.sparkSession.range(1).select(F.lit(SPLIT_TOTAL_KEY).alias(bigram), F.lit(0).cast("bigint").alias("_v"))
    return (pairs.unionByName(least).groupBy(bigram)
            .agg(F.sum("_v").cast("bigint").alias(n)))
