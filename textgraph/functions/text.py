"""Column expressions for text: tokens, adjacent pairs, line counts.

All of them are built-in Catalyst expressions without lambdas (split,
slice, arrays_zip, ...), so they are compiled into the stages that use them;
there is no Python in the per-row path.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values.  They must equal the reference's behaviour for equal results.
#
# Token delimiters: the default set of java.util.StringTokenizer, i.e. space,
# tab, newline, carriage return and form feed.  Runs collapse and there are
# no empty tokens.  \x0B (vertical tab) is NOT a delimiter, so the pattern is
# not "\s+".
TOKEN_DELIMITERS = "[ \\t\\n\\r\\f]+"
_DELIMITER_SET = " \t\n\r\f"
# Line terminators of Hadoop's line reader: "\r\n", "\n", "\r".  The last
# line needs none; a final terminator does not open an empty line.
LINE_TERMINATOR = "\\r\\n|\\n|\\r"
# Counter keys the reference writes next to its counts.  Twenty 'z' for the
# line total of the word count; the bigram count's key for the number of map
# tasks, spelling and trailing blank included.
LINE_TOTAL_KEY = "zzzzzzzzzzzzzzzzzzzz"
SPLIT_TOTAL_KEY = "zzzzzzzzz Times Map task lanched: "
# Separator between the two words of a bigram.
BIGRAM_SEPARATOR = " "
# ---------------------------------------------------------------------------


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def tokens(text: Column | str) -> Column:
    """array<string> of the whitespace-delimited tokens of ``text``
    (case and punctuation kept, never an empty token)."""
    t = F.btrim(_c(text), F.lit(_DELIMITER_SET))       # so no token is empty but that of a blank text
    return F.when(t == F.lit(""), F.array().cast("array<string>")).otherwise(F.split(t, TOKEN_DELIMITERS))


def adjacent_tokens(toks: Column | str) -> Column:
    """array<struct<a, b>> of ``t[i], t[i+1]`` for consecutive tokens."""
    t = _c(toks)
    k = F.greatest(F.size(t) - F.lit(1), F.lit(0))
    return F.arrays_zip(F.slice(t, 1, k).alias("a"), F.slice(t, 2, k).alias("b"))


def lines_in(text: Column | str) -> Column:
    """Number of lines a line reader would return for ``text``: terminators
    plus one for a non-empty unterminated tail (bigint)."""
    t = _c(text)
    parts = F.size(F.split(t, LINE_TERMINATOR))
    closed = (t == F.lit("")) | t.rlike("(\\r\\n|\\n|\\r)$")
    return (parts - F.when(closed, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def _end_token(text: Column | str, end: int) -> Column:
    # cut at the next delimiter of each kind: what is left has none
    t = F.btrim(_c(text), F.lit(_DELIMITER_SET))
    for delimiter in _DELIMITER_SET:
        t = F.substring_index(t, delimiter, end)
    return F.make_valid_utf8(t)       # as split() gives it


def first_token_of(text: Column | str) -> Column:
    """First token of ``text`` without splitting all of it ('' if none)."""
    return _end_token(text, 1)


def last_token_of(text: Column | str) -> Column:
    """Last token of ``text`` without splitting all of it ('' if none)."""
    return _end_token(text, -1)
