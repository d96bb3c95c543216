"""Column expressions for graph records: colours, list parsing, printing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values of the reference's text formats.
# Search colours, in order of darkness (compared by this order):
WHITE, GRAY, BLACK = 0, 1, 2
COLOR_NAMES = ("WHITE", "GRAY", "BLACK")
# Edge list of a dangling node in the adjacency + rank format:
NO_EDGES = "NULL"
# Distance of an unreached node in the search format:
UNREACHED = "Integer.MAX_VALUE"
# ---------------------------------------------------------------------------


def color_name(c: Column | str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.element_at(F.array(*[F.lit(x) for x in COLOR_NAMES]), col + 1)


def color_code(name: Column | str) -> Column:
    col = F.col(name) if isinstance(name, str) else name
    return (F.array_position(F.array(*[F.lit(x) for x in COLOR_NAMES]), col) - 1).cast("int")


def parse_number(text: Column, typ: str, strict: bool = True) -> Column:
    """``text`` as ``typ``; a malformed value fails the job when ``strict``
    (whatever the session's ANSI setting), else becomes NULL."""
    val = text.try_cast(typ)
    if not strict:
        return val
    return F.when(val.isNull() & text.isNotNull(),
                  F.raise_error(F.concat(F.lit("malformed number: "), text))).otherwise(val)


def int_list(text: Column, sep: str = ",", strict: bool = True) -> Column:
    """array<bigint> of the non-empty items of ``text`` split on ``sep``.
    Strict parsing fails the job on a malformed item; otherwise a malformed
    item becomes NULL."""
    items = F.filter(F.split(text, sep), lambda s: s != F.lit(""))
    return F.transform(items, lambda s: parse_number(s, "bigint", strict))


def joined_list(arr: Column, sep: str = ",", trailing: bool = False) -> Column:
    """Items of ``arr`` joined by ``sep``; with ``trailing`` every item is
    followed by ``sep`` (the search format)."""
    if trailing:
        return F.array_join(F.transform(arr, lambda x: F.concat(x.cast("string"), F.lit(sep))), "")
    return F.array_join(F.transform(arr, lambda x: x.cast("string")), sep)
