"""Readers for the reference's graph text formats (pure column expressions).

* edge list: ``src dst`` split on whitespace, extra fields ignored;
* adjacency + rank: ``ID<ws>EDGES|RANK`` with ``EDGES`` a ``,`` list or
  ``NULL``; an empty list is read as dangling too;
* search graph: ``ID<TAB>EDGES|WEIGHTS|DISTANCE|COLOR``, lists may end in
  ``,``, ``Integer.MAX_VALUE`` for an unreached distance.

Blank lines are skipped.  ``strict=True`` fails the job on any other
malformed row -- too few fields, a malformed number, lists of unequal
length, an unknown colour -- whatever the session's ANSI setting;
``strict=False`` drops the whole row instead.  No row is altered.

Every line is split once: each level of splitting is a projection of its own,
read by several columns (so Spark keeps it), and the parsed row comes out of a
generator of one element.  The optimizer moves no filter through a generator
whose output it reads, so neither the check nor a later filter repeats the parse.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textgraph.functions.graph import NO_EDGES, UNREACHED, color_code

_NOT_BLANK = r"\S"


def _lines(lines: DataFrame, value: str) -> DataFrame:
    return lines.select(F.col(value).alias("_line")).where(F.col("_line").rlike(_NOT_BLANK))


def _fields(lines: DataFrame, value: str) -> DataFrame:
    """``(_line, _f)``: the fields of each line that is not blank."""
    return _lines(lines, value).select("_line", F.array_remove(F.split(F.col("_line"), "\\s+"), "").alias("_f"))


def _numbers(items: Column) -> Column:
    """array<bigint> of the non-empty items; a malformed item is NULL."""
    return F.array_remove(items, "").try_cast("array<bigint>")


def _checked(parsed: DataFrame, cols: dict[str, Column], bad: Column, strict: bool) -> DataFrame:
    """The columns of every well-formed row; ``bad`` (on those columns) tells the others."""
    row = F.struct(F.col("_line"), *[c.alias(k) for k, c in cols.items()])
    rows = parsed.select(F.inline(F.array(row)))
    bad = F.coalesce(bad, F.lit(True))
    if strict:      # in the filter, so that no column pruning can lose the check
        fails = F.raise_error(F.concat(F.lit("malformed row: "), F.col("_line"))).cast("boolean")
        return rows.where(F.when(bad, fails).otherwise(F.lit(True))).select(*cols)
    return rows.where(~bad).select(*cols)


def _any_null(items: Column) -> Column:
    return F.exists(items, lambda x: x.isNull())


def parse_edge_list(lines: DataFrame, value: str = "value", id_type: str = "bigint",
                    strict: bool = True) -> DataFrame:
    """``(src, dst)`` from ``src dst`` lines; further fields are ignored."""
    at = lambda i: F.get("_f", F.lit(i)).try_cast(id_type)
    return _checked(_fields(lines, value), {"src": at(0), "dst": at(1)},
                    F.col("src").isNull() | F.col("dst").isNull(), strict)


def parse_adjacency(lines: DataFrame, value: str = "value", strict: bool = True) -> DataFrame:
    """``(id bigint, out array<bigint>, rank double)``; ``out`` is NULL for
    a dangling node."""
    parts = _fields(lines, value).select("_line", F.get("_f", F.lit(0)).alias("_id"),
                                         F.split(F.get("_f", F.lit(1)), "\\|").alias("_p"))
    edges = F.get("_p", F.lit(0))
    lists = parts.select("_line", "_id", edges.alias("_edges"), F.get("_p", F.lit(1)).alias("_rank"),
                         _numbers(F.split(edges, ",")).alias("_items"))
    cols = {"id": F.col("_id").try_cast("bigint"),
            "out": F.when((F.col("_edges") != F.lit(NO_EDGES)) & (F.size("_items") > 0), F.col("_items")),
            "rank": F.col("_rank").try_cast("double")}
    bad = (F.col("id").isNull() | F.col("rank").isNull()
           | F.coalesce(_any_null(F.col("out")), F.lit(False)))
    return _checked(lists, cols, bad, strict)


def parse_search_graph(lines: DataFrame, value: str = "value", strict: bool = True) -> DataFrame:
    """``(id bigint, out array<struct<dst bigint, w bigint>>, dist bigint,
    color int)``; ``dist`` NULL = unreached, colours 0/1/2."""
    pair = _lines(lines, value).select("_line", F.split("_line", "\t", 2).alias("_kv"))
    parts = pair.select("_line", F.get("_kv", F.lit(0)).alias("_id"), F.split(F.get("_kv", F.lit(1)), "\\|").alias("_p"))
    at = lambda i: F.get("_p", F.lit(i))
    raw = _checked(parts, {
        "id": F.col("_id").try_cast("bigint"), "_dsts": _numbers(F.split(at(0), ",")), "_ws": _numbers(F.split(at(1), ",")),
        "dist": at(2).try_cast("bigint"), "_unreached": at(2) == F.lit(UNREACHED), "color": color_code(at(3))},
        F.col("id").isNull() | F.col("_unreached").isNull() | (F.col("dist").isNull() & ~F.col("_unreached"))
        | F.col("color").isNull() | (F.col("color") < 0) | (F.size("_dsts") != F.size("_ws"))
        | _any_null(F.col("_dsts")) | _any_null(F.col("_ws")), strict)
    out = F.arrays_zip(F.col("_dsts").alias("dst"), F.col("_ws").alias("w"))
    return raw.select("id", out.alias("out"), "dist", "color")
