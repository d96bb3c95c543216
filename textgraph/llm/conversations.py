"""Conversation structure repair by an auction on the edit lattice.

A conversation's rows are damaged by a hash (``damaged``) and put in order.
Editing them is a walk through a lattice: a node is (rows passed, state), the
states being those of ``(s?(ua)+)?`` over role initials -- 0 nothing yet, 1 after
``s``, 2 after ``u``, 3 after ``a`` -- and an arc is an edit: keep (0), rerole to user
or assistant (1), delete (2), insert an empty user or assistant (5); keeping or
reroling a truncated row costs 5 more.  As a state admits one of ``u`` and ``a``
only, the initials of the edits say all of a repair.

The cheapest walk is found by Bertsekas' auction algorithm for shortest paths
with integer costs.  Every node has a price, never above its distance to the
end.  A path starts at the origin; if the price of its last node is below the
least cost-plus-price of an arc out of it, the price rises to that and the path
contracts by one node, else the path extends along that arc.  When it reaches the
end the origin's price is its distance.  Prices carry over: the lattice is done
in ``_LAYERS`` layers at a time from the end, so each auction ends at nodes whose
prices are already distances.  Tight arcs (price equals cost plus price) are
then traced in ASCII order of their edits; before one is followed, an auction
from its end node makes that node's price exact.

On Spark, equal rows become one with a count, rows are range partitioned by
(conversation, turn, role, text), and each task reads them as a stream.  A
conversation that lies inside one partition is finished there.  One that crosses
a border, or has more than ``SEGMENT_ROWS`` rows or ``SEGMENT_BYTES`` of text, is cut
into segments: a segment gives its 4 x 4 entry-to-exit distances, those (16 numbers
a segment) are chained per conversation, all segments are traced in parallel from
all four entry states, and the chain of exits picks the trace that holds.  Only the
digest reads a large conversation's text in one task, as a sorted stream of
lines, since a SHA-256 cannot be split.

Defined cases: null role or text is one space, a null turn comes first, a null
``conv_id`` is a conversation; rows of one turn are ordered by role, then text, so
repeated rows are adjacent; an empty role has no initial and cannot be kept.
Conversations whose rows are all dropped give zeros, an empty audit and the
empty string's hash; an empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textgraph.llm.common import durable, small_side

RULE = 20                      # crc32 of "conv_id:turn" modulo this decides the damage
SEGMENT_ROWS, SEGMENT_BYTES = 2048, 4 << 20
SMALL = 200_000                # repeated (conversation, role, text) that may be broadcast
REROLE, DELETE, INSERT, CUT = 1, 2, 5, 5
_LAYERS = 16
_INF = 1 << 60
_SPACES = " \t\n\x0b\x0c\r"
_NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})     # state -> initial -> state
_MADE = (2, 2, 3, 2)                                         # state after a rerole or insert
_ROLE = {2: "user", 3: "assistant"}
_END = [0, 2 * INSERT, INSERT, 0]                            # distance to the end behind the last row
_TAIL = ["", "II", "I", ""]
_TAIL_LINES = ["", "user:\nassistant:", "assistant:", ""]
OK, BLANK, DUPLICATE, TRUNCATED = range(4)


def damaged(rows: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, n)``: distinct damaged rows and how often
    each occurs; a conversation with dropped rows has one row with ``n`` = 0."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    h = F.pmod(F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")), F.lit(RULE))
    r = rows.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), h.alias("h"))
    gone = F.col("h") == 0
    text = (F.when(gone | (F.col("h") == 1), F.lit("")).when(F.col("h") == 2, F.regexp_replace("text", "[.!?]", ""))
            .otherwise(F.col("text")))
    role = F.when(gone, F.lit("")).when(F.col("h") == 4, F.lit("user")).otherwise(F.col("role"))
    n = F.when(gone, 0).when(F.col("h") == 3, 2).otherwise(1)
    return (r.select("conv_id", F.when(~gone, F.col("turn")).alias("turn"), role.alias("role"), text.alias("text"),
                     n.cast("bigint").alias("n"))
            .groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n")))


def ordered(rows: DataFrame) -> DataFrame:
    """``damaged`` rows plus ``again`` (role and text stand in an earlier turn) and
    ``part``, range partitioned and sorted by (conv_id, turn, role, text)."""
    keyed = rows.withColumn("_sha", F.sha2(F.col("text").cast("binary"), 256))
    same = ["conv_id", "role", "_sha"]
    first = (keyed.where("n > 0").groupBy(*same)
             .agg(F.count(F.lit(1)).alias("_k"), F.max(F.col("turn").isNull()).alias("_null"), F.min("turn").alias("_least"))
             .where("_k > 1").select(*[F.col(c).alias("x" + c) for c in same], "_null", "_least"))
    met = keyed.join(small_side(first, SMALL), [F.col(c).eqNullSafe(F.col("x" + c)) for c in same], "left")
    again = F.when(F.col("_null"), F.col("turn").isNotNull()).otherwise(F.col("turn") > F.col("_least"))
    order = ["conv_id", "turn", "role", "text"]
    return (met.select(*order, "n", F.coalesce(again, F.lit(False)).alias("again"))
            .repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()))


# --- the lattice of one segment ----------------------------------------------

class Lattice:
    """``steps`` are ``(initial, truncated)`` of a row that may stay, or the
    number of rows that must go; ``ends`` are the distances behind the last one."""

    def __init__(self, steps: list, ends: list[int]) -> None:
        self.steps, m = steps, len(steps)
        low = min(ends)
        self.price = [[low] * 4 for _ in range(m)] + [list(ends)]
        self.exact = {m}
        for layer in range((m - 1) // _LAYERS * _LAYERS, -1, -_LAYERS):
            for s in range(4):
                self.settle(layer, s)
            self.exact.add(layer)

    def arcs(self, i: int, s: int) -> list[tuple[str, int, int, int]]:
        """(edits, cost, layer, state) out of a node, in ASCII order."""
        step, made = self.steps[i], _MADE[s]
        if isinstance(step, int):
            return [("D" * step, DELETE * step, i + 1, s), ("I", INSERT, i, made)]
        initial, more = step[0], CUT if step[1] else 0
        out = [("D", DELETE, i + 1, s), ("I", INSERT, i, made)]
        if initial in _NEXT[s]:
            out.append(("K", more, i + 1, _NEXT[s][initial]))
        out.append(("R", REROLE + more, i + 1, made))
        return out

    def settle(self, layer: int, state: int) -> None:
        """The auction from one node; afterwards its price is its distance."""
        price, path = self.price, [(layer, state)]
        while True:
            i, s = path[-1]
            if i in self.exact:
                return
            best, to = _INF * 2, None
            for _, cost, j, t in self.arcs(i, s):
                if cost + price[j][t] < best:
                    best, to = cost + price[j][t], (j, t)
            if price[i][s] < best:
                price[i][s] = best
                if len(path) > 1:
                    path.pop()
                elif best >= _INF:
                    return
            else:
                path.append(to)

    def trace(self, state: int) -> tuple[str, int]:
        """(edits, exit state) of the cheapest walk from an entry state, least in ASCII order."""
        i, edits = 0, []
        while i < len(self.steps):
            for label, cost, j, t in self.arcs(i, state):
                if self.price[i][state] != cost + self.price[j][t]:
                    continue
                self.settle(j, t)
                if self.price[i][state] == cost + self.price[j][t]:
                    edits.append(label)
                    i, state = j, t
                    break
        return "".join(edits), state


def distances(steps: list) -> list[int]:
    """16 numbers, entry state by exit state: the cheapest cost; -1 where there is no walk."""
    out = [[-1] * 4 for _ in range(4)]
    for end in (2, 3):          # reached from every state, by inserts if by nothing else
        price = Lattice(steps, [0 if s == end else _INF for s in range(4)]).price[0]
        for s in range(4):
            out[s][end] = price[s] if price[s] < _INF else -1
    # nothing but deletions leads to 0, and from 1 to 1; one kept s and deletions from 0 to 1
    gone = sum(DELETE * (s if isinstance(s, int) else 1) for s in steps)
    out[0][0] = out[1][1] = gone
    kept = [(CUT if cut else 0) - DELETE for initial, cut in (s for s in steps if not isinstance(s, int)) if initial == "s"]
    if kept:
        out[0][1] = gone + min(kept)
    return [x for row in out for x in row]


def steps_of(kinds: list[int], roles: list[str], counts: list[int]) -> list:
    """The lattice's steps of distinct rows and their counts: all but the first of equal rows must go."""
    steps = []
    for kind, role, n in zip(kinds, roles, counts, strict=True):
        if kind in (BLANK, DUPLICATE):
            steps.append(n)
            continue
        steps.append((role[:1], kind == TRUNCATED))
        if n > 1:
            steps.append(n - 1)
    return steps


def repaired_lines(edits: str, state: int, kinds, roles, texts, counts) -> Iterator[str]:
    """``role:text`` of each row that the edits leave, from an entry state."""
    at = iter(edits)
    for kind, role, text, n in zip(kinds, roles, texts, counts, strict=True):
        for copy in range(n):
            edit = next(at)
            while edit == "I":
                state = _MADE[state]
                yield f"{_ROLE[state]}:"
                edit = next(at)
            if edit == "D":
                continue
            if edit == "R":
                state = _MADE[state]
                yield f"{_ROLE[state]}:{text}"
            else:
                state = _NEXT[state][role[:1]]
                yield f"{role}:{text}"
    for _ in at:                # inserts behind the last row
        state = _MADE[state]
        yield f"{_ROLE[state]}:"


# --- segments ----------------------------------------------------------------

_COUNTS = ["blank", "duplicate", "truncated", "illegal"]
_SEGMENT = ("conv_id bigint, part int, seg int, closed boolean, gaps bigint, blank bigint, duplicate bigint, truncated bigint, "
            "illegal bigint, cost bigint, audit string, repaired_sha256 string, least bigint, most bigint, turns bigint, "
            "first string, last string, dist array<bigint>, kinds array<int>, roles array<string>, texts array<string>, "
            "counts array<bigint>")


class _Segment:
    """Rows of one conversation, in order."""

    def __init__(self, conv, part: int, seg: int) -> None:
        self.conv, self.part, self.seg = conv, part, seg
        self.kinds, self.roles, self.texts, self.counts, self.bytes = [], [], [], [], 0
        self.total = dict.fromkeys(_COUNTS, 0)
        self.least = self.most = None
        self.turns, self.first, self.last = 0, None, None

    def add(self, turn, role: str, text: str, n: int, again: bool) -> None:
        if not n:
            return
        shown = text.rstrip(_SPACES)
        kind = (BLANK if not shown else DUPLICATE if again else TRUNCATED if shown[-1] not in ".!?" else OK)
        self.total["blank"] += n if kind == BLANK else 0
        self.total["duplicate"] += n if kind == DUPLICATE else n - 1 if kind != BLANK else 0
        self.total["truncated"] += kind == TRUNCATED
        initial = role[:1]
        if self.first is None:
            self.first = initial
        else:
            self.total["illegal"] += self.last + initial not in ("su", "ua", "au")
        self.total["illegal"] += n - 1          # equal initials are never legal
        self.last = initial
        if turn is not None and turn != self.most:
            self.turns += 1
            self.least, self.most = turn if self.least is None else self.least, turn
        self.kinds.append(kind)
        self.roles.append(role)
        self.texts.append(text)
        self.counts.append(n)
        self.bytes += len(text)

    def full(self) -> bool:
        return len(self.kinds) >= SEGMENT_ROWS or self.bytes >= SEGMENT_BYTES

    def row(self, closed: bool) -> dict:
        out = {"conv_id": self.conv, "part": self.part, "seg": self.seg, "closed": closed, **self.total}
        steps = steps_of(self.kinds, self.roles, self.counts)
        if not closed:
            return out | {"least": self.least, "most": self.most, "turns": self.turns, "first": self.first, "last": self.last,
                          "dist": distances(steps), "kinds": self.kinds, "roles": self.roles, "texts": self.texts,
                          "counts": self.counts}
        lattice = Lattice(steps, _END)
        edits, state = lattice.trace(0)
        edits += _TAIL[state]
        lines = "\n".join(repaired_lines(edits, 0, self.kinds, self.roles, self.texts, self.counts))
        return out | {"gaps": gaps(self.least, self.most, self.turns), "cost": lattice.price[0][0], "audit": edits,
                      "repaired_sha256": hashlib.sha256(lines.encode("utf-8", "surrogatepass")).hexdigest()}


def gaps(least, most, turns: int) -> int:
    return 0 if least is None else most - least + 1 - turns


def _as_batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _segments(rows: DataFrame, segment_rows: int | None = None) -> DataFrame:
    """One row per conversation that is whole in a task, with its results, and
    one per segment of the others, with distances and rows."""
    limit = segment_rows or SEGMENT_ROWS

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _arrow_schema()
        out, now, open_, seg = [], None, True, 0        # the task's first conversation may have begun before
        for batch in batches:
            cols = [c.to_pylist() for c in batch.columns]
            for conv, turn, role, text, n, again, part in zip(*cols, strict=True):
                if now is None:
                    now = _Segment(conv, part, 0)
                elif conv != now.conv or len(now.kinds) >= limit or now.full():
                    same = conv == now.conv
                    out.append(now.row(closed=not (open_ or same)))
                    open_, seg = same, seg + 1 if same else 0
                    now = _Segment(conv, part, seg)
                now.add(turn, role, text, n, again)
            if len(out) >= 256:
                yield _as_batch(out, schema)
                out = []
        if now is not None:
            out.append(now.row(closed=False))           # it may go on in the next task
            yield _as_batch(out, schema)

    return rows.select("conv_id", "turn", "role", "text", "n", "again", "part").mapInArrow(cut, _SEGMENT)


def _arrow_schema() -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(),
             "array<bigint>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()), "array<string>": pa.list_(pa.string())}
    return pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in _SEGMENT.split(", ")])


def _chain_back(rows: pd.DataFrame) -> pd.DataFrame:
    """Per segment the distances behind it; with the first, the conversation's totals."""
    rows = rows.sort_values(["part", "seg"])
    total = {c: int(rows[c].sum()) for c in _COUNTS}
    least = most = last = None
    turns = 0
    for r in rows.itertuples():
        if not pd.isna(r.first):
            total["illegal"] += last is not None and last + r.first not in ("su", "ua", "au")
            last = r.last
        if not pd.isna(r.least):        # as text: a column with nulls would be made doubles
            turns += int(r.turns) - (most == int(r.least))
            least, most = int(r.least) if least is None else least, int(r.most)
    ends, behind = list(_END), []
    for d in reversed(list(rows["dist"])):
        behind.append(ends)
        ends = [min((d[4 * s + x] + ends[x] for x in range(4) if d[4 * s + x] >= 0), default=_INF) for s in range(4)]
    out = rows[["conv_id", "part", "seg"]].copy()
    out["ends"] = behind[::-1]
    out["head"] = [True] + [False] * (len(out) - 1)
    for c, v in total.items():
        out[c] = v
    out["gaps"], out["cost"] = gaps(least, most, turns), ends[0]
    return out


def _chain_forward(rows: pd.DataFrame) -> pd.DataFrame:
    """Per segment the state it is entered in, and whether it is the last."""
    rows = rows.sort_values(["part", "seg"])
    state, states = 0, []
    for exits in rows["exits"]:
        states.append(state)
        state = int(exits[state])
    out = rows[["conv_id", "part", "seg"]].copy()
    out["state"] = states
    out["tail"] = [-1] * (len(out) - 1) + [state]
    return out


def _traced(pieces: DataFrame) -> DataFrame:
    """Edits and exit state of every segment from each entry state."""
    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("seg", pa.int32()),
                            ("exits", pa.list_(pa.int32())), ("edits", pa.list_(pa.string()))])
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                lattice = Lattice(steps_of(r["kinds"], r["roles"], r["counts"]), r["ends"])
                traced = [lattice.trace(s) for s in range(4)]
                out.append({"conv_id": r["conv_id"], "part": r["part"], "seg": r["seg"],
                            "exits": [t[1] for t in traced], "edits": [t[0] for t in traced]})
            yield _as_batch(out, schema)

    return (pieces.select("conv_id", "part", "seg", "kinds", "roles", "counts", "ends")
            .mapInArrow(trace, "conv_id bigint, part int, seg int, exits array<int>, edits array<string>"))


def _lines(pieces: DataFrame) -> DataFrame:
    """``(conv_id, part, seg, at, line)`` of the repaired segments."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("seg", pa.int32()), ("at", pa.int64()), ("line", pa.string())])
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                lines = list(repaired_lines(r["edit"], r["state"], r["kinds"], r["roles"], r["texts"], r["counts"]))
                if r["tail"] >= 0 and _TAIL_LINES[r["tail"]]:
                    lines += _TAIL_LINES[r["tail"]].split("\n")
                yield _as_batch([{"conv_id": r["conv_id"], "part": r["part"], "seg": r["seg"], "at": k, "line": line}
                                 for k, line in enumerate(lines)], schema)

    return (pieces.select("conv_id", "part", "seg", "kinds", "roles", "texts", "counts", "edit", "state", "tail")
            .mapInArrow(write, "conv_id bigint, part int, seg int, at bigint, line string"))


def _digests(lines: DataFrame) -> DataFrame:
    """``(conv_id, sha)``: SHA-256 of each conversation's lines, read as a sorted stream."""
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha, begun = None, None, False
        for batch in batches:
            done = []
            for conv, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if begun and conv == now:
                    sha.update(b"\n")
                else:
                    if begun:
                        done.append((now, sha.hexdigest()))
                    now, sha, begun = conv, hashlib.sha256(), True
                sha.update(line.encode("utf-8", "surrogatepass"))
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done])],
                                                 names=["conv_id", "sha"])
        if begun:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([sha.hexdigest()])], names=["conv_id", "sha"])

    key = ["conv_id", "part", "seg", "at"]
    return (lines.repartition("conv_id").sortWithinPartitions(*key).select("conv_id", "line")
            .mapInArrow(digest, "conv_id bigint, sha string"))


_KEY = ["conv_id", "part", "seg"]


def _met(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A join in which null ids meet."""
    other = right.select(*[F.col(k).alias("_" + k) for k in keys], *[c for c in right.columns if c not in keys])
    return left.join(other, [F.col(k).eqNullSafe(F.col("_" + k)) for k in keys], how).drop(*["_" + k for k in keys])


def repair_conversations(rows: DataFrame, segment_rows: int | None = None) -> DataFrame:
    """``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256)``, one row per conversation of ``rows (conv_id, turn, role, text)``."""
    rows = rows.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), "role", "text")
    cut = durable(_segments(ordered(damaged(rows)), segment_rows))
    names = ["conv_id", "gaps", *_COUNTS, "cost", "audit", "repaired_sha256"]
    whole = cut.where("closed").select(*names)

    pieces = cut.where("not closed")
    counts = ", ".join(f"{c} bigint" for c in _COUNTS)
    behind = durable(pieces.select(*_KEY, *_COUNTS, F.col("least").cast("string"), F.col("most").cast("string"),
                                   "turns", "first", "last", "dist").groupBy("conv_id").applyInPandas(
        _chain_back, f"conv_id bigint, part int, seg int, ends array<bigint>, head boolean, {counts}, gaps bigint, cost bigint"))
    traced = durable(_traced(_met(pieces.select(*_KEY, "kinds", "roles", "counts"), behind.select(*_KEY, "ends"), _KEY)))
    entered = traced.select(*_KEY, "exits").groupBy("conv_id").applyInPandas(
        _chain_forward, "conv_id bigint, part int, seg int, state int, tail int")
    chosen = durable(_met(traced, entered, _KEY).select(
        *_KEY, "state", "tail", F.get("edits", F.col("state")).alias("edit"),
        F.coalesce(F.get(F.array(*[F.lit(t) for t in _TAIL]), F.col("tail")), F.lit("")).alias("more")))
    audits = chosen.groupBy("conv_id").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("part", "seg", F.concat("edit", "more").alias("e")))), lambda x: x["e"]), "").alias("audit"))
    shas = _digests(_lines(_met(pieces.select(*_KEY, "kinds", "roles", "texts", "counts"), chosen, _KEY)))
    totals = behind.where("head").select("conv_id", "gaps", *_COUNTS, "cost")
    long = (_met(_met(totals, audits, ["conv_id"]), shas, ["conv_id"], "left")
            .select("conv_id", "gaps", *_COUNTS, "cost", "audit",
                    F.coalesce("sha", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256")))
    return whole.unionByName(long)
