"""LM scoring with Brown class-based bigrams.

    P(text) = prod P(class_i | class_{i-1}) * P(word_i | class_i)

over a text's words (A-Z lower-cased) and one end token.

Training counts every word of every training document (map-side counters,
one shuffle).  Classes are found in two steps.  Exchange clustering first
exchanges seed units between classes until the class-bigram likelihood stops
rising: the most frequent words, one by one -- their number grows with the cube
root of the vocabulary and is at least ``HEAD`` -- and ``BUCKETS`` groups of
all other words by their last three bytes.  That matrix is far below the
vocabulary's size, so one task can hold it.  Then every further word with at
least ``ATTESTED`` occurrences is assigned on its own, all in parallel: its
occurrences by classes of the neighbours (a bounded number of cells a word) say in
which class it raises the likelihood most.  Only rarer and unseen words keep
the class of their bucket.  Last, class bigrams are counted again over all
training texts with these classes.  Transitions are smoothed towards class
frequencies, emissions by adding one, an unseen word being one further word of
its class.

Each token needs its word's exact count and class.  Those of at most ``COMMON``
most frequent words are broadcast; the other words are looked up in the complete
table of words, which hash parts deal out: the texts are encoded in blocks of about
``NEAR`` tokens, and a block sends each part one row with all its distinct rarer words
there.  The answers (counts and classes in the block's order of words) meet the block's texts,
which hold the classes of their common words and the numbers of the rarer ones.  So every
text becomes its sequence of classes, a byte a token, and no row is made for a text and
word.  The sequences are stored; both the class bigrams of the training texts and the
scores are read from them.

Defined cases: null and empty texts are one end token; a null id is never
held out; repeated rows are scored each (training counts each); an empty
table gives no rows; without training documents every count is zero; very long
texts are read in blocks, very long words are not remembered; other columns are not
read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textgraph.llm.common import LONG_WORD, durable, held_out, word_blocks

HEAD = 2048
HEAD_ROOT = 16             # or so many times the cube root of the vocabulary
CELLS = 1 << 24            # of the matrix of unit bigrams that one task exchanges, at most
BUCKETS = 511
ATTESTED = 4               # occurrences from which a word gets a class of its own choice
COMMON = 65_536
CLASSES = 64               # besides the end token's own
SWEEPS = 8
PULL = 10.0                # weight of class frequencies in a transition
FOLDS, FOLD = 7, 2
FLUSH = 400_000            # distinct words a counter holds before it is emitted
NEAR = 2_000_000           # tokens whose neighbours are packed together, or that make a block
TEXTS = 100_000            # texts of a block, at most
PART = 100_000             # words that blocks are looked up in together, about
UNITS = 1_500_000          # units whose bigrams are counted together
_CACHE = 500_000


def _binary(batch: pa.RecordBatch, at: int) -> Iterator[bytes | None]:
    return (t.as_py() for t in batch.column(at).cast(pa.binary()))


def _lower_words(text: bytes | None) -> Iterator[list[bytes]]:
    return word_blocks(text.lower() if text else None)


def word_counts(texts: DataFrame) -> DataFrame:
    """``(word binary, n)`` over all texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter: Counter = Counter()

        def emit() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(counter.keys(), pa.binary()),
                                              pa.array(counter.values(), pa.int64())], ["word", "n"])
            counter.clear()
            return out

        for batch in batches:
            for text in _binary(batch, 0):
                for words in _lower_words(text):
                    counter.update(words)
                if len(counter) > FLUSH:
                    yield emit()
        yield emit()

    return texts.select("text").mapInArrow(run, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def most_frequent(counts: DataFrame, most: int) -> list[tuple[bytes, int]]:
    """The ``most`` first words with their counts, by (count descending, word).
    Levels of counts (sixteenths of octaves), then counts, then beginnings of
    words say where to stop, so about ``most`` rows at most are sent to the driver."""
    if most <= 0:
        return []
    level = F.floor(F.log2(F.col("n")) * 16)
    keep, room, tied = F.lit(True), most, counts
    for key in (level, F.col("n")):
        at, room = _last(tied.groupBy(key.alias("at")).agg(F.count(F.lit(1)).alias("words"))
                         .orderBy(F.desc("at")).collect(), room)
        if at is None:
            keep = F.lit(True)
            break
        keep, tied = key >= at, tied.where(key == at)
    else:
        # all of ``tied`` have one count: cut by beginnings until few words share the last one
        depth, scope, size, least = 0, tied, most + 1, at
        while size > most:
            depth += 2
            begins = F.substring("word", 1, depth)
            rows = scope.groupBy(begins.alias("at")).agg(F.count(F.lit(1)).alias("words")).orderBy("at").collect()
            at, room = _last(rows, room)
            if at is None:
                break
            size = next(r.words for r in rows if r.at == at)
            scope = scope.where(begins == F.lit(bytes(at)))
        if at is not None:
            keep = (F.col("n") > least) | ((F.col("n") == least) & (F.substring("word", 1, depth) <= F.lit(bytes(at))))
    found = ((bytes(r.word), r.n) for r in counts.where(keep).collect())
    return sorted(found, key=lambda x: (-x[1], x[0]))[:most]


def _last(rows: list, room: int) -> tuple:
    """The first ``at`` of ``rows`` whose words exceed ``room``, and the room left
    before it; None if all fit."""
    for r in rows:
        if r.words > room:
            return r.at, room
        room -= r.words
    return None, room


class Units(dict):
    """word -> unit: its place among the head words, else its bucket."""

    def __init__(self, head: list[bytes], buckets: int) -> None:
        super().__init__((w, i) for i, w in enumerate(head))
        self.first, self.buckets, self.fixed = len(head), buckets, list(head)

    def __missing__(self, word: bytes) -> int:
        unit = self.first + zlib.crc32(word[-3:]) % self.buckets
        if len(self) >= _CACHE:
            self.clear()
            self.update((w, i) for i, w in enumerate(self.fixed))
        if len(word) <= LONG_WORD:
            self[word] = unit
        return unit

    @property
    def end(self) -> int:
        return self.first + self.buckets

    def of(self, text: bytes | None) -> np.ndarray:
        """The units of a text, its end token last."""
        return np.concatenate([*[self.each(w) for w in _lower_words(text)], np.array([self.end], np.int32)])

    def each(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int32, len(words))


def unit_bigrams(texts: DataFrame, head: list[bytes], buckets: int) -> DataFrame:
    """``(u, v, n)``: the units v (32 bits each) that follow unit u, and how often each
    (64 bits); a text starts after an end."""
    shared, size = texts.sparkSession.sparkContext.broadcast(head), len(head) + buckets + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, grid, most = Units(shared.value, buckets), np.zeros(size * size, np.uint32), 1 << 31
        pending, count, counted = [np.array([size - 1], np.int32)], 0, 0

        def add() -> None:
            line = np.concatenate(pending).astype(np.int64)
            np.add.at(grid, line[:-1] * size + line[1:], np.uint32(1))

        for batch in batches:
            for text in _binary(batch, 0):
                pending.append(units.of(text))
                count += len(pending[-1])
                if count > UNITS:
                    add()
                    pending, counted, count = [np.array([size - 1], np.int32)], counted + count, 0
                    if counted > most:
                        yield _rows_of_cells(grid, size)
                        grid[:], counted = 0, 0
        add()
        yield _rows_of_cells(grid, size)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, row = None, np.zeros(size, np.int64)

        def whole() -> pa.RecordBatch:
            v = np.flatnonzero(row)
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([v.astype(np.int32).tobytes()], pa.binary()),
                                               pa.array([row[v].tobytes()], pa.binary())], ["u", "v", "n"])

        for batch in batches:
            for u, v, n in zip(*(c.to_pylist() for c in batch.columns)):
                if u != now:
                    if now is not None:
                        yield whole()
                    now, row = u, np.zeros(size, np.int64)
                row[np.frombuffer(v, np.int32)] += np.frombuffer(n, np.int64)      # a row holds a unit once
        if now is not None:
            yield whole()

    kinds = "u bigint, v binary, n binary"
    return texts.select("text").mapInArrow(run, kinds).repartition("u").sortWithinPartitions("u").mapInArrow(total, kinds)


def _rows_of_cells(grid: np.ndarray, size: int) -> pa.RecordBatch:
    at = np.flatnonzero(grid)
    u = at // size
    starts = np.flatnonzero(np.diff(u, prepend=-1))
    sizes = np.diff(starts, append=len(at))
    return pa.RecordBatch.from_arrays([pa.array(u[starts]), _binaries(sizes * 4, (at % size).astype(np.int32)),
                                       _binaries(sizes * 8, grid[at].astype(np.int64))], ["u", "v", "n"])


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def exchange(u: np.ndarray, v: np.ndarray, n: np.ndarray, size: int, classes: int = CLASSES,
             sweeps: int = SWEEPS) -> tuple[np.ndarray, np.ndarray]:
    """Exchange clustering of units 0..size-1, the last (the end) alone in
    class ``classes``.  Returns (class of each unit, class-bigram counts)."""
    end, k = size - 1, classes + 1
    n = n.astype(float)
    total = np.bincount(u, n, size) + np.bincount(v, n, size)
    order = np.argsort(-total[:end], kind="stable")
    cls = np.empty(size, np.int64)
    cls[order] = np.arange(end) % classes
    cls[end] = classes
    by_u, by_v = np.argsort(u, kind="stable"), np.argsort(v, kind="stable")
    at_u, at_v = np.searchsorted(u[by_u], np.arange(size + 1)), np.searchsorted(v[by_v], np.arange(size + 1))
    grid = np.bincount(cls[u] * k + cls[v], n, k * k).reshape(k, k)
    for _ in range(sweeps):
        moved = 0
        for w in order:
            if not total[w]:
                continue
            after, before = by_u[at_u[w]:at_u[w + 1]], by_v[at_v[w]:at_v[w + 1]]
            same = n[after][v[after] == w].sum()
            out = np.bincount(cls[v[after]], n[after], k)
            into = np.bincount(cls[u[before]], n[before], k)
            g = cls[w]
            out[g] -= same
            into[g] -= same
            grid[g, :] -= out
            grid[:, g] -= into
            grid[g, g] -= same
            rows = (_xlogx(grid + out) - _xlogx(grid))
            cols = (_xlogx(grid + into[:, None]) - _xlogx(grid))
            d = np.diagonal(grid)
            gain = (rows.sum(1) - np.diagonal(rows) + cols.sum(0) - np.diagonal(cols)
                    + _xlogx(d + out + into + same) - _xlogx(d))
            left, right = grid.sum(1), grid.sum(0)
            gain -= _xlogx(left + out.sum() + same) - _xlogx(left) + _xlogx(right + into.sum() + same) - _xlogx(right)
            best = int(np.argmax(gain[:classes]))
            if gain[best] <= gain[g] + 1e-9:
                best = g
            moved += best != g
            cls[w] = best
            grid[best, :] += out
            grid[:, best] += into
            grid[best, best] += same
        if not moved:
            break
    return cls, np.bincount(cls[u] * k + cls[v], n, k * k).reshape(k, k)


def cluster(bigrams: DataFrame, size: int, classes: int = CLASSES) -> tuple[np.ndarray, np.ndarray]:
    """``exchange`` in one task over the bounded matrix of unit bigrams."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(np.empty(0, np.int64),) * 3]
        for b in batches:
            v, times = _flat(b.column(1), np.int32)
            parts.append((np.repeat(b.column(0).to_numpy(), times), v.astype(np.int64), _flat(b.column(2), np.int64)[0]))
        u, v, n = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((v, u))
        cls, grid = exchange(u[order], v[order], n[order], size, classes)
        yield pa.RecordBatch.from_arrays([pa.array([cls.tobytes()], pa.binary()), pa.array([grid.tobytes()], pa.binary())],
                                         ["cls", "grid"])

    row = bigrams.repartition(1).mapInArrow(run, "cls binary, grid binary").first()
    if row is None:
        return exchange(*(np.empty(0, np.int64),) * 3, size, classes)
    return np.frombuffer(row.cls, np.int64), np.frombuffer(row.grid, np.float64).reshape(classes + 1, classes + 1)


class Ids(dict):
    """word -> number, in the order they are first asked for."""

    def __missing__(self, word: bytes) -> int:
        self[word] = len(self)
        return len(self) - 1

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int32, len(words))


def _binaries(sizes: np.ndarray, data: np.ndarray) -> pa.Array:
    """``data`` cut into values of ``sizes`` bytes."""
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])


def _together(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """The distinct keys (not negative), and the values of each in one binary."""
    order = np.argsort(keys)
    keys = keys[order]
    starts = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[starts], _binaries(np.diff(starts, append=len(keys)) * values.itemsize, values[order])


def _flat(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all binaries one after the other, and how many each has."""
    ends = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]
    return data.view(kind), np.diff(ends) // np.dtype(kind).itemsize


def _begins(*keys: pa.Array) -> np.ndarray:
    """Which rows have another key than the row before; the first one has."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for key in keys:
        a, b = key[1:], key[:-1]
        new[1:] |= pc.or_(pc.fill_null(pc.not_equal(a, b), False), pc.xor(a.is_null(), b.is_null())).to_numpy(zero_copy_only=False)
    return new


def word_contexts(texts: DataFrame, head: list[bytes], buckets: int, cls: np.ndarray, classes: int) -> DataFrame:
    """``(word, near)`` of the words outside ``head``: near holds a number of 16 bits
    for each of a good many occurrences, the class before times (classes + 1) plus the
    class after, of the seed units."""
    shared, k = texts.sparkSession.sparkContext.broadcast((head, cls)), classes + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, cls = shared.value
        end = len(names)      # also the place of the end token, then of the words as they are met
        first = {w: i for i, w in enumerate([*names, b" "])}      # no word holds a blank
        ids, line, count = Ids(first), [[end]], 0

        def emit() -> pa.RecordBatch:
            words, code = list(ids)[end + 1:], np.concatenate(line).astype(np.int32)
            of = cls[np.array([*range(end), len(cls) - 1, *(end + zlib.crc32(w[-3:]) % buckets for w in words)])]
            at = np.flatnonzero(code > end)
            each, packed = _together(code[at] - (end + 1), (of[code[at - 1]] * k + of[code[at + 1]]).astype(np.uint16))
            return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()).take(pa.array(each)), packed], ["word", "near"])

        for batch in batches:
            for text in _binary(batch, 0):
                for words in _lower_words(text):
                    line.append(ids.of(words))
                    count += len(words)
                line.append([end])
                if count > NEAR or len(ids) > FLUSH:
                    yield emit()
                    ids, line, count = Ids(first), [[end]], 0
        yield emit()

    return texts.select("text").mapInArrow(run, "word binary, near binary")


def best_class(into: np.ndarray, out: np.ndarray, own: np.ndarray, grid: np.ndarray) -> np.ndarray:
    """Class of each word (a row of ``into`` and ``out``: its occurrences by class
    before and after it) that raises the class-bigram likelihood most when the
    word is taken out of its class ``own`` in ``grid``; ties stay."""
    k = len(grid)
    classes, each = k - 1, np.arange(len(own))
    mine = np.arange(classes) == own[:, None]

    def rise(base: np.ndarray, add: np.ndarray, mine: np.ndarray) -> np.ndarray:
        base = np.maximum(base - mine * add, 0.0)
        return _xlogx(base + add) - _xlogx(base)

    gain = np.zeros((len(own), classes))
    for cells, table in ((out, grid[:classes].T), (into, grid[:, :classes])):
        w, d = np.nonzero(cells)
        n = cells[w, d][:, None]
        starts = np.flatnonzero(np.diff(w, prepend=-1))
        if len(w):
            gain[w[starts]] += np.add.reduceat(rise(table[d], n, mine[w]), starts)
        gain -= rise(table.sum(0)[None], cells.sum(1)[:, None], mine)
    # the cell of a class with itself takes both sides at once
    d, o, i = np.diagonal(grid)[None, :classes], out[:, :classes], into[:, :classes]
    gain += rise(d, o + i, mine) - rise(d, o, mine) - rise(d, i, mine)
    best = gain.argmax(1)
    return np.where(gain[each, best] > gain[each, own] + 1e-9, best, own)


def assign(contexts: DataFrame, cls: np.ndarray, grid: np.ndarray, first: int, buckets: int,
           attested: int = ATTESTED) -> DataFrame:
    """``(word, n, cls)``: the class of every word of ``contexts``, by likelihood
    gain if it occurs ``attested`` times, else that of its bucket.  The rows of a word
    come one after the other and are summed as they come."""
    shared, k = contexts.sparkSession.sparkContext.broadcast((cls, grid)), len(grid)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cls, grid = shared.value
        word, into, out = pa.array([], pa.binary()), np.zeros((0, k)), np.zeros((0, k))      # the word that is not complete

        def chosen(words: pa.Array, into: np.ndarray, out: np.ndarray) -> Iterator[pa.RecordBatch]:
            for at in range(0, len(words), 512):
                part, i, o = words.slice(at, 512), into[at:at + 512], out[at:at + 512]
                own = cls[[first + zlib.crc32(w[-3:]) % buckets for w in part.to_pylist()]].astype(np.int64)
                total = i.sum(1).astype(np.int64)
                many = total >= attested
                own[many] = best_class(i[many], o[many], own[many], grid)
                yield pa.RecordBatch.from_arrays([part, pa.array(total), pa.array(own, pa.int32())], ["word", "n", "cls"])

        for batch in batches:
            if not batch.num_rows:
                continue
            words = pa.concat_arrays([word, batch.column(0)])
            new = _begins(words)
            names, of = words.filter(pa.array(new)), (np.cumsum(new) - 1)[len(word):]
            ctx, times = _flat(batch.column(1), np.uint16)
            row, ctx = np.repeat(of, times) * k, ctx.astype(np.int64)
            left = np.bincount(row + ctx // k, minlength=len(names) * k).reshape(-1, k).astype(float)
            right = np.bincount(row + ctx % k, minlength=len(names) * k).reshape(-1, k).astype(float)
            left[:len(into)] += into
            right[:len(out)] += out
            yield from chosen(names[:-1], left[:-1], right[:-1])
            word, into, out = names[-1:], left[-1:].copy(), right[-1:].copy()
        yield from chosen(word, into, out)

    return (contexts.repartition("word").sortWithinPartitions("word")
            .mapInArrow(run, "word binary, n bigint, cls int"))


def _part(word: bytes, parts: int) -> int:
    return zlib.crc32(word) % parts


def _packed(words: list[bytes], parts: int) -> tuple[np.ndarray, Iterator[tuple[int, int, bytes]]]:
    """The order of ``words`` by part; for each part that has some, its number, where its
    words begin in that order, and the words (none holds a blank) in one value."""
    part = np.fromiter((_part(w, parts) for w in words), np.int64, len(words))
    order = np.argsort(part, kind="stable")
    starts = np.flatnonzero(np.diff(part[order], prepend=-1))
    cuts = zip(starts.tolist(), [*starts[1:].tolist(), len(words)])
    return order, ((int(part[order[a]]), a, b" ".join([words[i] for i in order[a:b].tolist()])) for a, b in cuts)


def word_parts(words: DataFrame, parts: int) -> DataFrame:
    """``(part, words, n, cls)`` of ``words`` (word, n, cls): a task's words of one part in one row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0

        def emit() -> pa.RecordBatch:
            word, n, cls = (pa.concat_arrays([b.column(i) for b in held]) for i in range(3))
            order, rows = _packed(word.to_pylist(), parts)
            part, starts, packed = zip(*rows)
            sizes = np.diff([*starts, len(order)])
            return pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), pa.array(packed, pa.binary()), _binaries(sizes * 8, n.to_numpy()[order]),
                 _binaries(sizes, cls.to_numpy()[order].astype(np.uint8))], ["part", "words", "n", "cls"])

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                count += batch.num_rows
            if count > FLUSH:
                yield emit()
                held, count = [], 0
        if held:
            yield emit()

    return words.select("word", F.col("n").cast("bigint"), F.col("cls").cast("int")).mapInArrow(
        run, "part int, words binary, n binary, cls binary")


def class_sequences(rows: DataFrame, words: DataFrame, common: dict[bytes, int], logs: np.ndarray, seen_end: bool,
                    rare_class: Column, classes: int, parts: int | None = None) -> DataFrame:
    """``(doc_id, ask, learn, copies, known, logs, seq)`` of ``rows`` (doc_id, text, ask,
    learn): a text's classes, a byte each and the end's last, how many of its tokens have a
    count, and the sum of log10(count + 1).  ``common`` are the words that need no join with
    ``words`` (word, n, cls); a word in neither has the class ``rare_class``.  ``words`` are
    looked up in ``parts`` (by default of about ``PART`` words)."""
    if classes > 254:
        raise ValueError(f"{classes} classes: a class is one byte")
    shared = rows.sparkSession.sparkContext.broadcast((list(common), np.array([*common.values(), 255, classes], np.uint8), logs))
    kind = rows.schema["doc_id"].dataType.simpleString()
    parts = parts or words.count() // PART + 1
    text_columns = ["doc_id", "th", "ask", "learn", "known", "logs", "seq", "rare"]
    text_kinds = f"doc_id {kind}, th bigint, ask boolean, learn boolean, known bigint, logs double, seq binary, rare binary"

    def rows_of(schema: pa.Schema, size: int, **columns: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(size, f.type) for f in schema], schema=schema)

    def schema_of(names: list[tuple[str, pa.DataType]], doc_id: pa.DataType) -> pa.Schema:
        texts = zip(text_columns, [doc_id, pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.float64(), pa.binary(), pa.binary()])
        return pa.schema([*names, *texts])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A block of texts at a time: its texts with the classes of their common words and the
        numbers, in the block, of the rarer ones; and its rarer words, a row for each part."""
        names, cls, logs = shared.value
        code, other, task = {w: i for i, w in enumerate(names)}, len(names), TaskContext.get().partitionId()
        ids, held, docs, rare, count, made = Ids(), [], [], [], 0, 0

        def emit() -> Iterator[pa.RecordBatch]:
            doc_id, th, ask, learn = (pa.concat_arrays([b.column(i) for b in held]) for i in range(4))
            hashes = th.to_numpy()
            # made of its texts too: if a lost task runs again on other blocks, none is taken for one of before
            block = task.to_bytes(4, "little") + made.to_bytes(4, "little") + blake2b(hashes.tobytes(), digest_size=8).digest()
            order, asked = _packed(list(ids), parts)
            place = np.empty(len(ids), np.int32)
            place[order] = np.arange(len(ids))
            known, total, seq, sizes = zip(*docs)
            schema = schema_of([("block", pa.binary()), ("kind", pa.int32()), ("part", pa.int32()), ("start", pa.int32()),
                                ("total", pa.int32()), ("words", pa.binary())], doc_id.type)
            each = lambda x, n: pa.array(np.full(n, x, np.int32))
            n = len(docs)
            yield rows_of(schema, n, block=pa.array([block] * n, pa.binary()), kind=each(2, n), total=each(len(ids), n),
                          part=pa.array((hashes % parts).astype(np.int32)), doc_id=doc_id, th=th, ask=ask, learn=learn,
                          known=pa.array(known, pa.int64()), logs=pa.array(total, pa.float64()), seq=pa.array(seq, pa.binary()),
                          rare=_binaries(np.array(sizes) * 4, place[np.concatenate([np.empty(0, np.int32), *rare])]))
            if ids:
                part, start, packed = zip(*asked)
                n = len(part)
                yield rows_of(schema, n, block=pa.array([block] * n, pa.binary()), kind=each(1, n), total=each(len(ids), n),
                              part=pa.array(part, pa.int32()), start=pa.array(start, pa.int32()), words=pa.array(packed, pa.binary()))

        for batch in batches:
            begun = 0
            for i, text in enumerate(_binary(batch, 4)):
                known, total, seq, size = int(seen_end), logs[-1], [], 0
                for words in _lower_words(text):
                    c = np.fromiter(map(code.get, words, repeat(other)), np.int64, len(words))
                    at = np.flatnonzero(c == other)
                    if len(at):
                        rare.append(ids.of([words[j] for j in at.tolist()]))
                    seq.append(cls[c].tobytes())
                    size, known, total, count = size + len(at), known + len(c) - len(at), total + logs[c].sum(), count + len(c)
                docs.append((known, total, b"".join([*seq, bytes([classes])]), size))
                if count > NEAR or len(ids) > FLUSH or len(docs) >= TEXTS:
                    held.append(batch.slice(begun, i + 1 - begun))
                    yield from emit()
                    begun, made = i + 1, made + 1
                    ids, held, docs, rare, count = Ids(), [], [], [], 0
            if begun < batch.num_rows:
                held.append(batch.select([0, 1, 2, 3]).slice(begun))
        if docs:
            yield from emit()

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Counts and classes of the words that blocks ask for, in their order; a word that is
        in no row of its part's table comes alone, without them.  Texts pass."""
        now, table, n, cls = None, {}, [], []
        for batch in batches:
            col = dict(zip(batch.schema.names, batch.columns))
            schema = schema_of([("block", pa.binary()), ("kind", pa.int32()), ("start", pa.int32()), ("total", pa.int32()),
                                ("n", pa.binary()), ("cls", pa.binary()), ("word", pa.binary())], col["doc_id"].type)
            kinds = col["kind"].to_numpy()
            found, alone = [], []
            for i in np.flatnonzero(kinds < 2).tolist():
                if (part := col["part"][i].as_py()) != now:
                    now, table, n, cls = part, {}, [], []
                asked = col["words"][i].as_py().split(b" ")
                if kinds[i] == 0:
                    table.update(zip(asked, range(len(table), len(table) + len(asked))))
                    n.append(np.frombuffer(col["n"][i].as_py(), np.int64))
                    cls.append(np.frombuffer(col["cls"][i].as_py(), np.uint8))
                    continue
                if len(n) != 1:
                    n, cls = ([np.concatenate([np.zeros(0, t), *x])] for t, x in ((np.int64, n), (np.uint8, cls)))
                at = np.fromiter(map(table.get, asked, repeat(-1)), np.int64, len(asked))
                block, start, total = (col[c][i].as_py() for c in ("block", "start", "total"))
                new = np.flatnonzero(at < 0).tolist()
                if new:
                    alone += [(block, start + j, total, asked[j]) for j in new]
                    got_n, got_cls = np.zeros(len(at), np.int64), np.full(len(at), 255, np.uint8)
                    got_n[at >= 0], got_cls[at >= 0] = n[0][at[at >= 0]], cls[0][at[at >= 0]]
                else:
                    got_n, got_cls = n[0][at], cls[0][at]
                found.append((block, start, total, got_n.tobytes(), got_cls.tobytes()))
            for kind, rest, rows in ((0, ("n", "cls"), found), (1, ("word",), alone)):
                if rows:
                    block, start, total, *values = zip(*rows)
                    yield rows_of(schema, len(rows), block=pa.array(block, pa.binary()), kind=pa.array([kind] * len(rows), pa.int32()),
                                  start=pa.array(start, pa.int32()), total=pa.array(total, pa.int32()),
                                  **{c: pa.array(v, pa.binary()) for c, v in zip(rest, values)})
            texts = pa.array(np.flatnonzero(kinds == 2))
            if len(texts):
                yield rows_of(schema, len(texts), **{c: col[c].take(texts) for c in ("block", "kind", "total", *text_columns)})

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Puts the classes of a block's rarer words into their places in its texts, which come last."""
        block, n, cls, logs, whole = None, None, None, None, True
        for batch in batches:
            starts = np.flatnonzero(_begins(batch.column(0)))
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), batch.num_rows]):
                run = batch.slice(a, b - a)
                col = dict(zip(run.schema.names, run.columns))
                if (key := col["block"][0].as_py()) != block:
                    total = col["total"][0].as_py()
                    block, n, cls, whole = key, np.zeros(total, np.int64), np.full(total, 255, np.uint8), False
                first, last = np.searchsorted(col["kind"].to_numpy(), [1, 2]).tolist()
                for i in range(first):
                    at, got = col["start"][i].as_py(), col["cls"][i].as_py()
                    cls[at:at + len(got)] = np.frombuffer(got, np.uint8)
                    n[at:at + len(got)] = np.frombuffer(col["n"][i].as_py(), np.int64)
                if first < last:
                    cls[col["start"].slice(first, last - first).to_numpy()] = col["c"].slice(first, last - first).to_numpy()
                if last == b - a:
                    continue
                if not whole:
                    if (cls == 255).any():
                        raise RuntimeError("words of a block were not answered: its texts were dealt anew meanwhile")
                    logs, whole = np.log10(n + 1.0), True
                col = {c: x.slice(last) for c, x in col.items()}
                seq, sizes = _flat(col["seq"], np.uint8)
                rare, times = _flat(col["rare"], np.int32)
                seq, row = seq.copy(), np.repeat(np.arange(len(sizes)), times)
                seq[seq == 255] = cls[rare]
                known = col["known"].to_numpy() + np.bincount(row, n[rare] > 0, len(sizes)).astype(np.int64)
                total = col["logs"].to_numpy() + np.bincount(row, logs[rare], len(sizes))
                yield pa.RecordBatch.from_arrays(
                    [col["doc_id"], col["th"], col["ask"], col["learn"], pa.array(known), pa.array(total), _binaries(sizes, seq)],
                    ["doc_id", "th", "ask", "learn", "known", "logs", "seq"])

    keyed = rows.select("doc_id", F.xxhash64("doc_id", F.coalesce("text", F.lit("")), "ask", "learn").alias("th"), "ask", "learn", "text")
    texts = keyed.mapInArrow(encode, f"block binary, kind int, part int, start int, total int, words binary, {text_kinds}")
    return (texts.unionByName(word_parts(words, parts).withColumn("kind", F.lit(0)), allowMissingColumns=True)
            .repartition("part").sortWithinPartitions("part", "kind")
            .mapInArrow(look_up, f"block binary, kind int, start int, total int, n binary, cls binary, word binary, {text_kinds}")
            .select("block", "kind", "start", "total", "n", "cls",
                    F.when(F.col("word").isNotNull(), F.coalesce(rare_class, F.lit(0)).cast("int")).alias("c"), *text_columns)
            .repartition("block").sortWithinPartitions("block", "kind")
            .mapInArrow(fill, f"doc_id {kind}, th bigint, ask boolean, learn boolean, known bigint, logs double, seq binary")
            # rows that repeat id and text meet
            .groupBy("doc_id", "th", "ask", "learn")
            .agg(F.count(F.lit(1)).alias("copies"), *(F.first(c).alias(c) for c in ("known", "logs", "seq")))
            .select("doc_id", "ask", "learn", "copies", "known", "logs", "seq"))


def _steps(column: pa.Array, classes: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Some sequences at a time: the first one's number, their lengths, and for each token
    the class before and its own; the end of a text is what the next one starts after."""
    for at in range(0, len(column), 512):
        own, sizes = _flat(column.slice(at, 512), np.uint8)
        yield at, sizes, np.concatenate([[classes], own[:-1]]).astype(np.int64), own.astype(np.int64)


def class_bigrams(sequences: DataFrame, classes: int) -> np.ndarray:
    """Class-bigram counts of ``sequences`` (copies, seq)."""
    k = classes + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grid = np.zeros(k * k)
        for batch in batches:
            copies = batch.column(0).to_numpy()
            for at, sizes, before, own in _steps(batch.column(1), classes):
                grid += np.bincount(before * k + own, np.repeat(copies[at:at + len(sizes)], sizes), k * k)
        cells = np.flatnonzero(grid)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(grid[cells].astype(np.int64))], ["cell", "n"])

    found = sequences.select("copies", "seq").mapInArrow(run, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    grid = np.zeros(k * k)
    for r in found.collect():
        grid[r.cell] = r.n
    return grid.reshape(k, k)


def score_texts(docs: DataFrame, learn: DataFrame, **options) -> DataFrame:
    """``docs`` (doc_id, text) scored by a model learned from ``learn``
    (text): (doc_id, n_tokens, n_known, train_tokens, base_score, score)."""
    none = F.lit(None).cast(docs.schema["doc_id"].dataType).alias("doc_id")
    flags = lambda ask: (F.lit(ask).alias("ask"), F.lit(not ask).alias("learn"))
    return score_rows(docs.select("doc_id", "text", *flags(True)).unionByName(learn.select(none, "text", *flags(False))), **options)


def score_rows(rows: DataFrame, head: int | None = None, buckets: int = BUCKETS, common: int = COMMON,
               classes: int = CLASSES, attested: int = ATTESTED) -> DataFrame:
    """The rows of ``rows`` (doc_id, text, ask, learn) with ``ask``, scored by a
    model learned from those with ``learn``, as :func:`score_texts` does."""
    spark = rows.sparkSession
    learn = rows.where("learn").select("text")
    counts = durable(word_counts(learn))
    ends = learn.count()
    row = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    tokens, vocabulary = (row.n or 0) + ends, row.v + (ends > 0)
    top = most_frequent(counts, common)
    most = min(max(HEAD, int(HEAD_ROOT * vocabulary ** (1 / 3))), int(CELLS ** 0.5) - buckets - 1)
    heads = [w for w, _ in top[:most if head is None else head]]
    units = Units(heads, buckets)

    cls, grid = cluster(unit_bigrams(learn, heads, buckets), units.end + 1, classes)
    # Arrow tables: a frame of Python rows would start a second set of Python workers
    seeds = spark.createDataFrame(pa.table({
        "word": pa.array(heads, pa.binary()), "n": pa.array([n for _, n in top[:len(heads)]], pa.int64()),
        "cls": pa.array(cls[:len(heads)], pa.int32())}))
    words = durable(assign(word_contexts(learn, heads, buckets, cls, classes), cls, grid, len(heads), buckets, attested)
                    .unionByName(seeds))
    names = spark.createDataFrame(pa.table({"word": pa.array([w for w, _ in top], pa.binary())}))
    class_of = {bytes(r.word): r.cls for r in words.join(F.broadcast(names), "word").select("word", "cls").collect()}
    class_of = {w: class_of[w] for w, _ in top}
    # a word's code is its place among the common words; all others share one
    logs = np.concatenate([np.log10(np.array([n + 1.0 for _, n in top])), [0.0, np.log10(ends + 1.0)]])
    bucket = F.get(F.lit(cls[len(heads):].astype(np.int32)), (F.crc32(F.substring("word", -3, 3)) % buckets).cast("int"))
    sequences = durable(class_sequences(rows, words, class_of, logs, ends > 0, bucket, classes,
                                        int(vocabulary) // PART + 1))
    grid = class_bigrams(sequences.where("learn"), classes)
    in_class = grid.sum(0)                                   # tokens of each class
    kinds = np.zeros(classes + 1)
    for r in words.groupBy("cls").agg(F.count(F.lit(1)).alias("n")).collect():
        kinds[r.cls] = r.n
    kinds[classes] = 1
    chance = (in_class + 1) / (in_class.sum() + classes + 1)
    step = np.log10((grid + PULL * chance) / (grid.sum(1, keepdims=True) + PULL))
    room = np.log10(in_class + kinds + 1)
    base = float(np.log10(float(tokens + vocabulary + 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, model = [np.empty(0, np.int64)], [np.empty(0)]
            for _, sizes, before, own in _steps(batch.column(4), classes):
                size.append(sizes.astype(np.int64))
                model.append(np.add.reduceat(step[before, own] - room[own], np.cumsum(sizes) - sizes))
            size, logs = np.concatenate(size), batch.column(3).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(size), pa.array(logs - size * base), pa.array(logs + np.concatenate(model))],
                ["doc_id", "copies", "n_known", "n_tokens", "base_score", "score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return (sequences.where("ask").select("doc_id", "copies", "known", "logs", "seq")
            .mapInArrow(run, f"doc_id {kind}, copies bigint, n_known bigint, n_tokens bigint, base_score double, score double")
            .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
            .select("doc_id", "n_tokens", "n_known", F.lit(tokens).cast("bigint").alias("train_tokens"), "base_score", "score"))


def score_documents(docs: DataFrame) -> DataFrame:
    """Every document scored by the model of those outside the held-out fold."""
    out = held_out(F.col("doc_id"), FOLDS, FOLD)
    return score_rows(docs.select("doc_id", "text", F.lit(True).alias("ask"), (~out).alias("learn"))).select(
        "doc_id", out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
