"""Packing token sequences by Karmarkar-Karp multiway differencing.

A document's ids (with an end id) are cut into full windows and one
remainder.  Full windows are sequences already and are never grouped.  The
remainders are dealt by a hash of their place in the input into buckets of about
``BUCKET_WINDOWS`` windows of tokens, so repeated rows spread as others do; in a bucket,
differencing spreads them over ``k`` windows: every remainder starts as a
partial partition of its own, and the two partial partitions of the largest
imbalance are merged over and over, the fullest windows of one against the
emptiest of the other.  ``k`` starts at the least possible number and rises
while a window exceeds its capacity.  A bucket's size is a parameter, so a
task's work is bounded; there is no order between buckets.

Token ids come from a tokenizer that treats every word (between ASCII white
space) alone, so a worker remembers the ids of the words it has seen, within
a bound, and only new words are encoded; a text that holds a special token's
opening ``<|`` is encoded as a whole.

Defined cases: null and empty texts are the end id alone; repeated rows are
packed each; null ids are kept; an empty table gives no rows; very long
texts are encoded in blocks; other columns of ``documents`` are not looked
at, other columns of pieces travel along.

Pieces carry their ids through the packing, as little-endian unsigned 32-bit
numbers (binary); ``sequences`` joins them to whole, padded windows.
"""

from __future__ import annotations

import heapq
import os
import re
from collections.abc import Iterable, Iterator
from itertools import filterfalse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textgraph.llm.common import LONG_WORD, durable, remember_for, word_blocks

WINDOW = 4096
END_ID = 2
BUCKET_WINDOWS = 128
CACHE = 1_000_000          # words whose ids a worker remembers (about 200 MB)
NEW_WORDS = 20_000         # new words (or texts) that are learned together
TOGETHER = 32 << 20        # bytes of texts that wait for that
LINE_WORDS = 1000          # new words encoded as one line
TOKENIZER = "word_bpe_49k.json"
_FULL = 1 << 61

# a word that ends in ASCII punctuation is encoded as two: no pattern of the
# tokenizer's spans a letter followed by punctuation other than an apostrophe
_TRAILING = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_STEM = re.compile(rb"([a-z\x80-\xff]*[a-z])([!-&(-/:-@\[-`{-~]+)")


class WordEncoder:
    """Ids of texts, word by word."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)     # ids that end a word
        self.last[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.known: dict[bytes, bytes] = {}

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4") for e in found]

    def _line(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters, encoded as one line and cut at the ids that
        end a word; where those are not one for each word, one by one."""
        ids, = self._ids([" ".join(words)])
        ends = np.nonzero(self.last[ids])[0]
        if len(ends) != len(words):
            return [x.tobytes() for x in self._ids(words)]
        cuts, data = ((ends + 1) * 4).tolist(), ids.tobytes()
        return [data[a:b] for a, b in zip([0, *cuts], cuts)]

    def _add(self, parts: set[bytes]) -> None:
        letters, others = [], []
        for p in parts:
            text = p.decode("utf-8", "replace")
            (letters if text.isalpha() else others).append((p, text))
        for at in range(0, len(letters), LINE_WORDS):
            part = letters[at:at + LINE_WORDS]
            self.known.update(zip([p for p, _ in part], self._line([t for _, t in part])))
        self.known.update(zip([p for p, _ in others], [x.tobytes() for x in self._ids([t for _, t in others])]))

    def _learn(self, new: set[bytes]) -> None:
        known, split, parts = self.known, [], set()
        for w in new:
            stem = w.rstrip(_TRAILING)
            if len(stem) < len(w) and stem.isalpha():
                split.append((w, stem, w[len(stem):]))
                parts.add(stem)
                parts.add(w[len(stem):])
            elif not w.isalpha() and (m := _STEM.fullmatch(w)):
                split.append((w, *m.groups()))
                parts.update(m.groups())
            else:
                parts.add(w)
        self._add(parts.difference(known))
        for w, stem, rest in split:
            known[w] = known[stem] + known[rest]

    def encode(self, texts: Iterable[bytes | None]) -> Iterator[bytes]:
        """The ids of each text, as little-endian 32-bit integers.  The new words
        of some texts are learned together."""
        waiting: list[list[tuple] | bytes] = []
        new: set[bytes] = set()
        size = 0
        known = self.known.get
        for text in texts:
            if text and b"<|" in text:
                waiting.append(text)
            else:
                waiting.append(blocks := [])
                for block in word_blocks(text.lower() if text else None):
                    ids = list(map(known, block))
                    if None in ids:
                        at = [i for i, x in enumerate(ids) if x is None]
                        words = [block[i] for i in at]
                        new.update(words)
                        blocks.append((ids, at, words))
                    else:
                        blocks.append((ids, (), ()))
            size += len(text or b"")
            if len(new) > NEW_WORDS or len(waiting) > NEW_WORDS or size > TOGETHER:
                yield from self._flush(waiting, new)
                waiting, new, size = [], set(), 0
        yield from self._flush(waiting, new)

    def _flush(self, waiting: list, new: set[bytes]) -> Iterator[bytes]:
        if len(self.known) + 2 * len(new) > CACHE:
            self.known.clear()
        self._learn(new)
        known = self.known
        for item in waiting:
            if isinstance(item, bytes):
                yield self._ids([item.decode("utf-8", "replace")])[0].tobytes()
                continue
            for ids, at, words in item:
                for i, w in zip(at, words):
                    ids[i] = known[w]
            yield b"".join([b"".join(ids) for ids, _, _ in item])
        for w in [w for w in new if len(w) > LONG_WORD]:
            self.known.pop(w, None)


_ENCODERS: dict[str, WordEncoder] = {}


def _encoder(path: str | None) -> WordEncoder:
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path(TOKENIZER)
    remember_for("packing", _ENCODERS.clear)
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def token_pieces(docs: DataFrame, tokenizer: str | None = None, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """``(doc_id, start, length, doc_tokens, ids)`` of every piece of at most
    ``window`` ids."""
    end = np.array([end_id], "<u4").tobytes()
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        for batch in batches:
            texts = (t.as_py() for t in batch.column(1).cast(pa.binary()))
            row, start, length, total, out = [], [], [], [], []
            for i, ids in enumerate(encoder.encode(texts)):
                ids += end
                for a in range(0, len(ids), 4 * window):
                    piece = ids[a:a + 4 * window]
                    row.append(i)
                    start.append(a // 4)
                    length.append(len(piece) // 4)
                    total.append(len(ids) // 4)
                    out.append(bytes(piece))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int32())), *[pa.array(x, pa.int64()) for x in (start, length, total)],
                 pa.array(out, pa.binary())], ["doc_id", "start", "length", "doc_tokens", "ids"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, start bigint, length bigint, doc_tokens bigint, ids binary")


def difference(sizes: list[int], k: int) -> list[list[int]]:
    """Karmarkar-Karp: positions of ``sizes`` in ``k`` parts of near-equal sum."""
    if k <= 1:
        return [list(range(len(sizes)))]
    # a partial partition: its windows' sums in descending order (zeros left out) and their trees of items
    heap = [(-s, i, [s], [i]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    tie = len(sizes)
    while len(heap) > 1:
        _, _, sums_a, bins_a = heapq.heappop(heap)
        _, _, sums_b, bins_b = heapq.heappop(heap)
        meet = len(sums_a) + len(sums_b) - k      # windows that both have filled
        if meet > 0:
            fresh = len(sums_b) - meet
            # the fullest of b meet the emptiest of a
            sums = sums_a[:len(sums_a) - meet] + [x + y for x, y in zip(sums_a[len(sums_a) - meet:], sums_b[fresh:][::-1])]
            bins = bins_a[:len(bins_a) - meet] + [(x, y) for x, y in zip(bins_a[len(bins_a) - meet:], bins_b[fresh:][::-1])]
            if fresh:
                # windows of a that b's padding left alone were counted; b's own rest stands alone
                sums, bins = sums + sums_b[:fresh], bins + bins_b[:fresh]
        else:
            sums, bins = sums_a + sums_b, bins_a + bins_b
        order = sorted(range(len(sums)), key=sums.__getitem__, reverse=True)
        sums = [sums[i] for i in order]
        spread = sums[0] - (sums[-1] if len(sums) == k else 0)
        heapq.heappush(heap, (-spread, tie, sums, [bins[i] for i in order]))
        tie += 1
    out = []
    for tree in heap[0][3]:
        items, todo = [], [tree]
        while todo:
            t = todo.pop()
            if isinstance(t, tuple):
                todo.extend(t)
            else:
                items.append(t)
        out.append(items)
    return out


def pack_bucket(lengths: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(window number, offset) of each piece of a bucket, all shorter than a window."""
    number, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    sizes = [int(x) for x in lengths]
    k = -(-sum(sizes) // window)
    parts: list[list[int]] = []
    while sizes:
        parts = difference(sizes, k)
        if max(sum(sizes[i] for i in p) for p in parts) <= window:
            break
        k += 1
    for j, part in enumerate(parts):
        at = 0
        for i in sorted(part):
            number[i], offset[i] = j, at
            at += sizes[i]
    return number, offset


def pack(pieces: DataFrame, window: int = WINDOW, bucket_windows: int = BUCKET_WINDOWS) -> DataFrame:
    """``pieces`` (doc_id, start, length, ...) plus sequence_id and offset.
    ``pieces`` must give the same rows in the same partitions whenever it is read
    (a stored frame does): a row is known by its place there."""
    total = pieces.where(F.col("length") < window).agg(F.sum("length")).first()[0] or 0
    buckets = max(1, -(-total // (window * bucket_windows)))
    names = pieces.columns
    placed = pieces.withColumn("_place", F.monotonically_increasing_id())

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("length", "descending"), ("_place", "ascending")])
        number, offset = pack_bucket(rows.column("length").to_numpy(), window)
        return pa.table({"_place": rows.column("_place"), "sequence_id": number * buckets + key[0].as_py(), "offset": offset})

    # only places and lengths are grouped; ids meet their place by a join, without a sort
    short = placed.where(F.col("length") < window)
    bucket = F.pmod(F.xxhash64("_place"), F.lit(buckets))
    numbered = (short.select("_place", "length", bucket.alias("_bucket")).groupBy("_bucket")
                .applyInArrow(run, "_place bigint, sequence_id bigint, offset bigint"))
    mixed = short.join(numbered.hint("shuffle_hash"), "_place").select(*names, "sequence_id", "offset")
    # a full window is a sequence of its own, numbered by its place above all bucket numbers
    full = placed.where(F.col("length") >= window).select(
        *names, (F.lit(_FULL) + F.col("_place")).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    return mixed.unionByName(full)


def pack_documents(docs: DataFrame, tokenizer: str | None = None, window: int = WINDOW) -> DataFrame:
    """``(doc_id, start, length, ids, doc_tokens, sequence_id, offset)``."""
    pieces = durable(token_pieces(docs, tokenizer, window))
    return pack(pieces, window).select("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")


def sequences(packed: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """``(sequence_id, n_tokens, ids)``: the windows of packed pieces, ``ids`` (binary)
    padded to ``window`` ids."""
    pad = np.array([pad_id], "<u4").tobytes()

    def join(key: tuple, rows: pa.Table) -> pa.Table:
        ids = b"".join(rows.sort_by("offset").column("ids").to_pylist())
        return pa.table({"sequence_id": [key[0].as_py()], "n_tokens": pa.array([len(ids) // 4], pa.int64()),
                         "ids": pa.array([ids + pad * (window - len(ids) // 4)], pa.binary())})

    return (packed.select("sequence_id", "offset", "ids").groupBy("sequence_id")
            .applyInArrow(join, "sequence_id bigint, n_tokens bigint, ids binary"))
