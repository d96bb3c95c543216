"""Ranked lexical search by scanning: no index of the documents is built.

The terms of all items form one Aho-Corasick automaton.  Every word of it is
guarded by the sign that separates terms, so it matches whole terms only; a
document is one walk of the automaton over its text, and the automaton's
outputs are the numbers of the terms.  A first pass keeps, per document, its
term total and the counts of the items' terms (in the shared folder); from
these come the corpus figures N, L and df.  A second pass maps the counts to
items and keeps the ten best documents of each item within every task, so
what is exchanged is ten rows per item and task, never pairs.

What is broadcast is bounded: distinct item texts are dealt to blocks of about
``BLOCK_BYTES`` and each block is scanned on its own (usually there is one).

Defined cases: a null text or one without terms is no document (it does not
count in N); an item without terms or without scoring documents has no rows;
items of equal text get equal rows each; rows that repeat a document are
documents of their own; ties go to the smaller id, a null id before all.
Very long texts are walked in place, memory grows with one text's bytes and
the distinct terms found.  Other columns of either table are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textgraph.llm.common import durable

TOP = 10
BLOCK_BYTES = 16 << 20     # item text behind one automaton
_BATCH = 1_000_000         # cells of a task's score matrix, and additions into it, at a time
_KEPT = 200_000            # candidates a task holds before it drops the beaten ones
# digits and bytes of other scripts stay, A-Z are lower-cased, all else separates terms
_LOWER = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).replace(
    bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B)))


def plain(text: bytes) -> bytes:
    """The text with lower-case A-Z and one space for every separator."""
    return text.translate(_LOWER)


def term_total(low: bytes) -> int:
    """Number of terms of a ``plain`` text."""
    signs = np.frombuffer(low, np.uint8) != 0x20
    return int(signs[:1].sum() + (signs[1:] & ~signs[:-1]).sum())


def automaton_of(terms: list[bytes]) -> ahocorasick.Automaton:
    """The guarded automaton; bytes are read as Latin-1, one sign each."""
    out = ahocorasick.Automaton()
    for i, term in enumerate(terms):
        out.add_word(f" {term.decode('latin-1')} ", i)
    out.make_automaton()
    return out


def term_counts(low: bytes, automaton: ahocorasick.Automaton) -> Counter:
    """{term number: occurrences} of a ``plain`` text."""
    if not len(automaton):
        return Counter()
    return Counter(map(itemgetter(1), automaton.iter(f" {low.decode('latin-1')} ")))


def count_terms(docs: DataFrame, terms: list[bytes], key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n, terms, tfs)`` of every row with a term: its term total, and the
    numbers and counts of the given terms."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = automaton_of(shared.value)
        for batch in batches:
            rows, totals, ids, tfs, ends = [], [], [], [], [0]
            for i, value in enumerate(batch.column(1)):
                low = plain(value.as_py() or b"")
                if total := term_total(low):
                    found = term_counts(low, automaton)
                    rows.append(i)
                    totals.append(total)
                    ids.extend(found.keys())
                    tfs.extend(found.values())
                    ends.append(len(ids))
            at = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(totals, pa.int64()),
                 pa.ListArray.from_arrays(at, pa.array(ids, pa.int32())),
                 pa.ListArray.from_arrays(at, pa.array(tfs, pa.int64()))], names=[key, "n", "terms", "tfs"])

    read = docs.select(F.col(key).cast("bigint").alias(key), F.col(text).cast("binary").alias("text"))
    return read.mapInArrow(scan, f"`{key}` bigint, n bigint, terms array<int>, tfs array<bigint>")


class _Best:
    """The best documents per item, of those offered so far."""

    def __init__(self, items: int, top: int) -> None:
        self.top, self.bar = top, np.zeros(items, np.int64)
        self.parts, self.size = [], 0

    def offer(self, item: np.ndarray, score: np.ndarray, named: np.ndarray, doc: np.ndarray) -> None:
        self.parts.append((item, score, named, doc))
        self.size += len(item)
        if self.size > _KEPT:
            self.settle()

    def settle(self) -> tuple:
        item, score, named, doc = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        order = np.lexsort((doc, named, -score, item))
        item, score, named, doc = item[order], score[order], named[order], doc[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        last = place == self.top - 1
        self.bar[item[last]] = score[last]
        kept = place < self.top
        self.parts = [(item[kept], score[kept], named[kept], doc[kept])]
        self.size = int(kept.sum())
        return self.parts[0]


def _best_documents(counted: DataFrame, key: str, model: dict, top: int) -> DataFrame:
    """``(item, key, score)``: each task's ``top`` documents of every item."""
    shared = counted.sparkSession.sparkContext.broadcast(model)

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        weight, start, item_of, times, items = m["weight"], m["start"], m["item"], m["times"], m["items"]
        fan, best = np.diff(start), _Best(items, top)
        for batch in batches:
            ids, n, terms, tfs = batch.columns
            named = np.asarray(ids.is_valid())
            doc = np.asarray(ids.fill_null(0))
            norm = 100 - 75 + (75 * np.asarray(n) * m["N"]) // m["L"]
            ends = np.asarray(terms.offsets).astype(np.int64)
            term, tf = np.asarray(terms.values), np.asarray(tfs.values)
            row = np.repeat(np.arange(len(n)), np.diff(ends))
            worth = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * norm[row]))
            adds = np.concatenate(([0], np.cumsum(fan[term])))[ends]     # additions before each document
            a = 0
            while a < len(n):
                b = max(a + 1, min(int(np.searchsorted(adds, adds[a] + _BATCH, "right")) - 1, a + max(1, _BATCH // items)))
                part = slice(ends[a], ends[b])
                t, each = term[part], fan[term[part]]
                at = np.repeat(start[t] - np.cumsum(each) + each, each) + np.arange(each.sum())
                score = np.zeros((b - a) * items, np.int64)
                np.add.at(score, np.repeat(row[part] - a, each) * items + item_of[at], np.repeat(worth[part], each) * times[at])
                score = score.reshape(b - a, items)
                i, j = np.nonzero((score > 0) & (score >= best.bar))
                best.offer(j, score[i, j], named[a + i], doc[a + i])
                a = b
        if best.size:
            item, score, named, doc = best.settle()
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(doc, pa.int64(), mask=~named),
                                              pa.array(score, pa.int64())], names=["item", key, "score"])

    return counted.mapInArrow(rank, f"item int, `{key}` bigint, score bigint")


def _model(texts: list[bytes]) -> tuple[list[bytes], dict]:
    """The distinct terms of the item texts, and for each term its items and how often they repeat it."""
    counts = [Counter(plain(t).split()) for t in texts]
    terms = sorted(set().union(*counts))
    number = {t: i for i, t in enumerate(terms)}
    links = sorted((number[t], i, k) for i, c in enumerate(counts) for t, k in c.items())
    term, item, times = np.array(links, np.int64).reshape(-1, 3).T
    return terms, {"start": np.searchsorted(term, np.arange(len(terms) + 1)), "item": item, "times": times, "items": len(texts)}


def rank_documents(docs: DataFrame, items: DataFrame, top: int = TOP, key: str = "doc_id", item: str = "item_id",
                   block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(item, rank, key, score)``: the ``top`` best documents of each row of
    ``items`` by integer BM25 over whole texts."""
    spark = docs.sparkSession
    asked = items.select(F.col(item), F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("_md5"),
                         F.coalesce("text", F.lit("")).cast("binary").alias("_text"))
    texts = asked.select("_md5", "_text").dropDuplicates(["_md5"])
    total = texts.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    best = None
    for block in range(blocks):
        mine = sorted(texts.where(F.pmod(F.xxhash64("_md5"), F.lit(blocks)) == block).toLocalIterator())
        terms, model = _model([bytes(r["_text"]) for r in mine])
        counted = durable(count_terms(docs, terms, key))
        figures = counted.agg(F.count(F.lit(1)).alias("N"), F.sum("n").alias("L")).first()
        model["N"], model["L"] = figures.N, figures.L or 1
        df = np.zeros(len(terms), np.int64)
        for r in counted.select(F.explode("terms").alias("t")).groupBy("t").count().toLocalIterator():
            df[r.t] = r["count"]
        model["weight"] = np.array([math.floor(1000 * math.log((2 * figures.N + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
        names = spark.createDataFrame(pa.table({"item": pa.array(range(len(mine)), pa.int32()),
                                                "_md5": pa.array([r["_md5"] for r in mine], pa.string())}))
        found = (_best_documents(counted, key, model, top) if mine and terms
                 else spark.createDataFrame([], f"item int, `{key}` bigint, score bigint"))
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first(key))
        ranked = (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
                  .join(F.broadcast(names), "item").drop("item"))
        best = ranked if best is None else best.unionByName(ranked)
    return asked.select(item, "_md5").join(best, "_md5").select(item, "rank", key, "score")
