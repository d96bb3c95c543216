"""Toxicity: cumulative-link ordinal regression over sparse word features.

Severity grades are ordered: 0 clean, 1 toxic, 2 toxic with many words
associated with toxicity.  One weight vector ``w`` is shared by all
thresholds ``t_0 < t_1``:

    P(grade > k) = sigmoid(w.x - t_k),   expected severity = sum_k P(grade > k)

Features are a document's distinct letter words, each by itself and by its
prefixes of four to six characters (insults are inflected and compounded);
``x`` counts the distinct words that have a feature, so a document's score is
a sum over its distinct words.

Training reads the labelled rows outside the held-out fold, at most
``SAMPLE`` of them.  Document frequencies per class are counted with
``groupBy``; the ``FEATURES`` most associated features (signed root of the
likelihood ratio against equal rates, at least ``LEAST_Z``) stay.  The labels only say toxic or not, so a toxic
row's grade is 2 where it counts more associated features than the median of
the toxic rows, else 1.  The fit (one task over the bounded sample)
minimises the ordinal likelihood by AdaGrad.  Scoring is one pass without a
shuffle; what is broadcast is at most ``FEATURES`` weighted strings.

Defined cases: null and empty texts have severity of the thresholds alone
(clean); without labels, or without both classes among them, every severity
is 0; of an id with several texts the one of the smallest hash is an example, a
label repeated counts once, both labels count; an empty table gives no rows; a very
long text is scored word by word; other columns pass through (name the scores
otherwise where one is called as they are).
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textgraph.llm.common import LONG_WORD, durable, held_out, labelled_sample, remember_for
from textgraph.llm.features import sigmoid

SAMPLE = 20_000
FOLDS, FOLD = 5, 0
FEATURES = 4096
LEAST_DOCS = 4             # a feature must occur in so many toxic rows
LEAST_Z = 4.5
PREFIXES = (4, 5, 6)
GRADES = 3
REJECT_FROM = 0.4          # toxic from this probability of grade 1 or more
ROUNDS = 1000
CACHE = 500_000
_WORD = re.compile(r"[^\W\d_]+")


def letter_words(text: str | None) -> set[str]:
    """Distinct lower-cased words of letters."""
    if not text:
        return set()
    low = text.lower()
    return set(_WORD.findall(low)) if len(low) < 1 << 22 else {m.group() for m in _WORD.finditer(low)}


def word_features(word: str) -> list[str]:
    return [word, *[word[:k] + "-" for k in PREFIXES if len(word) >= k]]


class _Scores(dict):
    """word -> sum of its features' weights, remembered within a bound."""

    def __init__(self, weights: dict[str, float]) -> None:
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        value = sum(self.weights.get(f, 0.0) for f in word_features(word))
        if len(self) >= CACHE:
            self.clear()
        if len(word) <= LONG_WORD:
            self[word] = value
        return value


def fit_ordinal(rows: list[tuple[int, np.ndarray, np.ndarray]], size: int, rounds: int = ROUNDS,
                l2: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) of the cumulative-link model; ``rows``: (grade,
    feature indices, counts)."""
    y = np.array([r[0] for r in rows])
    at = np.repeat(np.arange(len(rows)), [len(r[1]) for r in rows])
    index = np.concatenate([r[1] for r in rows]) if rows else np.empty(0, int)
    count = np.concatenate([r[2] for r in rows]).astype(float) if rows else np.empty(0)
    w, seen = np.zeros(size), np.full(size, 1e-8)
    shares = np.array([(y > k).mean() for k in range(GRADES - 1)]).clip(1e-4, 1 - 1e-4)
    t = np.log((1 - shares) / shares)
    t = np.maximum.accumulate(t + np.arange(GRADES - 1) * 1e-3)
    t_seen = np.full(GRADES - 1, 1e-8)
    n, rows_at = len(rows), np.arange(len(rows))
    for _ in range(rounds):
        s = np.bincount(at, w[index] * count, minlength=n)
        over = np.concatenate([np.ones((n, 1)), sigmoid(s[:, None] - t), np.zeros((n, 1))], axis=1)
        upper, lower = over[rows_at, y], over[rows_at, y + 1]
        p = np.maximum(upper - lower, 1e-9)
        ds = (1 - upper - lower) / n
        g = -np.bincount(index, ds[at] * count, minlength=size) + l2 * w
        slope = over * (1 - over)
        gt = np.array([(np.where(y == k + 1, slope[:, k + 1] / p, 0) - np.where(y == k, slope[:, k + 1] / p, 0)).sum() / n
                       for k in range(GRADES - 1)])
        seen += g * g
        t_seen += gt * gt
        w -= g / np.sqrt(seen)
        t -= 0.5 * gt / np.sqrt(t_seen)
        t = np.maximum.accumulate(t + np.arange(GRADES - 1) * 1e-6)
    return w, t


def train(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> dict:
    """``{"weights": {feature: weight}, "thresholds": [...]}``."""
    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remember_for("toxicity", dict)
        for batch in batches:
            found = [sorted(letter_words(t.as_py())) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found, pa.list_(pa.string()))],
                                             ["o", "y", "words"])

    sample = durable(labelled_sample(docs, labels, "toxic", most, FOLDS, FOLD)
                     .select(F.xxhash64("doc_id", "text").alias("o"), "text", "y")
                     .mapInArrow(words, "o bigint, y int, words array<string>"))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: tuple[Counter, Counter] = (Counter(), Counter())
            for y, found in zip(batch.column(1).to_pylist(), batch.column(2)):
                seen[1 if y else 0].update({f for w in found.as_py() for f in word_features(w)})
            names = list(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), *[pa.array([c[f] for f in names], pa.int64()) for c in seen]],
                ["feature", "clean", "toxic"])

    total = {bool(r.y): r.n for r in sample.groupBy((F.col("y") != 0).alias("y")).agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(total) < 2:
        return {"weights": {}, "thresholds": []}
    rows = float(total[True] + total[False])
    seen = F.col("clean") + F.col("toxic")
    part = lambda c, n: F.when(F.col(c) > 0, F.col(c) * F.log(F.col(c) / (seen * (n / rows)))).otherwise(0.0)
    ratio = F.sqrt(F.greatest(2 * (part("toxic", total[True]) + part("clean", total[False])), F.lit(0.0)))
    z = F.when(F.col("toxic") / total[True] > F.col("clean") / total[False], ratio).otherwise(-ratio)
    chosen = (sample.mapInArrow(frequencies, "feature string, clean bigint, toxic bigint")
              .groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
              .where(F.col("toxic") >= LEAST_DOCS).select("feature", z.alias("z"))
              .where(F.abs("z") >= LEAST_Z).orderBy(F.desc(F.abs("z")), "feature").limit(FEATURES).collect())
    slots = {r.feature: i for i, r in enumerate(chosen)}
    signs = np.array([r.z > 0 for r in chosen], bool)

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [Counter(slots[f] for w in ws.as_py() for f in word_features(w) if f in slots)
                     for ws in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([sorted(c) for c in found], pa.list_(pa.int32())),
                 pa.array([[c[i] for i in sorted(c)] for c in found], pa.list_(pa.int32()))],
                ["o", "y", "i", "c"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(bool(y), np.array(i, np.int64), np.array(c, np.int64))
                for b in batches for y, i, c in zip(*[b.column(k).to_pylist() for k in range(1, 4)])]
        hits = np.array([c[signs[i]].sum() for _, i, c in rows])
        toxic = np.array([r[0] for r in rows], bool)
        middle = np.median(hits[toxic]) if toxic.any() else 0.0
        grades = np.where(toxic, 1 + (hits > middle), 0)
        w, t = fit_ordinal([(g, i, c) for g, (_, i, c) in zip(grades, rows)], len(slots))
        yield pa.RecordBatch.from_arrays([pa.array([json.dumps([w.tolist(), t.tolist()])])], ["model"])

    row = (sample.mapInArrow(select, "o bigint, y int, i array<int>, c array<int>")
           .repartition(1).sortWithinPartitions("o", "y").mapInArrow(fit, "model string")).first()
    w, t = json.loads(row.model)
    return {"weights": {f: w[i] for f, i in slots.items() if w[i]}, "thresholds": t}


def score_toxicity(docs: DataFrame, model: dict, keep: list[str],
                   out: tuple[str, str] = ("p_toxic", "expected_severity")) -> DataFrame:
    """The columns ``keep`` of ``docs`` plus the probability of a grade above 0
    and the expected severity, named ``out``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    columns = [*keep, *([] if "text" in keep else ["text"])]
    at = columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remember_for("toxicity", dict)
        scores, t = _Scores(shared.value["weights"]), np.array(shared.value["thresholds"])
        for batch in batches:
            s = np.array([sum(map(scores.__getitem__, letter_words(x.as_py()))) for x in batch.column(at)], float)
            over = sigmoid(s[:, None] - t) if len(t) else np.zeros((len(s), 1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(keep)], pa.array(over[:, 0]), pa.array(over.sum(axis=1))],
                [*keep, *out])

    docs = docs.select(*columns)
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields[:len(keep)],
                                              *[T.StructField(c, T.DoubleType()) for c in out]]))


def grade_documents(docs: DataFrame, labels: DataFrame, learn_from: DataFrame | None = None) -> DataFrame:
    """``(doc_id, held_out, p_toxic, expected_severity, severity, toxic)``;
    severity is the expected one rounded to a grade."""
    model = train(docs if learn_from is None else learn_from, labels)
    return score_toxicity(docs, model, ["doc_id"]).select(
        "doc_id", held_out(F.col("doc_id"), FOLDS, FOLD).alias("held_out"), "p_toxic", "expected_severity",
        F.round("expected_severity").cast("int").alias("severity"),
        (F.col("p_toxic") >= REJECT_FROM).alias("toxic"))
