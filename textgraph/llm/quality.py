"""Quality classifier: hashed word n-gram logistic regression, trained with
follow-the-regularised-leader updates and scored as sparse dot products.

Training reads the labelled rows outside the held-out fold, at most
``SAMPLE`` of them (chosen by a hash of the id; the one documented bound).
Their feature vectors are computed in parallel and sent to one task, which
makes ``PASSES`` passes of updates in hash order; what comes back is the
weight vector, ``4 << BITS`` bytes whatever the input.  Scoring is one pass
over the documents without a shuffle.  Only the text is an input.

Defined cases: a null or empty text has no features and the score of the
bias alone; without any labelled row the score is 0.5; a label repeated counts
once, both labels of a document count, and of an id with several texts the one of the
smallest hash is the example; null labels are not examples; an empty table gives no
rows; a very long text is featurised in blocks of words; ``score_quality`` passes any other columns through (name
the score otherwise where one of them is called ``score``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textgraph.llm.common import held_out, labelled_sample
from textgraph.llm.features import BITS, FollowTheLeader, begin_task, sigmoid, text_features

SAMPLE = 20_000
PASSES = 2
FOLDS, FOLD = 5, 0
KEEP_FROM = 0.3            # predicted 1 from this score on


def train(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> np.ndarray:
    """The weights (float32, bias last)."""
    sample = labelled_sample(docs, labels, "quality", most, FOLDS, FOLD)

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_task()
        for batch in batches:
            found = [text_features(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([i.tobytes() for i, _ in found], pa.binary()),
                 pa.array([v.tobytes() for _, v in found], pa.binary())], ["o", "y", "i", "v"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(np.frombuffer(i, np.uint32), np.frombuffer(v, np.float32), y)
                for b in batches for y, i, v in zip(*[b.column(c).to_pylist() for c in (1, 2, 3)])]
        model = FollowTheLeader((1 << BITS) + 1)
        for _ in range(PASSES):
            model.learn(rows)
        yield pa.RecordBatch.from_arrays([pa.array([model.weights().astype(np.float32).tobytes()], pa.binary())], ["w"])

    vectors = (sample.select(F.xxhash64("doc_id", "text").alias("o"), F.col("text").cast("binary").alias("t"), "y")
               .mapInArrow(featurise, "o bigint, y int, i binary, v binary"))
    row = (vectors.repartition(1).sortWithinPartitions("o", "y").mapInArrow(fit, "w binary")).first()
    return np.frombuffer(row.w, np.float32) if row else np.zeros((1 << BITS) + 1, np.float32)


def score_quality(docs: DataFrame, weights: np.ndarray, keep: list[str], out: str = "score") -> DataFrame:
    """The columns ``keep`` of ``docs`` plus the score, named ``out``."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    columns = [*keep, *([] if "text" in keep else ["text"])]
    at = columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_task()
        w = shared.value
        for batch in batches:
            scores = np.empty(batch.num_rows)
            for i, text in enumerate(batch.column(at).cast(pa.binary())):
                index, value = text_features(text.as_py())
                scores[i] = float(w[index] @ value) + float(w[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], pa.array(sigmoid(scores))],
                                             [*keep, out])

    docs = docs.select(*columns)
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields[:len(keep)], T.StructField(out, T.DoubleType())]))


def classify(docs: DataFrame, labels: DataFrame, learn_from: DataFrame | None = None) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every document."""
    weights = train(docs if learn_from is None else learn_from, labels)
    scored = score_quality(docs, weights, ["doc_id"])
    return scored.select("doc_id", held_out(F.col("doc_id"), FOLDS, FOLD).alias("held_out"), "score",
                         (F.col("score") >= KEEP_FROM).cast("int").alias("predicted"))
