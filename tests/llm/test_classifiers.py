import math
import zlib

import numpy as np
from fixtures import LABELS, corpus, documents, empty, labels
from fixtures import INSULTS

from textgraph.llm import quality, toxicity
from textgraph.llm.features import FollowTheLeader, sigmoid, text_features


def test_quality_scores_held_out_documents(spark):
    rows = corpus(400)
    docs, marks = documents(spark, rows), spark.createDataFrame(labels(rows), LABELS)
    got = quality.classify(docs, marks).collect()
    assert len(got) == len(rows)
    truth = {r[0]: r[1] for r in labels(rows)}
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    judged = [r for r in got if r.held_out and truth.get(r.doc_id) is not None]
    assert sum(r.predicted == truth[r.doc_id] for r in judged) / len(judged) >= 0.95


def test_quality_is_a_sparse_dot_product():
    index, value = text_features(b"one two two three!! 12")
    weights = np.arange((1 << 18) + 1, dtype=np.float32) / (1 << 18)
    assert math.isclose(sum(float(weights[i]) * float(v) for i, v in zip(index, value)), float(weights[index] @ value),
                        rel_tol=1e-5)
    assert len(text_features(None)[0]) == len(text_features(b" \n")[0]) == 0


def test_follow_the_leader_equals_its_textbook_form():
    rows = [(np.array([0, 2], np.uint32), np.array([1.0, 0.5], np.float32), 1),
            (np.array([1], np.uint32), np.array([2.0], np.float32), 0),
            (np.array([0, 1], np.uint32), np.array([0.3, 1.0], np.float32), 1)]
    model = FollowTheLeader(4, alpha=0.5, beta=1.0, l1=0.01, l2=0.1)
    model.learn(rows)
    z, n = [0.0] * 4, [0.0] * 4

    def weight(i):
        if abs(z[i]) <= 0.01:
            return 0.0
        return -(z[i] - math.copysign(0.01, z[i])) / ((1.0 + math.sqrt(n[i])) / 0.5 + 0.1)

    for index, value, y in rows:
        x = {**dict(zip(map(int, index), map(float, value))), 3: 1.0}
        w = {i: weight(i) for i in x}
        g0 = 1 / (1 + math.exp(-sum(w[i] * x[i] for i in x))) - y
        for i in x:
            g = g0 * x[i]
            z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / 0.5 * w[i]
            n[i] += g * g
    assert np.allclose(model.weights(), [weight(i) for i in range(4)], atol=1e-6)


def test_classifiers_without_rows_or_labels(spark):
    none = spark.createDataFrame([], LABELS)
    assert quality.classify(empty(spark), none).collect() == []
    assert toxicity.grade_documents(empty(spark), none).collect() == []
    some = documents(spark).limit(5)
    assert {r.score for r in quality.classify(some, none).collect()} == {0.5}
    assert {(r.expected_severity, r.toxic) for r in toxicity.grade_documents(some, none).collect()} == {(0.0, False)}


def test_toxicity_finds_insults_and_leaves_the_rest(spark):
    rows = corpus(400)
    got = toxicity.grade_documents(documents(spark, rows), spark.createDataFrame(labels(rows), LABELS)).collect()
    assert len(got) == len(rows)
    truth = {r[0]: any(w in (r[1] or "") for w in INSULTS) for r in rows}
    found = []
    for r in got:
        assert 0 <= r.expected_severity <= 2 and r.toxic == (r.p_toxic >= toxicity.REJECT_FROM)
        if r.held_out:
            assert truth[r.doc_id] or not r.toxic
            if truth[r.doc_id]:
                found.append(r.toxic)
    assert sum(found) >= 0.8 * len(found) > 0


def test_ordinal_fit_orders_grades_with_shared_weights():
    rng = np.random.default_rng(0)
    rows = []
    for _ in range(600):
        x = rng.integers(0, 6)
        grade = int(x + rng.normal(0, 0.3) > 1.5) + int(x + rng.normal(0, 0.3) > 3.5)
        rows.append((grade, np.array([0, 1]), np.array([x, rng.integers(0, 3)])))
    w, t = toxicity.fit_ordinal(rows, 2)
    assert t[0] < t[1] and w[0] > 5 * abs(w[1])
    severity = [sigmoid(w[0] * x - t).sum() for x in range(6)]
    assert severity == sorted(severity) and severity[0] < 0.3 and severity[5] > 1.7
