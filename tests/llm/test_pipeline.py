import collections
import os
import sys

import corpus_pipeline as cp
import numpy as np
import pytest
from fixtures import LABELS, corpus, documents, empty, groups, labels, words
from test_near_duplicates import brute_fingerprint
from test_tables import digested, pieces_by_brute_force, targets_by_brute_force

from textgraph.llm import mixing, quality, toxicity
from textgraph.llm.features import text_features
from textgraph.llm.queries import all_queries

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))


def written(spark, tmp_path, rows):
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels(rows), LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_stages_equal_brute_force(spark, tmp_path):
    rows = corpus(300)
    sf_dir = written(spark, tmp_path, rows)
    marks = spark.createDataFrame(labels(rows), LABELS)
    docs = documents(spark, rows)
    now = [tuple(r) for r in docs.collect()]
    names = docs.columns

    # toxicity: the model's own weights, applied by hand
    model = toxicity.train(docs, marks)

    def chance(text):
        s = sum(model["weights"].get(f, 0.0) for w in toxicity.letter_words(text) for f in toxicity.word_features(w))
        return 1 / (1 + np.exp(model["thresholds"][0] - s))

    now = [r for r in now if chance(r[1]) < toxicity.REJECT_FROM]
    out = cp.drop_toxic(spark, docs, sf_dir)
    assert out.columns == names and sorted(map(tuple, out.collect()), key=str) == sorted(now, key=str)
    docs = documents(spark, now)

    weights = quality.train(docs, marks)

    def good(text):
        i, v = text_features(None if text is None else text.encode())
        return 1 / (1 + np.exp(-(float(weights[i] @ v) + float(weights[-1])))) >= 0.3

    now = [r for r in now if good(r[1])]
    out = cp.keep_quality(spark, docs, sf_dir)
    assert out.columns == names and sorted(map(tuple, out.collect()), key=str) == sorted(now, key=str)
    docs = documents(spark, now)

    fps = [brute_fingerprint(r[1]) for r in now]
    root = groups(len(now), [(i, j) for i in range(len(now)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3])
    first = {}
    for r, g in zip(now, root):
        if g not in first or (r[0] is None, r[0] or 0) < (first[g][0] is None, first[g][0] or 0):
            first[g] = r
    now = list(first.values())
    out = cp.drop_near_duplicates(spark, docs, sf_dir)
    assert out.columns == names and sorted(map(tuple, out.collect()), key=str) == sorted(now, key=str)
    docs = documents(spark, now)

    sizes = collections.Counter()
    for r in now:
        sizes[r[3]] += len(words(r[1]))
    target = targets_by_brute_force(sizes)
    copies = {(r.doc_id, r.text): r.copies for r in mixing.mix_sources(docs).collect()}
    out = cp.mix(spark, docs, sf_dir)
    mixed = [tuple(r) for r in out.collect()]
    assert out.columns == names
    assert collections.Counter(mixed) == collections.Counter({r: copies[r[:2]] for r in now if copies[r[:2]]})
    for r in now:
        rate = target[r[3]] / sizes[r[3]] if sizes[r[3]] else 0
        assert int(rate) <= copies[r[:2]] <= int(rate) + 1
    docs = documents(spark, mixed)

    out = cp.pack(spark, docs, sf_dir).collect()
    assert sorted([digested(r) for r in out], key=str) == sorted(pieces_by_brute_force(mixed), key=str)


def test_run_and_queries_over_tables(spark, tmp_path):
    sf_dir = written(spark, tmp_path, corpus(80))
    out = cp.run(spark, sf_dir)
    assert out.columns == ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    assert out.count() > 0 and all(len(r.ids) == 4 * r.length for r in out.collect())
    assert [n for n, _ in cp.STAGES] == ["toxicity", "quality", "near_duplicates", "mixing", "packing"]
    assert len(all_queries()) == 14 and all(n == "pipeline" or n[:2] == "op" for n in all_queries())


def test_empty_corpus(spark, tmp_path):
    empty(spark).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    assert cp.run(spark, str(tmp_path)).collect() == []


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.001"), reason="driver tables not present")
def test_sql_of_the_expressible_queries(spark):
    from oracle_check import compare, duck

    from textgraph.llm.queries import all_sql
    sf_dir = "/root/testdata/sf0.001"
    assert {v[0] for v in compare(spark, sf_dir, list(all_sql()), verbose=False).values()} == {"ok"}
    names = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "int": "INTEGER", "boolean": "BOOLEAN"}
    con = duck(sf_dir)
    for name, sql in all_sql().items():
        got = {f.name: names[f.dataType.simpleString()] for f in all_queries()[name](spark, sf_dir).schema.fields}
        assert got == {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}, name
