"""Text operators against a brute-force model on random small tables."""

import re
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from textgraph.functions.text import LINE_TOTAL_KEY, SPLIT_TOTAL_KEY
from textgraph.operators import index as ix
from textgraph.operators import text as tx
from textgraph.sources.lines import lines_of_texts

ALPHABET = "ab Z,\t\n\r\f\x0b."
texts = st.lists(st.text(alphabet=ALPHABET, max_size=30), min_size=1, max_size=6)


def model_tokens(t):
    return [x for x in re.split("[ \t\n\r\f]+", t) if x]


def model_lines(t):
    if t == "":
        return 0
    parts = re.split("\r\n|\n|\r", t)
    return len(parts) - (1 if parts[-1] == "" else 0)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts)
def test_against_model(spark, docs):
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string")
    toks = {i: model_tokens(t) for i, t in enumerate(docs)}
    words = Counter(w for ts in toks.values() for w in ts)
    assert {r.word: r.n for r in tx.word_count(df, "text").collect()} == dict(words)
    pairs = Counter(f"{a} {b}" for ts in toks.values() for a, b in zip(ts, ts[1:]))
    assert {r.bigram: r.n for r in tx.bigram_count(df, "text").collect()} == dict(pairs)
    lines = sum(model_lines(t) for t in docs)
    assert tx.line_count(df, "text", rows_are_lines=False).first().n == lines
    assert lines_of_texts(df, "text", ["doc_id"]).count() == lines
    wct = {r.word: r.n for r in tx.word_count_with_total(df, "text", rows_are_lines=False).collect()}
    assert wct == dict(words + Counter({LINE_TOTAL_KEY: lines})) or (lines == 0 and wct.get(LINE_TOTAL_KEY) == 0)
    bt = {r.bigram: r.n for r in tx.bigram_count_with_total(df, "text", ["doc_id"]).collect()}
    assert bt == {**dict(pairs), SPLIT_TOTAL_KEY: len(docs)}
    posts = Counter((w, i) for i, ts in toks.items() for w in ts)
    got = {(r.word, r.doc_id): r.n for r in ix.term_postings(df, "text", "doc_id").collect()}
    assert got == dict(posts)
    idx = {(r.word, r.block): r.postings for r in ix.inverted_index(ix.term_postings(df, "text", "doc_id"),
                                                                     "doc_id", block_size=2).collect()}
    want = {}
    for (w, i), n in sorted(posts.items(), key=lambda kv: (kv[0][0], kv[0][1])):
        want[(w, i // 2)] = want.get((w, i // 2), "") + f"{i}:{n};"
    assert idx == want
