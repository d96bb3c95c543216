"""Sketches, packing, scores, mixing, sharding and URL filter against brute force."""

import collections
import hashlib
import itertools
import math
import random
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from fixtures import corpus, documents, empty, sentence, words
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from textgraph.llm import brown, mixing, packing, sharding, simhash, sketch, urls
from textgraph.llm.common import durable, hashed_sample, labelled_sample, whole_order


def test_whole_order_numbers_distinct_rows(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(500), rng.randrange(3)) for _ in range(1000)]
    got = whole_order(spark.createDataFrame(rows, "a bigint, b int").repartition(7), "a", "b").collect()
    assert sorted((r.ordinal, r.a, r.b) for r in got) == [(i, *r) for i, r in enumerate(sorted(set(rows)))]


def test_hashed_sample_is_bounded_and_stable(spark):
    df = spark.range(5000)
    few = sorted(r.id for r in hashed_sample(df, F.col("id"), 300, "id").collect())
    assert len(few) == 300 and few == sorted(r.id for r in hashed_sample(df.repartition(9), F.col("id"), 300, "id").collect())
    assert abs(np.mean(few) - 2500) < 400
    assert hashed_sample(df, F.col("id"), 6000, "id").count() == 5000


def test_most_frequent_words_are_bounded(spark):
    rows = [(f"w{i}".encode(), 1 + 1000 // (i + 1)) for i in range(500)]
    counts = spark.createDataFrame(rows, "word binary, n bigint")
    got = brown.most_frequent(counts, 50)
    assert 30 <= len(got) <= 50 and got == sorted(rows, key=lambda r: (-r[1], r[0]))[:len(got)]
    assert brown.most_frequent(counts, 0) == [] and len(brown.most_frequent(counts, 500)) == 500


@pytest.mark.parametrize("same", [b"", b"alike", b"a longer beginning "])
def test_most_frequent_fills_a_flat_vocabulary(spark, same):
    rows = [(same + f"{i:04d}".encode(), n) for i, n in enumerate([1000] * 30 + [1] * 400 + [1001] * 5)]
    counts = spark.createDataFrame(rows, "word binary, n bigint")
    for most in (20, 34, 35, 36, 100, 435):
        assert brown.most_frequent(counts, most) == sorted(rows, key=lambda r: (-r[1], r[0]))[:most]


# --- sketches ---------------------------------------------------------------

def test_edited_fingerprints(spark):
    rows = corpus()
    got = sketch.edited_fingerprints(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    # an id that repeats does so with its text; null comes first
    distinct = sorted({(r[0] is not None, r[0] or 0, r[1] or "") for r in rows})
    after = {d[:2]: distinct[(i + 1) % len(distinct)][2] for i, d in enumerate(distinct)}
    prints = {}
    for r in got:
        text = next(x[1] or "" for x in rows if x[0] == r.doc_id)
        q, following = len(text) // 4, after[(r.doc_id is not None, r.doc_id or 0)]
        edited = text[:len(text) - q] + following[:q]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        for t, p in ((text, r.fingerprint), (edited, r.edited_fingerprint)):
            assert prints.setdefault(t, p) == p and bool(p) == bool(t.split())
        a, b = ({p[i:i + 16] for i in range(0, len(p), 16)} for p in (r.fingerprint, r.edited_fingerprint))
        assert math.isclose(r.near_edited, len(a & b) / len(a | b) if a | b else 1.0)
        if text == edited:
            assert r.near_edited == 1.0
        assert 0 <= r.near_next <= 1 and 0 <= r.in_next <= 1
    assert sketch.edited_fingerprints(empty(spark)).collect() == []


def retained(text):
    """The sketch of a text, from XXH64 chained over the words of each shingle (seed 42)."""
    words = text.split()
    hashes = set()
    for i in range(max(1, len(words) - 4)) if words else []:
        h = 42
        for w in words[i:i + 5]:
            h = xxhash.xxh64_intdigest(w.encode(), h)
        hashes.add(h - (1 << 64) if h >> 63 else h)
    limit = -(1 << 63) + (1 << 64) // 8
    return sorted(h for h in hashes if h < limit) or sorted(hashes)[:1]


def test_sketch_estimates_likeness_and_containment(spark):
    rng = random.Random(8)
    a = [f"w{rng.randrange(10**6)}" for _ in range(20_000)]
    rows = [(1, " ".join(a)), (2, " ".join(a[:4000])), (3, " ".join(a[:15_000] + [x + "x" for x in a[15_000:]])),
            (4, "three words only"), (5, "one two three four five"), (6, "")]
    df = sketch.with_sketch(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id: r.sketch for r in df} == {i: retained(text) for i, text in rows}
    s = {r.doc_id: set(r.sketch) for r in df}
    limit = -(1 << 63) + (1 << 64) // 8
    assert all(max(s[i]) < limit for i in (1, 2, 3)) and abs(len(s[1]) - 20_000 / 8) < 250
    assert len(s[2] & s[1]) / len(s[2]) == 1.0                       # short in long
    assert abs(len(s[2] & s[1]) / len(s[1]) - 0.2) < 0.03
    assert abs(len(s[3] & s[1]) / len(s[3] | s[1]) - 0.6) < 0.03
    # the merged sketch is the sketch of all documents together
    parts = sketch.with_sketch(spark.createDataFrame([(0, r[1]) for r in rows[1:3]], "g int, text string"))
    merged = sketch.merge_sketches(parts, "g").collect()[0].sketch
    assert merged == sorted(s[2] | s[3])


def test_merging_is_linear_in_the_words(spark):
    """200,000 words merge in the time of a few times 50,000."""
    def seconds(n):
        text = " ".join(f"v{i * 7919 % 1000003}" for i in range(n))
        parts = sketch.with_sketch(spark.createDataFrame([(0, text), (0, text[:100])], "g int, text string"))
        begun = time.perf_counter()
        assert sketch.merge_sketches(parts, "g").collect()[0].sketch == sorted(set(retained(text)) | set(retained(text[:100])))
        return time.perf_counter() - begun
    seconds(1000)
    short, long = seconds(50_000), seconds(200_000)
    assert long < 8 * short + 5


def test_labelled_sample_of_a_hot_id(spark):
    """A labelled id with very many label and document rows neither crowds others out nor swells the sample."""
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5]
    hot = ids[3]
    docs = spark.createDataFrame([(i, f"text {i}") for i in ids], "doc_id bigint, text string").unionByName(
        spark.range(5000).select(F.lit(hot).cast("bigint").alias("doc_id"), F.concat(F.lit("copy "), (F.col("id") % 50).cast("string")).alias("text")))
    marks = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id bigint, quality int").unionByName(
        spark.range(20_000).select(F.lit(hot).cast("bigint").alias("doc_id"), F.lit(1).alias("quality")))
    got = labelled_sample(docs, marks, "quality", 100).collect()
    assert 60 <= len(got) <= 100 and sum(r.doc_id == hot for r in got) <= 2
    assert sorted(map(tuple, labelled_sample(docs, marks, "quality", 100).collect())) == sorted(map(tuple, got))


# --- packing ----------------------------------------------------------------

def pieces_by_brute_force(rows):
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out = []
    for doc_id, text, *_ in rows:
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        out += [(doc_id, a, len(ids[a:a + 4096]), zlib.crc32(ids[a:a + 4096].tobytes()), len(ids))
                for a in range(0, len(ids), 4096)]
    return out


def digested(r):
    """A packed row as the query returns it, up to its place."""
    return (r.doc_id, r.start, r.length, zlib.crc32(r.ids), r.doc_tokens)


def test_packing_round_trip(spark):
    rows = corpus()
    got = packing.pack_documents(documents(spark, rows)).collect()
    assert sorted([digested(r) for r in got], key=str) == sorted(pieces_by_brute_force(rows), key=str)
    by = collections.defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 4096
    total = sum(r.length for r in got)
    assert len(by) <= -(-total // 4096) + 1
    assert packing.pack_documents(empty(spark)).collect() == []


def test_sequences_are_whole_windows(spark):
    rows = corpus()
    packed = packing.pack(durable(packing.token_pieces(documents(spark, rows))), bucket_windows=2)
    got = packed.collect()
    assert sorted([digested(r) for r in got], key=str) == sorted(pieces_by_brute_force(rows), key=str)
    want = collections.defaultdict(bytes)
    for r in sorted(got, key=lambda r: r.offset):
        want[r.sequence_id] += r.ids
    assert all(len(x) <= 4 * 4096 for x in want.values())
    whole = {r.sequence_id: (r.n_tokens, r.ids) for r in packing.sequences(packed).collect()}
    assert whole == {i: (len(x) // 4, x.ljust(4 * 4096, b"\0")) for i, x in want.items()}


def test_equal_rows_with_null_ids_pack_in_many_groups(spark):
    """100,000 equal rows: their pieces are dealt over all buckets, evenly."""
    docs = spark.range(100_000).select(F.lit(None).cast("bigint").alias("doc_id"), F.lit("all of these " * 4).alias("text"))
    pieces = durable(packing.token_pieces(docs.repartition(6)))
    got = durable(packing.pack(pieces, bucket_windows=8).select("sequence_id", "length"))
    total, rows, windows = got.agg(F.sum("length"), F.count("*"), F.count_distinct("sequence_id")).first()
    buckets = -(-total // (4096 * 8))
    per = [r["count"] for r in got.groupBy(F.col("sequence_id") % buckets).count().collect()]
    assert rows == 100_000 and len(per) == buckets > 30 and max(per) < 1.2 * rows / buckets
    assert windows <= 1.15 * (total / 4096)
    assert got.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0] <= 4096


def test_long_words_are_not_remembered():
    path = public_tokenizers.path("word_bpe_49k.json")
    t, encoder = Tokenizer.from_file(path), packing.WordEncoder(path)
    texts = ["ab " + "x1" * 4000 + " cd", "q" * 9000, "ab"]
    for text, ids in zip(texts, encoder.encode([x.encode() for x in texts]), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == t.encode(text, add_special_tokens=False).ids
    assert max(map(len, encoder.known)) <= packing.LONG_WORD and b"ab" in encoder.known


def test_word_encoder_equals_the_tokenizer_on_odd_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    t, rng = Tokenizer.from_file(path), random.Random(2)
    parts = ["it's", "IT'S", "don't!!", "ab***", "ab—*", "é́x", "e\u0301", "ẞ", "İ", "Σας", "a.b", "x9y", "12,", "<|endoftext|>",
             "<|ENDOFTEXT|>", "\u00a0", "\u2003q", "😀a!", "ﬁ", "\x1c", "\x85", "'", "''s", "a'", "#a#", "ñ,", "“x”", "a…"]
    texts = [" ".join(rng.choices(parts, k=rng.randint(1, 8))) + rng.choice(["", "\n", "\t\x0b"]) for _ in range(400)]
    texts += ["".join(rng.choices(parts, k=6)) for _ in range(200)]
    encoder = packing.WordEncoder(path)
    texts.append(" ".join(parts) * 5)
    assert list(encoder.encode([None, b""])) == [b"", b""]
    for text, ids in zip(texts, encoder.encode([x.encode() for x in texts])):
        assert np.frombuffer(ids, "<u4").tolist() == t.encode(text, add_special_tokens=False).ids, repr(text)


def test_differencing_balances():
    assert packing.difference([8, 7, 6, 5, 4], 1) == [[0, 1, 2, 3, 4]]
    rng = random.Random(3)
    for k in (2, 3, 7, 40):
        sizes = [rng.randint(1, 4000) for _ in range(300)]
        parts = packing.difference(sizes, k)
        assert sorted(i for p in parts for i in p) == list(range(300)) and len(parts) == k
        sums = [sum(sizes[i] for i in p) for p in parts]
        assert max(sums) - min(sums) <= 0.01 * max(sums)
    number, offset = packing.pack_bucket(np.array([3000, 3000, 3000, 1]))
    assert len(set(number)) == 3 and max(number) == 2     # three cannot share two windows: the count rose


# --- language model ----------------------------------------------------------

def test_base_score_and_counts(spark):
    rows = corpus()
    counts, ends = collections.Counter(), 0
    held = [r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 2 for r in rows]
    for r, h in zip(rows, held):
        if not h:
            counts.update(words(r[1]))
            ends += 1
    tokens, vocabulary = sum(counts.values()) + ends, len(counts) + 1
    want = {}
    for r, h in zip(rows, held):
        w = words(r[1])
        base = sum(math.log10((counts[x] + 1) / (tokens + vocabulary + 1)) for x in w) \
            + math.log10((ends + 1) / (tokens + vocabulary + 1))
        want[r[0]] = (h, len(w) + 1, 1 + sum(x in counts for x in w), tokens, base)
    docs = documents(spark, rows)
    got = brown.score_documents(docs).collect()
    few = brown.score_texts(docs.select("doc_id", "text"), docs.where("doc_id is null or crc32(cast(cast(doc_id as string) "
                            "as binary)) % 7 <> 2").select("text"), head=20, buckets=7, common=30, classes=8).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows) == sorted(str(r.doc_id) for r in few)
    for r in got:
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:4]
        assert math.isclose(r.base_score, want[r.doc_id][4], rel_tol=1e-9) and r.score < 0
    for r in few:        # most words are joined instead of broadcast
        assert r.n_known == want[r.doc_id][2] and math.isclose(r.base_score, want[r.doc_id][4], rel_tol=1e-9)
    assert brown.score_documents(empty(spark)).collect() == []


def test_attested_words_outside_the_head_choose_their_class(spark):
    """Words of one ending share a bucket; their neighbours tell them apart."""
    rows = [(100 * i + j, f"the n{i:02d}xing to v{i:02d}ying" if j % 2 else f"to v{i:02d}ying the n{i:02d}xing")
            for i in range(30) for j in range(8)]
    rows += [(10_000 + i, f"the noun{i % 2} to verb{i % 2}" if i % 4 < 2 else f"to verb{i % 2} the noun{i % 2}") for i in range(400)]
    learn = spark.createDataFrame(rows, "doc_id bigint, text string")
    ask = spark.createDataFrame([(1, "the n07xing"), (2, "the v07ying"), (3, "to v11ying"), (4, "to n11xing")],
                                "doc_id bigint, text string")
    got = {r.doc_id: r.score for r in brown.score_texts(ask, learn.select("text"), head=6, buckets=1, classes=4).collect()}
    assert got[1] > got[2] + 0.3 and got[3] > got[4] + 0.3


def test_joined_words_score_as_broadcast_ones(spark):
    rows = [(i, " ".join(random.Random(i).choices([f"w{j}" for j in range(80)], k=60), ) + " " + "w0 w1 " * 9) for i in range(60)]
    rows += [rows[5], rows[5], (900, ""), (901, "unseen words only here"), (902, None)]
    rows.append((903, " ".join(f"w{j % 80} " + "y" * 5000 for j in range(700))))       # several blocks
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    some, every = (sorted((str(r.doc_id), r.n_known, round(r.score, 6)) for r in brown.score_texts(
        docs, docs.select("text").limit(10**6), head=2, buckets=5, common=c, classes=6).collect()) for c in (3, 10_000))
    assert some == every and len(some) == len(rows)


def test_contexts_are_one_row_a_word_and_classes_one_row_a_text(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choices([f"w{j}" for j in range(60)], k=rng.randint(0, 90))) for _ in range(80)] + ["w1 w2", "", "new w50"]
    rows = [(i, t, True, i < 70) for i, t in enumerate(texts)] + [(3, texts[3], True, True)] * 2 + [(None, None, True, False)]
    learn = spark.createDataFrame([(t,) for _, t, _, use in rows if use], "text string").coalesce(1)
    head, k = [b"w0", b"w1"], 5
    cls = np.array([0, 1, 2, 3, 3, 2, 4])                     # two head words, four buckets, the end
    unit = lambda w: cls[head.index(w) if w in head else 2 + zlib.crc32(w[-3:]) % 4]
    want = collections.defaultdict(list)
    for _, t, _, use in rows:
        line = [4, *(unit(w) for w in t.encode().split()), 4] if use else []
        for j, w in enumerate(t.encode().split() if use else ()):
            if w not in head:
                want[w].append(int(line[j] * k + line[j + 2]))
    met = brown.word_contexts(learn, head, 4, cls, 4).collect()
    # one row was made for each word and pair of neighbours
    assert {bytes(r.word): sorted(np.frombuffer(r.near, np.uint16).tolist()) for r in met} == {w: sorted(x) for w, x in want.items()}
    assert len(met) == len(want)

    table = [(f"w{j}".encode(), j + 1, j % 4) for j in range(60)]
    words = spark.createDataFrame(table, "word binary, n bigint, cls int").repartition(3)
    logs = np.log10(np.array([2.0, 3.0, 1.0, 8.0]))           # w0, w1, all others, the end
    got = brown.class_sequences(spark.createDataFrame(rows, "doc_id bigint, text string, ask boolean, learn boolean"), words,
                                {b"w0": 0, b"w1": 1}, logs * [1, 1, 0, 1], True, F.lit(2), 4).collect()
    of = {w: (n, c) for w, n, c in table}
    assert len(got) == len(texts) + 1 and sum(r.copies for r in got) == len(rows)
    for r in got:
        line = (texts[r.doc_id] if r.doc_id is not None else "").encode().split()
        n = [1 if w == b"w0" else 2 if w == b"w1" else of.get(w, (0, 2))[0] for w in line]
        assert list(r.seq) == [*(of.get(w, (0, 2))[1] for w in line), 4] and r.copies == (3 if r.doc_id == 3 else 1)
        assert r.known == 1 + sum(x > 0 for x in n)
        assert math.isclose(r.logs, math.log10(8) + sum(math.log10(x + 1) for x in n), rel_tol=1e-9)


def shuffled_rows(df):
    """Rows written by all exchanges of ``df``, which has run."""
    def walk(node):
        kind = node.getClass().getSimpleName()
        below = [node.children().apply(i) for i in range(node.children().size())]
        if kind == "AdaptiveSparkPlanExec":
            below.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            below.append(node.plan())
        own = node.metrics().apply("shuffleRecordsWritten").value() if kind == "ShuffleExchangeExec" else 0
        return own + sum(map(walk, below))

    return walk(df._jdf.queryExecution().executedPlan())


def test_rarer_words_and_unit_bigrams_are_shuffled_in_blocks(spark):
    """No row for each text and rarer word, nor for each pair of units."""
    table = [(f"r{j}".encode(), j % 5 + 1, j % 4) for j in range(6000)]
    texts = [" ".join(f"r{(i * 31 + j * 7) % 7000}" for j in range(i % 5 * 40)) for i in range(400)]     # r6000.. are in no table
    docs = spark.createDataFrame([(i, t, True, True) for i, t in enumerate(texts)],
                                 "doc_id bigint, text string, ask boolean, learn boolean").coalesce(2)
    words = spark.createDataFrame(table[::-1], "word binary, n bigint, cls int").coalesce(1)
    frame = brown.class_sequences(docs, words, {}, np.array([0.0, 1.0]), True, F.length("word") % 3, 4)
    of = {w.decode(): (n, c) for w, n, c in table}
    got = {r.doc_id: r for r in frame.collect()}
    for i, t in enumerate(texts):
        line = [of.get(w, (0, len(w) % 3)) for w in t.split()]
        assert list(got[i].seq) == [*(c for _, c in line), 4] and got[i].known == 1 + sum(n > 0 for n, _ in line)
        assert math.isclose(got[i].logs, 1 + sum(math.log10(n + 1) for n, _ in line), rel_tol=1e-9)
    # the texts three times, and the 1,000 words that no table holds once a block; not 31,600 pairs of text and word
    assert 1200 <= shuffled_rows(frame) < 1200 + 2 * 1000 + 100

    learn = docs.select("text")
    pairs = brown.unit_bigrams(learn, [b"r0", b"r7"], 3)
    unit = lambda w: [b"r0", b"r7"].index(w) if w in (b"r0", b"r7") else 2 + zlib.crc32(w[-3:]) % 3
    want = collections.Counter(p for t in texts for line in [[5, *map(unit, t.encode().split()), 5]] for p in zip(line, line[1:]))
    met = pairs.collect()
    assert {(r.u, int(v)): int(n) for r in met for v, n in zip(np.frombuffer(r.v, np.int32), np.frombuffer(r.n, np.int64))} == want
    assert len(met) == 6 and shuffled_rows(pairs) <= 12


def test_model_is_a_distribution(spark):
    """Over all one- and two-token texts of a small vocabulary the known part sums to below one, nearly to it."""
    rows = [(i, t) for i, t in enumerate(["a b", "a b", "b a", "a", "b b a", "c"] * 20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    every = [""] + [" ".join(x) for n in (1, 2, 3, 4, 5, 6, 7) for x in itertools.product("abc", repeat=n)]
    ask = spark.createDataFrame(list(enumerate(every)), "doc_id bigint, text string")
    got = brown.score_texts(ask, docs.select("text"), head=3, buckets=2, classes=2).collect()
    mass = sum(10 ** r.score for r in got)
    assert 0.85 < mass < 1.0


def test_exchange_recovers_classes():
    rng = np.random.default_rng(0)
    kinds = np.array([0] * 10 + [1] * 10 + [2])            # two kinds of units that alternate, and the end
    line, kind = [20], 0
    for _ in range(6000):
        line.append(int(rng.choice(np.nonzero(kinds == kind)[0])))
        kind = 1 - kind
        if rng.random() < 0.05:
            line.append(20)
    pairs, n = np.unique(np.array(line[:-1]) * 21 + np.array(line[1:]), return_counts=True)
    cls, grid = brown.exchange(pairs // 21, pairs % 21, n, 21, classes=2)
    assert len(set(cls[:10])) == 1 and len(set(cls[10:20])) == 1 and cls[0] != cls[10] and cls[20] == 2
    assert grid.sum() == len(line) - 1


# --- mixing -----------------------------------------------------------------

def targets_by_brute_force(sizes):
    order = sorted([s for s in sizes if s is not None], key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    target, free, left = {}, set(order), sum(sizes.values())
    while free:
        share = left / sum(weight[s] for s in free)
        above = {s for s in free if weight[s] * share > 3 * sizes[s]}
        if not above:
            target |= {s: weight[s] * share for s in free}
            break
        target |= {s: 3 * sizes[s] for s in above}
        left, free = left - sum(3 * sizes[s] for s in above), free - above
    return target


def test_mixing(spark):
    rows = corpus(400)
    sizes = collections.Counter()
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    target = targets_by_brute_force(sizes)
    mixed = mixing.mix_sources(documents(spark, rows))
    got = mixed.collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.size == len(words(r.text)) and r.source_size == sizes[r.source]
        assert math.isclose(r.target, target[r.source], rel_tol=1e-9, abs_tol=1e-9)
        rate = r.target / r.source_size if r.source_size else 0
        assert r.copies in (math.floor(rate), math.floor(rate) + 1) and r.copies <= 3 and r.taken == r.copies * r.size
    assert sorted(map(str, mixing.mix_sources(documents(spark, rows).repartition(5)).collect())) == sorted(map(str, got))
    assert mixing.emit_copies(mixed).count() == sum(r.copies for r in got)
    assert mixing.mix_sources(empty(spark)).collect() == []


def test_draws_are_even(spark):
    u = [r[0] for r in spark.range(20_000).select(mixing.draw(F.col("id"), "s")).collect()]
    assert abs(np.mean(u) - 0.5) < 0.01 and abs(np.mean(np.array(u) < 0.2) - 0.2) < 0.01 and 0 <= min(u) and max(u) < 1


# --- sharding ---------------------------------------------------------------

@pytest.mark.parametrize("copies", [0, 900])
def test_sharding(spark, copies):
    rng = random.Random(6)
    rows = corpus() + [(10_000 + i, "word " * rng.randint(5, 80), "en", "s", 0, 0.0, "") for i in range(1500)]
    rows += [(50_000 + i, "one text that very many documents share", "en", "s", 0, 0.0, "") for i in range(copies)]
    got = sharding.shard_documents(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    shards = collections.defaultdict(list)
    for r in got:
        shards[r.shard].append(r)
    assert all(sorted(r.slot for r in rs) == list(range(len(rs))) for rs in shards.values()) and set(shards) <= set(range(40))
    data = {r[0]: (r[1] or "").encode() for r in rows}
    assert all(r.size == len(data[r.doc_id]) + 16 and r.text_crc32 == zlib.crc32(data[r.doc_id]) for r in got)
    assert {(r.law, r.grown_shard) for r in got} == {("bytes", None)}
    # but for the longest document's shard, sizes are nearly equal
    sums = sorted(sum(r.size for r in rs) for rs in shards.values())
    assert len(shards) == 40 and sums[-2] < 1.15 * sums[0]
    assert sharding.shard_documents(empty(spark)).collect() == []


def test_place_prefers_the_highest_dot_product():
    v = np.array([[4, 1.0], [4, 1], [1, 4], [1, 4]])
    shard = sharding.place(v, 2, pull=(1.0, 1.0))
    assert sorted(shard.tolist()) == [0, 0, 1, 1] and abs(np.bincount(shard, v[:, 0]) - 5).max() == 0


# --- URLs -------------------------------------------------------------------

URLS = ["https://a.example.com/en/1", "https://www.example.com/en/1?x=/es/", "http://m.www.example.com/en/", "https://EXAMPLE.com/fr/2",
        "https://x.net/es/1", "https://y.x.net/fr/2#top", "http://x.net/en/3", "https://com/", "https://com", "https://telecom/x",
        "http://host.org?q=a://b.com/", "http://host.org#f", "no scheme", "", None, "ftp://Ä.Net/es/ü", "a://b://c/d", "https://x.com/a?b#c",
        "http://x.net/es/1"]


def parsed(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    path = rest[cut:]
    path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut]), path


def ruled(host, path):
    best = None
    for rule, _ in urls.RULES:
        name, slash, rest = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith(slash + rest) and len(rule) > len(best or ""):
            best = rule
    return best


def scores_by_brute_force(pages):
    """Mean log-ratio of every URL, and the cut."""
    import re
    said = [dict(urls.RULES).get(ruled(*parsed(u))) for u in pages]
    line = ["^^^^" + re.sub(r"[^a-z0/._?=&%#:+~-]", "*", re.sub("[0-9]", "0", (u or "").lower())) + "$" for u in pages]
    n = {v: collections.Counter() for v in ("allow", "block")}
    for s, v in zip(line, said):
        for e in range(4, len(s)):
            for k in range(5):
                if v:
                    n[v][(s[e - k:e], s[e])] += 1
    ctx = {v: collections.Counter() for v in n}
    for v in n:
        for (c, _), m in n[v].items():
            ctx[v][c] += m

    def chance(v, c, x):
        if not c:
            return (n[v][("", x)] + 1) / (ctx[v][""] + len(urls.SYMBOLS))
        below = chance(v, c[1:], x)
        if not any(ctx[w][c] and ctx[w][c] * urls.CONTEXT_SHARE >= ctx[w][""] for w in n):
            return below
        return (n[v][(c, x)] + urls.BACKOFF * below) / (ctx[v][c] + urls.BACKOFF)

    mean = [sum(math.log(chance("allow", s[e - 4:e], s[e])) - math.log(chance("block", s[e - 4:e], s[e]))
                for e in range(4, len(s))) / (len(s) - 4) for s in line]
    (am, asd), (bm, bsd) = [(np.mean(x), np.std(x)) for x in
                            ([m for m, s in zip(mean, said) if s == v] for v in ("allow", "block"))]
    return said, mean, (am * bsd + bm * asd) / (asd + bsd)


def test_urls_equal_brute_force(spark):
    rng = random.Random(4)
    pages = URLS + [f"http{rng.choice(['', 's'])}://{rng.choice('abcde')}{rng.randrange(9)}.example.{rng.choice(['com', 'net', 'org'])}/"
                    f"{rng.choice(['en', 'fr', 'es'])}/{rng.randrange(999)}" for _ in range(300)] * 2
    said, mean, cut = scores_by_brute_force(pages)
    table = spark.createDataFrame([(i, u, "clash", "clash") for i, u in enumerate(pages)], "page_id bigint, url string, host string, n string")
    got = sorted(urls.filter_urls(table).collect(), key=lambda r: r.page_id)
    assert len(got) == len(pages)
    for r, u, v, m in zip(got, pages, said, mean):
        assert (r.host, r.path) == parsed(u) and r.rule == ruled(r.host, r.path)
        if v:
            assert r.verdict == v and r.score is None
        else:
            assert abs(r.score - (m - cut)) < 2e-6, u
            assert abs(m - cut) < 1e-9 or r.verdict == ("allow" if m >= cut else "block")


def test_urls_without_rows_or_training(spark):
    schema = "page_id bigint, url string"
    assert urls.filter_urls(spark.createDataFrame([], schema)).collect() == []
    got = urls.filter_urls(spark.createDataFrame([(1, "http://x.org/a"), (None, None)], schema)).collect()
    assert [(r.rule, r.verdict) for r in got] == [(None, "allow")] * 2


# --- repeated rows, names that clash, long inputs ------------------------------

def _law(rows, shards):
    """Sizes near equal, slots gapless."""
    by = collections.defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
    sizes = [sum(r["size"] for r in by[s]) for s in range(shards)]
    assert all(sorted(r.slot for r in x) == list(range(len(x))) for x in by.values())
    return sizes


def test_sharding_spreads_repeated_rows_and_null_ids(spark):
    """4,000 rows with null id and one text beside 8,000 others; an id repeated 3,000 times."""
    rng = random.Random(6)
    rows = [(None, "the same text " * 2)] * 4000 + [(7, "hot row " * 4)] * 3000
    rows += [(100 + i, sentence(rng, rng.randint(1, 60))) for i in range(5000)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id bigint, text string, shard int, count string")
    got = sharding.shard_documents(docs).collect()
    want = collections.Counter((d, len(t.encode()) + 16, zlib.crc32(t.encode())) for d, t in rows)
    assert collections.Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    sizes = _law(got, 40)
    assert max(sizes) <= 1.02 * min(sizes)
    whole = sharding.shard_texts(docs).collect()
    assert collections.Counter((r.doc_id, r.text) for r in whole) == collections.Counter(rows)
    assert sorted((r.shard, r.slot) for r in whole) == sorted((r.shard, r.slot) for r in got)
    copies = {r.shard for r in got if r.doc_id == 7}
    assert len(copies) > 10                                     # a large group is spread


def test_place_equals_an_independent_packing():
    rng = np.random.default_rng(5)
    vectors = rng.integers(1, 1000, (300, 3)).astype(float)
    got = sharding.place(vectors, 7)
    total = vectors.sum(axis=0)
    left = [[1 / 7] * 3 for _ in range(7)]
    for i in sorted(range(300), key=lambda i: (-max(p * v / t for p, v, t in zip(sharding.PULL, vectors[i], total)), i)):
        unit = [v / t for v, t in zip(vectors[i], total)]
        dots = [sum(p * u * r for p, u, r in zip(sharding.PULL, unit, shard)) for shard in left]
        best = max(range(7), key=lambda s: (round(dots[s], 15), -s))
        assert abs(dots[got[i]] - dots[best]) < 1e-12
        left[got[i]] = [r - u for r, u in zip(left[got[i]], unit)]


def test_names_that_clash_are_kept(spark):
    names = ["_source", "_copy", "_did", "_dnull", "_th", "_url", "_host", "_path", "_rule", "_verdict", "_score", "digest", "_SOURCE2"]
    rows = [(i, f"some words here {i // 2}", f"s{i % 3}", f"http://a{i}.com/x", *range(len(names))) for i in range(12)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", "source", "url", *names])
    mixed = mixing.emit_copies(mixing.mix_sources(docs, prefix="m_"), "m_copies")
    assert set(names) <= set(mixed.columns) and all(tuple(r[n] for n in names) == tuple(range(len(names))) for r in mixed.collect())
    kept = simhash.representatives(docs)
    assert kept.columns == docs.columns and kept.count() == 6
    judged = urls.filter_urls(docs)
    assert set(names) <= set(judged.columns) and judged.count() == 12
    assert all(tuple(r[n] for n in names) == tuple(range(len(names))) for r in judged.collect())


def test_long_urls_take_time_in_proportion(spark):
    base = [(i, f"http://h{i}.{'com' if i % 2 else 'net'}/{'es' if i % 4 == 0 else 'q'}/{i}") for i in range(40)]

    def seconds(n):
        rows = [*base, (99, "http://x.org/" + "ab1/" * (n // 4))]
        begun = time.perf_counter()
        got = urls.filter_urls(spark.createDataFrame(rows, "page_id bigint, url string")).where("page_id = 99").first()
        assert got.path == rows[-1][1][12:] and got.rule is None
        return time.perf_counter() - begun
    seconds(100)
    short, long = seconds(25_000), seconds(100_000)
    assert long < 4 * short + 5
    # pieces overlap by the context, so their grams are those of the whole
    text = "^" * 4 + "abcde" * 300 + "$"
    df = spark.createDataFrame([(text,)], "symbols string")
    got = collections.Counter(r.gram for r in urls.grams(df).collect())
    assert got == collections.Counter(text[e - k:e] for e in range(5, len(text) + 1) for k in range(1, 6))


def test_contexts_of_a_rare_class_are_kept(spark):
    """One rejected URL among very many accepted ones keeps its contexts."""
    pages = spark.range(30_000).select("id", F.concat(F.lit("http://w.com/"), (F.col("id") % 97).cast("string")).alias("url")) \
        .unionByName(spark.range(3).select("id", F.lit("http://zz.net/es/qqq").alias("url")))
    d = pages.groupBy("url").agg(F.count("*").alias("n")).withColumn("symbols", urls.symbols_of(F.col("url"))) \
        .withColumn("verdict", F.when(F.col("url").contains(".net"), "block").otherwise("allow"))
    assert urls.ratio_model(d).where("gram = 'qqqq$'").count() == 0 < urls.ratio_model(d).where("gram = 'qqq$'").count()


def test_a_known_word_is_looked_up_once():
    """Texts of known words take one lookup a word (two before); new words are filled in."""
    class Counting(dict):
        lookups = 0

        def get(self, *a):
            self.lookups += 1
            return super().get(*a)

        def __contains__(self, word):
            self.lookups += 1
            return super().__contains__(word)

        def __getitem__(self, word):
            self.lookups += 1
            return super().__getitem__(word)

    encoder = packing.WordEncoder(public_tokenizers.path(packing.TOKENIZER))
    words = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]
    first = list(encoder.encode([" ".join(words).encode()]))
    encoder.known = Counting(encoder.known)
    texts = [" ".join(words[k:]).encode() for k in range(0, 200, 20)]
    again = list(encoder.encode(texts))
    assert again[0] == first[0] and encoder.known.lookups == sum(range(20, 201, 20))
    mixed, = encoder.encode([b"wordaa unseen, wordba unseen, <x"])
    alone = b"".join(b"".join(encoder.encode([w])) for w in (b"wordaa", b"unseen,", b"wordba", b"unseen,", b"<x"))
    assert mixed == alone
