import random

import numpy as np
import xxhash
from fixtures import corpus, documents, empty, groups, words

from textgraph.llm import pivots, simhash
from textgraph.llm.common import word_blocks
from textgraph.llm.components import connected_components


def brute_fingerprint(text):
    w = words(text)
    shingles = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_word_blocks_equal_split():
    rng = random.Random(3)
    data = b"".join(rng.choice([b"a", b"bc", b" ", b"\n\t", b"\x0b", "é".encode()]) for _ in range(3000))
    for size in (1, 7, 64, 1 << 20):
        assert [w for b in word_blocks(data, size) for w in b] == data.split()
    assert list(word_blocks(None)) == list(word_blocks(b"")) == []


def test_simhash_of_long_text_in_blocks():
    text = " ".join(f"w{i % 977}" for i in range(300_000))
    assert len(text) > 1 << 20
    w = words(text)
    ones = np.zeros(64, int)
    for i in range(len(w) - 2):
        h = xxhash.xxh64_intdigest(b" ".join(w[i:i + 3]), 42)
        ones += [(h >> b) & 1 for b in range(64)] if i < 2000 else 0
    assert simhash.simhash(" ".join(text.split()[:2002]).encode()) == sum(1 << b for b in range(64) if ones[b] * 2 > 2000)
    whole = simhash.simhash(text.encode())
    assert whole == simhash.simhash(text.upper().encode())


def test_near_duplicates_equal_brute_force(spark):
    rows = corpus()
    base = rows[25][1].split()
    for k in range(30):                                  # near copies, one word apart each
        rows.append((1000 + k, " ".join(base[:k * 9] + ["edit"] + base[k * 9 + 1:]), "en", "hot", 1, 1.0, "x"))
    fps = [brute_fingerprint(r[1]) for r in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3]
    root = groups(len(rows), links)
    least = {g: min((r[0] for r, h in zip(rows, root) if h == g and r[0] is not None), default=None) for g in root}
    want = sorted(((r[0], f, least[g]) for r, f, g in zip(rows, fps, root)), key=str)
    docs = documents(spark, rows)
    for size in (4096, 5):                               # one tree per shard, or several
        got = simhash.near_duplicates(docs, tree_size=size).collect()
        assert sorted(((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in got), key=str) == want
    kept = simhash.representatives(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(v for v in set(least.values()))
    assert simhash.near_duplicates(empty(spark)).collect() == []
    assert simhash.representatives(empty(spark)).collect() == []


def test_bk_tree_follows_only_edges_within_the_radius():
    rng = np.random.default_rng(1)
    centre = rng.integers(0, 1 << 63, 20, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (20, 30, 2), dtype=np.uint64)
    values = np.unique(np.concatenate([centre, (centre[:, None] ^ flips[..., 0] ^ flips[..., 1]).ravel()]))
    tree = simhash.BKTree(values)
    for i, kids in enumerate(tree.children):
        assert all((tree.values[i] ^ tree.values[c]).bit_count() == d for d, c in kids.items())
    for radius in (0, 1, 3):
        got = {(i, int(q)) for i, near in tree.search(values, radius) for q in near}
        want = {(i, j) for i in range(len(values)) for j in range(len(values))
                if (int(values[i]) ^ int(values[j])).bit_count() <= radius}
        assert got == want


def test_connected_components_of_paths_stars_and_repeats(spark):
    rng = random.Random(5)
    nodes = rng.sample(range(-10**6, 10**6), 300)
    links = [(nodes[i], nodes[i + 1]) for i in range(99)]            # a path
    links += [(nodes[100], nodes[i]) for i in range(101, 200)]       # a star
    links += [(nodes[i], nodes[rng.randrange(200, 300)]) for i in range(200, 260)] * 2
    links += [(nodes[0], nodes[0])]
    rng.shuffle(links)
    at = {v: i for i, v in enumerate(sorted(nodes))}
    order = sorted(nodes)
    root = groups(len(nodes), [(at[a], at[b]) for a, b in links])
    linked = {v for a, b in links if a != b for v in (a, b)}
    got = connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    assert {(r.node, r.component) for r in got} == {(v, order[root[at[v]]]) for v in linked}
    assert len(got) == len(linked)
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def vectors():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 16))
    rows = []
    for i in range(240):
        c = centres[rng.integers(40)] if i % 3 else centres[0]       # a third near one vector
        v = (c + rng.normal(size=16) * rng.choice([0.02, 0.06, 0.5])).astype(np.float32)
        rows.append((5 * i, [float(x) for x in v], int(rng.integers(3)) if i % 4 else 1, "x"))
    rows[7] = (rows[7][0], rows[8][1], rows[8][2], "x")              # equal vectors
    rows[9] = (rows[9][0], [2.0 * x for x in rows[8][1]], rows[8][2], "x")
    rows += [(5001, None, 1, "x"), (5002, [0.0] * 16, 1, "x"), (5003, [float("nan")] + [1.0] * 15, 1, "x"),
             (5004, [None] + [1.0] * 15, 1, "x"), (5005, rows[8][1], None, "x"), (5006, [float("inf")] * 16, 1, "x"),
             (5007, [], 1, "x"), (5008, [1.0, 2.0], 1, "x"), (None, rows[8][1], rows[8][2], "x"), rows[12]]
    return rows


def test_embeddings_equal_brute_force(spark):
    rows = vectors()

    def vector(r):
        v = r[1]
        if r[2] is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v, np.float32).astype(float)
        return v / np.linalg.norm(v)

    unit = [vector(r) for r in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if unit[i] is not None and unit[j] is not None
             and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.98]
    count = np.bincount(np.array(links).ravel(), minlength=len(rows))
    root = groups(len(rows), links)
    least = {g: min((r[0] for r, h in zip(rows, root) if h == g and r[0] is not None), default=None) for g in root}
    want = sorted(((r[0], int(n), least[g], r[0] is not None and r[0] == least[g])
                   for r, n, g in zip(rows, count, root)), key=str)
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int, n_links string")
    assert len(links) > 300
    for block in (2048, 6):
        got = sorted(map(tuple, pivots.near_embeddings(table, pivots=24, block=block).collect()), key=str)
        assert len(got) == len(want)
        assert sum(r[1] for r in got) >= 0.9 * sum(r[1] for r in want)     # recall; no link below the cosine
        if sum(r[1] for r in got) == sum(r[1] for r in want):
            assert got == want
    assert pivots.near_embeddings(table.limit(0)).collect() == []


def test_pivots_stay_apart():
    rng = np.random.default_rng(4)
    near = rng.normal(size=16) + rng.normal(size=(500, 16)) * 0.05
    far = rng.normal(size=(100, 16))
    x = np.concatenate([near, far])
    chosen = pivots.choose_pivots(x / np.linalg.norm(x, axis=1, keepdims=True), 30)
    g = chosen @ chosen.T - 2 * np.eye(len(chosen))
    assert 5 < len(chosen) <= 30 and g.max() <= pivots.APART
