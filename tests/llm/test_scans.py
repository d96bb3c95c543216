"""Automaton search, conversation repair and license scans against brute force."""

import collections
import functools
import hashlib
import itertools
import math
import random
import re
import zlib

import pytest
from fixtures import corpus, documents, empty, sentence

from textgraph.llm import conversations as cv
from textgraph.llm import licenses, scan

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- ranked search -----------------------------------------------------------

def terms_of(text):
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(ASCII))


def ranked(docs, items, top):
    held = [(d, collections.Counter(t), len(t)) for d, t in ((d, terms_of(x)) for d, x in docs) if t]
    n, total = len(held), sum(h[2] for h in held)
    df = collections.Counter(w for _, c, _ in held for w in c)
    out = []
    for item, text in items:
        scores = []
        for d, c, size in held:
            m = 100 - 75 + (75 * size * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * ((10**9 * c[w]) // (1000 * c[w] + 8 * m))
                    for w in terms_of(text) if w in c)
            if s > 0:
                scores.append((-s, (d is not None, d or 0), d))
        out += [(item, i + 1, d, -s) for i, (s, _, d) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=str)


def test_search_equals_brute_force(spark, monkeypatch):
    docs = [(r[0], r[1]) for r in corpus(150)]
    docs += [(900 + i, x) for i, x in enumerate(["ÉCLAIR éclair x1 1x", "a" * 5000, "the the THE-the_the", "née,née"] * 2)]
    docs.append((990, " ".join(["the", "ing"] * 30_000)))             # a very long text
    rng = random.Random(4)
    items = [(i, sentence(rng, 12)) for i in range(9)]
    items += [(20, "the"), (21, None), (22, " .. "), (23, "zzzz-unseen"), (24, items[0][1]), (24, items[0][1]), (None, "née the"),
              (25, "née née the"), (26, "a" * 5000)]
    d = spark.createDataFrame([(*r, "x", 1) for r in docs], "doc_id bigint, text string, item_id string, score int")
    q = spark.createDataFrame([(*r, 5) for r in items], "item_id bigint, text string, doc_id int")
    want = ranked(docs, items, 10)
    got = scan.rank_documents(d, q)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == want
    # items in blocks, small matrices and early settling change nothing
    monkeypatch.setattr(scan, "_BATCH", 50)
    monkeypatch.setattr(scan, "_KEPT", 30)
    assert sorted(map(tuple, scan.rank_documents(d, q, block_bytes=400).collect()), key=str) == want


def test_search_of_nothing(spark):
    items = spark.createDataFrame([(1, "the")], "item_id bigint, text string")
    assert scan.rank_documents(empty(spark), items).collect() == []
    assert scan.rank_documents(documents(spark), items.limit(0)).collect() == []
    blank = spark.createDataFrame([(1, None), (2, " ")], "doc_id bigint, text string")
    assert scan.rank_documents(blank, items).collect() == []


def test_automaton_is_guarded():
    automaton = scan.automaton_of([b"a", b"ab", b"b", "é".encode()])
    low = scan.plain("a ab,AB b-a abé é".encode())
    assert scan.term_counts(low, automaton) == {0: 2, 1: 2, 2: 1, 3: 1} and scan.term_total(low) == 7
    assert scan.term_total(b"") == 0 and scan.term_total(scan.plain(b" x")) == 1


# --- conversations -----------------------------------------------------------

def repaired(rows):
    """{conv: result} by dynamic programming over whole repairs."""
    convs = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        shown = lambda x: " " if x is None else str(x)
        role, text = shown(role), shown(text)
        h = zlib.crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20
        now = convs[conv]
        if h == 0:
            continue
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        now += [(turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    out = {}
    for conv, now in convs.items():
        now.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults = set(), []
        for _, role, text in now:
            shown = text.strip(" \t\n\x0b\x0c\r")
            faults.append(1 if not shown else 2 if (role, text) in seen else 3 if shown[-1] not in ".!?" else 0)
            seen.add((role, text))
        turns = [r[0] for r in now if r[0] is not None]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(now))
        best = {"": (0, "", ())}                       # initials so far, by what may follow: the state
        state = lambda s: s if s in ("", "s") else s[-1]

        def grown(best):
            out = dict(best)
            for _ in range(2):
                for s, (c, a, lines) in list(out.items()):
                    role = "assistant" if s == "u" else "user"
                    new = (c + 5, a + "I", (*lines, role + ":"))
                    if role[0] not in out or new < out[role[0]]:
                        out[role[0]] = new
            return out

        for (_, role, text), fault in zip(now, faults, strict=True):
            after = {}

            def offer(s, new, after=after):
                if s not in after or new < after[s]:
                    after[s] = new
            for s, (c, a, lines) in grown(best).items():
                offer(s, (c + 2, a + "D", lines))
                if fault in (1, 2):
                    continue
                more = 5 if fault == 3 else 0
                fits = "a" if s == "u" else "u"
                offer(fits, (c + 1 + more, a + "R", (*lines, f"{'assistant' if fits == 'a' else 'user'}:{text}")))
                if role[:1] == fits or (role[:1] == "s" and s == ""):
                    offer(state(role[:1]), (c + more, a + "K", (*lines, f"{role}:{text}")))
            best = after
        cost, audit, lines = min(v for s, v in grown(best).items() if s in ("", "a"))
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count(1), faults.count(2), faults.count(3),
                     illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


CONV = "conv_id bigint, turn bigint, role string, text string, audit string, cost int"


def talks(seed: int, convs: int = 60, most: int = 14):
    rng, rows = random.Random(seed), []
    for conv in range(convs):
        for turn in range(rng.randint(0, most)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(["yes.", "no!", "cut off", "", " \t", None, "é?", "a\nb.", f"n{rng.random()}.", f"m{rng.random()}"])
            rows.append((conv, rng.choice([turn, turn, turn + 1, None]), role, text))
    rows += [(None, 1, "user", "hi."), (None, None, "assistant", "ho."), (10**9, 2**60, "user", "far."), (10**9, -5, "user", "near.")]
    rows += [(77, 3, "user", "again.")] * 40            # repeated rows
    return rows


def found(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], CONV)
    got = cv.repair_conversations(df, **kw).collect()
    assert len(got) == len({r.conv_id for r in got})
    return {r.conv_id: tuple(r)[1:] for r in got}


def test_repair_equals_brute_force(spark):
    rows = talks(1)
    want = repaired(rows)
    assert found(spark, rows) == want
    # every conversation cut into segments of two rows, over several tasks
    assert found(spark, rows, segment_rows=2) == want


def test_repair_of_a_hot_conversation(spark):
    """A third of all rows in one conversation: cut into segments, traced in parallel."""
    rng = random.Random(9)
    hot = [(5, t, rng.choice(["user", "assistant", "system"]), rng.choice(["yes.", "no", f"{t}.", f"{t}"])) for t in range(3000)]
    rows = hot + talks(2, 20)
    assert found(spark, rows, segment_rows=300) == repaired(rows)


def test_repair_of_nothing_and_of_dropped_rows(spark):
    assert found(spark, []) == {}
    dropped = [(c, t, "user", "x.") for c in range(200) for t in range(1) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]
    want = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert dropped and found(spark, dropped) == {r[0]: want for r in dropped}


@pytest.mark.parametrize("seed", range(30))
def test_auction_distances(seed):
    """Prices after the auction are distances; segment distances compose."""
    rng = random.Random(seed)
    steps = [rng.choice([(rng.choice("suat"), rng.random() < 0.3), rng.randint(1, 3)]) for _ in range(rng.randint(0, 40))]

    @functools.cache
    def distance(i, s):
        if i == len(steps):
            return cv._END[s]
        lattice = cv.Lattice([steps[i]], [0] * 4)
        own = lambda st: min(c + distance(j and i + 1, t) for _, c, j, t in lattice.arcs(0, st) if j)
        return min(own(s), cv.INSERT + own(cv._MADE[s]), 2 * cv.INSERT + own(cv._MADE[cv._MADE[s]]))

    assert cv.Lattice(steps, cv._END).price[0] == [distance(0, s) for s in range(4)]
    k = rng.randint(0, len(steps))
    first, second = (cv.distances(x) for x in (steps[:k], steps[k:]))
    whole = cv.distances(steps)
    for s, x in itertools.product(range(4), range(4)):
        through = [first[4 * s + m] + second[4 * m + x] for m in range(4) if first[4 * s + m] >= 0 and second[4 * m + x] >= 0]
        assert whole[4 * s + x] == min(through, default=-1)


# --- licenses ----------------------------------------------------------------

def license_words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(ASCII))


def scanned(text, templates=licenses.TEMPLATES, containment=licenses.CONTAINMENT):
    words = license_words(text)
    places = sorted((i, label) for p, label in licenses.PHRASES for i in range(len(words))
                    if words[i:i + len(p.split())] == p.split())
    base = {label for _, label in places}
    share, method = 0.0, set()
    for label, template in templates:
        t = set(license_words(template))
        for a in range(0, max(len(words) - licenses.STEP, 1), licenses.STEP):
            c = len(t & set(words[a:a + licenses.BLOCK])) / len(t)
            if c >= containment - 1e-12:
                method.add(label)
                share = max(share, c)
    starts = [i for i, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | method)), 1.0 if base else share)


def test_licenses_equal_brute_force(spark):
    rng = random.Random(3)
    rows = [(r[0], r[1]) for r in corpus(60)]
    for i, (_, template) in enumerate(licenses.TEMPLATES * 3):
        words = template.split()
        if i % 3 == 1:
            words.pop(rng.randrange(len(words)))                       # still, or just no longer, within the threshold
        if i % 3 == 2:
            rng.shuffle(words)
        rows.append((1000 + i, " ".join([sentence(rng, rng.randint(0, 70)), *words, sentence(rng, rng.randint(0, 70))])))
    rows += [(2000, "CC-BY cc by"), (2001, "cc by cc by"), (2002, "All rights reserved"), (2003, "xcc by"), (2004, "cc bya"),
             (2005, "General\nPublic..LICENSE é"), (2006, "éall rights reserved"), (None, "Released under the MIT License"),
             (2007, sentence(rng, 9000) + " Released under the MIT License " + sentence(rng, 9000))]
    rows += [rows[-1], rows[61]] * 2                                    # repeated rows
    df = spark.createDataFrame([(*r, "x", 2, 3) for r in rows], "doc_id bigint, text string, labels string, th int, did int")
    got = [tuple(r) for r in licenses.scan_licenses(df).collect()]
    assert sorted(got, key=str) == sorted(((d, *scanned(t)) for d, t in rows), key=str)
    assert any(r[6] and not r[5] for r in got) and sum(0 < r[7] < 1 for r in got)   # labels of the method alone, and partial matches


def test_license_templates_are_a_parameter(spark):
    rows = [(1, "alpha beta gamma delta"), (2, "alpha beta gamma"), (3, "alpha beta"), (4, None), (5, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    templates = (("greek", "Alpha beta, gamma: delta!"),)
    got = {r.doc_id: (r.labels, r.score) for r in licenses.scan_licenses(df, templates, 0.75).collect()}
    assert got == {1: ("greek", 1.0), 2: ("greek", 0.75), 3: ("", 0.0), 4: ("", 0.0), 5: ("", 0.0)}
    assert licenses.scan_licenses(df.limit(0)).collect() == []


def test_copies_of_a_notice_make_no_more_than_a_row_each(spark):
    """Many copies of one matching text: the join is of blocks with templates, never of rows with rows."""
    df = spark.range(20_000).selectExpr("id as doc_id", "'Released under the MIT License' as text")
    got = licenses.scan_licenses(df)
    assert got.count() == 20_000 and got.where("labels = 'mit' and score = 1").count() == 20_000
