"""Small tables with the awkward cases, and brute-force helpers."""

import random

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, rule string"
LABELS = "doc_id bigint, quality int, toxic int, lang string"

_SYLLABLES = ["the", "an", "er", "ing", "on", "re", "th", "ion", "es", "or", "ti", "st"]
INSULTS = ["idiot", "moron", "scum", "clown"]


def sentence(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choices(_SYLLABLES, k=rng.randint(1, 3))) for _ in range(n))


def corpus(n: int = 120, seed: int = 1) -> list[tuple]:
    """Clean, junk and toxic texts; copies; empty, null and long ones; a hot source."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        text = sentence(rng, rng.randint(8, 60))
        if i % 5 == 1:
            text = " ".join(w + "***" for w in text.split())
        if i % 7 == 3:
            words = text.split()
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
            text = " ".join(words)
        rows.append((3 * i, text, "en", "hot" if i % 3 else f"s{i % 4}"))
    rows[10] = (rows[10][0], rows[4][1], "en", "hot")                     # a copy
    rows[20] = (rows[20][0], None, "en", None)
    rows[21] = (rows[21][0], "", None, "é")
    rows[22] = (rows[22][0], " \t\n\x0b ", "en", "hot")
    rows[23] = (rows[23][0], "one", "en", "hot")
    rows[24] = (rows[24][0], "Ünï çödé 😀 words <|endoftext|> it's A-Z", "en", "Z")
    rows[25] = (rows[25][0], sentence(rng, 6000), "en", "hot")
    rows.append(rows[30])                                                 # a repeated row
    rows.append((None, rows[31][1], "en", "hot"))                         # a null id
    return [(*r, len(r[1] or ""), 7.0, "clash") for r in rows]


def labels(rows: list[tuple]) -> list[tuple]:
    out = []
    for doc_id, text, *_ in rows:
        if doc_id is not None and text:
            out.append((doc_id, 0 if "***" in text else 1, int(any(w in text for w in INSULTS)), "x"))
    return [*out, (0, None, None, "x"), (None, 1, 1, "x"), (10**9, 1, 0, "x")]


def documents(spark, rows=None):
    return spark.createDataFrame(corpus() if rows is None else rows, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def words(text) -> list[bytes]:
    return (text or "").encode().translate(bytes.maketrans(
        b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")).split()


def groups(n: int, links) -> list[int]:
    """Smallest index reachable from each of 0..n-1."""
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]
