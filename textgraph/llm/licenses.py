"""License scans: phrases, and an exact set-similarity join with templates.

A text's words are cut into blocks of ``BLOCK`` words that overlap by half, so
any passage of ``BLOCK - STEP`` words lies whole in one.  A block matches a
template if it holds at least ``CONTAINMENT`` of the template's distinct words.
The join is exact: words are ordered by how many documents hold them, rarest
first; a template needs ``o`` common words, so a match must share a word among
the first ``|T| - o + 1`` of the template and the first ``|B| - o + 1`` of the
block (prefix filter), the block must have ``o`` words at all (length filter), and
after the shared word enough must be left on both sides (positional filter).
Only words that some template holds can be common, so a block is the set of
those; documents without any word of a template's prefix are never cut at all.

All columns are built-in functions.  What is collected and broadcast is the
templates' vocabulary, a parameter of at most ``MOST_WORDS`` words; the rows of
matching documents are broadcast only when a count finds them few.

Defined cases: a null text is empty; a text without words has no place, no label
and score 0; rows that repeat id and text get equal results; a very long text
costs time and memory in proportion to its words (twice, for the overlap); other
columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textgraph.llm.common import durable, small_side

# The phrases of the base labels, and notices as licences or their
# users word them.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("gfdl", "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free "
             "Documentation License"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
)
BLOCK, STEP = 48, 24
CONTAINMENT = 0.9
MOST_WORDS = 100_000
SMALL = 200_000            # matching documents that may be broadcast
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def license_words(text: Column) -> Column:
    """The words in order, A-Z lower-cased; a null text has none."""
    low = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.array_remove(F.split(low, GAP), "")


def template_sets(templates=TEMPLATES, containment: float = CONTAINMENT) -> list[tuple[str, list[str], int]]:
    """(label, distinct words, needed common words) of each template."""
    out = []
    for label, text in templates:
        low = "".join(c if ord(c) >= 0x80 or c.isalnum() else " " for c in text.translate(str.maketrans(_UPPER, _LOWER)))
        words = sorted(set(low.split()))
        out.append((label, words, math.ceil(round(containment * len(words), 9))))
    if len({w for _, words, _ in out for w in words}) > MOST_WORDS:
        raise ValueError(f"more than {MOST_WORDS} words in the templates")
    return out


def _array(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def word_order(docs: DataFrame, words: list[str], text: str = "text") -> list[str]:
    """``words`` by the number of documents that hold them, rarest first."""
    held = docs.select(F.explode(F.array_intersect(license_words(F.col(text)), _array(words))).alias("w"))
    total = {r.w: r["count"] for r in held.groupBy("w").count().toLocalIterator()}
    return sorted(words, key=lambda w: (total.get(w, 0), w))


def block_sets(words: Column, vocabulary: list[str]) -> Column:
    """The blocks of a text as sets of ``vocabulary``, each in its order."""
    starts = F.sequence(F.lit(0), F.greatest(F.size(words) - F.lit(STEP + 1), F.lit(0)), F.lit(STEP))
    return F.transform(starts, lambda i: F.array_intersect(_array(vocabulary), F.slice(words, i + 1, BLOCK)))


def template_matches(docs: DataFrame, key: list[str], templates=TEMPLATES, containment: float = CONTAINMENT,
                     text: str = "text") -> DataFrame:
    """``(*key, label, containment)``: the best block of every row that meets the threshold for a template."""
    sets = template_sets(templates, containment)
    order = word_order(docs, sorted({w for _, words, _ in sets for w in words}), text)
    place = {w: i for i, w in enumerate(order)}
    prefixes = []
    for label, words, need in sets:
        ranked = sorted(words, key=place.__getitem__)
        prefixes += [(w, label, i, need, ranked) for i, w in enumerate(ranked[:len(ranked) - need + 1])]
    rows = [F.struct(F.lit(w).alias("word"), F.lit(label).alias("label"), F.lit(at).alias("at"), F.lit(need).alias("need"),
                     _array(ranked).alias("template")) for w, label, at, need, ranked in prefixes]
    side = F.broadcast(docs.sparkSession.range(1).select(F.inline(F.array(*rows))))

    words = docs.select(*key, license_words(F.col(text)).alias("words"))
    near = words.where(F.arrays_overlap("words", _array(sorted({p[0] for p in prefixes}))))
    least = min(need for _, _, need in sets)
    blocks = near.select(*key, F.explode(block_sets(F.col("words"), order)).alias("block")).where(F.size("block") >= least)
    shared = (blocks.select(*key, "block", F.posexplode(F.slice("block", F.lit(1), F.size("block") - (least - 1))).alias("pos", "word"))
              .join(side, "word"))
    size, need = F.size("block"), F.col("need")
    left = F.least(F.size("template") - F.col("at"), size - F.col("pos"))          # common words still possible, this one too
    candidates = shared.where((size >= need) & (F.col("pos") <= size - need) & (left >= need))
    common = F.size(F.array_intersect("template", "block"))
    return (candidates.select(*key, "label", "need", common.alias("common"), F.size("template").alias("of"))
            .where(F.col("common") >= F.col("need"))
            .groupBy(*key, "label").agg(F.max(F.col("common") / F.col("of")).alias("containment")))


def _phrase_columns(norm: Column, total: Column, phrases) -> tuple[Column, Column, Column, Column]:
    """(places, first start, last start, labels) of the phrases in a text whose
    words are joined, and surrounded, by single spaces."""
    count = lambda s: F.size(F.split(s, " ")) - 1
    places, firsts, lasts, labels = [], [], [], []
    for phrase, label in phrases:
        guarded, k = F.lit(f" {phrase} "), len(phrase.split())
        has = F.contains(norm, guarded)
        places.append(F.when(has, F.regexp_count(norm, F.lit(f"(?<= ){phrase}(?= )"))).otherwise(F.lit(0)))
        firsts.append(F.when(has, count(F.substring_index(norm, f" {phrase} ", 1))))
        lasts.append(F.when(has, total - count(F.substring_index(norm, f" {phrase} ", -1)) - k))
        labels.append(F.when(has, F.lit(label)))
    return (reduce(lambda a, b: a + b, places).cast("bigint"), F.array_min(F.array(*firsts)).cast("bigint"),
            F.array_max(F.array(*lasts)).cast("bigint"), F.array_compact(F.array(*labels)))


def scan_licenses(docs: DataFrame, templates=TEMPLATES, containment: float = CONTAINMENT, phrases=PHRASES) -> DataFrame:
    """``(doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score)`` of each row; ``score`` is the share of a template found (1 with a
    base label)."""
    keyed = docs.select("doc_id", F.coalesce("doc_id", F.lit(0)).alias("did"), F.col("doc_id").isNull().alias("dnull"),
                        F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"), "text")
    key = ["did", "dnull", "th"]
    found = durable(template_matches(keyed, key, templates, containment)
                    .groupBy(*key).agg(F.collect_set("label").alias("found"), F.max("containment").alias("share")))
    words = keyed.select("doc_id", *key, license_words(F.col("text")).alias("words"))
    norm = words.select("doc_id", *key, F.size("words").alias("total"),
                        F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" ")).alias("norm"))
    places, first, last, labels = _phrase_columns(F.col("norm"), F.col("total"), phrases)
    base = norm.select("doc_id", *key, F.col("total").cast("bigint").alias("n_words"), places.alias("n_base"),
                       first.alias("first_word"), last.alias("last_word"), labels.alias("base"))
    own = F.array_sort(F.array_distinct("base"))
    every = F.array_sort(F.array_union("base", F.coalesce("found", F.array().cast("array<string>"))))
    return base.join(small_side(found, SMALL), key, "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join(own, ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"))
