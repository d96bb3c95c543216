"""Hashed word n-grams of a text, and FTRL-trained logistic regression.

A text's words (A-Z lower-cased) and their *shapes* -- letters, digits and
punctuation as classes, runs kept short -- give four families of n-grams:
words, word pairs, shapes, shape pairs; whether a word repeats the one
before it is part of its shape, and the share of repeated word pairs gives
one further gram.  Every gram is hashed into ``1 << bits`` buckets.  A
family's values are square roots of relative frequencies, so each family is a
vector of length one however long the text is.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable

import numpy as np

from textgraph.llm.common import LONG_WORD, remember_for, word_blocks

BITS = 18
CACHE = 300_000            # words whose hashes a worker remembers
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SHAPE = [(re.compile(rb"[A-Z]+"), b"A"), (re.compile(rb"[a-z\x80-\xff]+"), b"a"), (re.compile(rb"[0-9]+"), b"0")]
_RUN = re.compile(rb"(.)\1+", re.S)


class _WordHashes(dict):
    """word -> (hash of the lower-cased word << 32) | hash of its shape."""

    def __missing__(self, word: bytes) -> int:
        shape = word
        for pattern, sign in _SHAPE:
            shape = pattern.sub(sign, shape)
        shape = _RUN.sub(rb"\1", shape)[:16]
        value = zlib.crc32(word.lower()) << 32 | zlib.crc32(shape)
        if len(self) >= CACHE:
            self.clear()
        if len(word) <= LONG_WORD:
            self[word] = value
        return value


_HASHES = _WordHashes()


def begin_task() -> None:
    remember_for("features", _HASHES.clear)


def _pairs(h: np.ndarray) -> np.ndarray:
    return (h[:-1] * _MIX) ^ (h[1:] + (h[:-1] >> np.uint64(7)))


def _slots(h: np.ndarray, salt: int, bits: int) -> np.ndarray:
    return ((h + np.uint64(salt)) * _MIX) >> np.uint64(64 - bits)


def text_features(text: bytes | None, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(bucket indices, values) of a text; empty for a text without words."""
    blocks = [np.fromiter(map(_HASHES.__getitem__, w), np.uint64, len(w)) for w in word_blocks(text)]
    if not blocks:
        return np.empty(0, np.uint32), np.empty(0, np.float32)
    both = np.concatenate(blocks)
    words, shapes = both >> np.uint64(32), both & np.uint64(0xFFFFFFFF)
    same = np.zeros(len(words), bool)
    same[1:] = words[1:] == words[:-1]
    shapes = np.where(same, shapes + np.uint64(1 << 33), shapes)
    pairs = _pairs(words)
    indices, values, distinct_pairs = [], [], 0
    for salt, family in enumerate((words, pairs, shapes, _pairs(shapes))):
        if len(family):
            slots, counts = np.unique(_slots(family, salt, bits), return_counts=True)
            if salt == 1:
                distinct_pairs = len(slots)
            indices.append(slots)
            values.append(np.sqrt(counts / len(family)))
    repeated = 0 if not len(pairs) else round(10 * (1 - distinct_pairs / len(pairs)))
    length = min(int(np.log2(len(words))), 12)
    for salt, gram in ((8, repeated), (9, length)):
        indices.append(_slots(np.array([gram], np.uint64), salt, bits))
        values.append(np.ones(1))
    return np.concatenate(indices).astype(np.uint32), np.concatenate(values).astype(np.float32)


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


class FollowTheLeader:
    """FTRL-proximal logistic regression over sparse rows (McMahan et al., 2013)."""

    def __init__(self, size: int, alpha: float = 0.3, beta: float = 1.0, l1: float = 0.02, l2: float = 0.1):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(size), np.zeros(size)     # the last slot is the bias

    def weights(self, at=slice(None)) -> np.ndarray:
        z = self.z[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def learn(self, rows: Iterable[tuple[np.ndarray, np.ndarray, int]]) -> None:
        bias = len(self.z) - 1
        for index, value, y in rows:
            at, x = np.append(index, bias), np.append(value, 1.0)
            w = self.weights(at)
            g = (sigmoid(float(w @ x)) - y) * x
            step = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha
            self.z[at] += g - step * w
            self.n[at] += g * g
