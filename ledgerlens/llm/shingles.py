"""Words and word n-grams of many texts at once, as 64-bit hashes in numpy arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from ledgerlens.llm.common import LOWER_AZ, WHITE_BYTES

# Odd multipliers of the polynomial word hash and of the n-gram's words, and a finaliser's constants.
BASE = 0x9E3779B97F4A7C15
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
_SPACE = np.zeros(256, bool)
_SPACE[list(WHITE_BYTES)] = True
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _table(n: int) -> list[np.ndarray]:
    """Powers of BASE and of its inverse modulo 2**64, at least ``n`` of each."""
    if len(_powers[0]) < n:
        size = -(-n // 65536) * 65536
        inverse = pow(BASE, -1, 1 << 64)
        for i, b in enumerate((BASE, inverse)):
            factors = np.full(size, b, np.uint64)
            factors[0] = 1
            _powers[i] = np.cumprod(factors, dtype=np.uint64)
    return _powers


def mixed(h: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every bit of ``h`` over all 64."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(MIX[0])
    h = (h ^ (h >> np.uint64(27))) * np.uint64(MIX[1])
    return h ^ (h >> np.uint64(31))


@dataclass
class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a list of texts; ``first[i]`` to ``first[i + 1]`` are text ``i``'s."""

    data: np.ndarray      # all bytes, a line feed after each text
    text_at: np.ndarray   # where each text starts, and the end
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hash: np.ndarray


def words_of(texts: list[bytes], lower: bool = False) -> Words:
    blob = b"\n".join(texts) + b"\n"
    if lower:
        blob = blob.translate(LOWER_AZ)
    data = np.frombuffer(blob, np.uint8)
    text_at = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)])
    space = _SPACE[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(data) and not space[0]:
        edge = np.concatenate([[0], edge])
    start, end = edge[0::2], edge[1::2]  # the last byte is a line feed: every word ends
    up, down = _table(len(data) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], dtype=np.uint64)])
    word = mixed((total[end] - total[start]) * down[start])
    return Words(data, text_at, start, end, np.searchsorted(start, text_at), word)


def grams(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``(gram, at)``: hashes of all n-word windows and the word each starts at, text by text."""
    size = np.diff(words.first)
    windows = np.maximum(size - n + 1, 0)
    at = np.repeat(words.first[:-1] - np.concatenate([[0], np.cumsum(windows)[:-1]]), windows) + np.arange(windows.sum())
    h = np.zeros(len(at), np.uint64)
    factor = 1
    for i in range(n):
        factor = factor * BASE % (1 << 64)
        h += words.hash[at + i] * np.uint64(factor)
    return mixed(h), at


def shingle_sets(texts: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-gram hashes of each text and their ends: ``sets[ends[i - 1]:ends[i]]`` is text ``i``'s.

    A-Z are lower-cased. A text with fewer than ``n`` words has its whole sequence
    as one gram, a text without words the empty set.
    """
    words = words_of(texts, lower=True)
    size = np.diff(words.first)
    gram, _ = grams(words, n)
    owner = np.repeat(np.arange(len(texts)), np.maximum(size - n + 1, 0))
    few = np.flatnonzero((size > 0) & (size < n))
    if len(few):
        whole = [sum(int(h) * pow(BASE, i + 1, 1 << 64) for i, h in enumerate(words.hash[words.first[t]:words.first[t + 1]]))
                 + int(size[t]) * MIX[0] for t in few]
        gram = np.concatenate([gram, mixed(np.array([w % (1 << 64) for w in whole], np.uint64))])
        owner = np.concatenate([owner, few])
    order = np.lexsort((gram, owner))
    gram, owner = gram[order], owner[order]
    new = np.ones(len(gram), bool)
    new[1:] = (gram[1:] != gram[:-1]) | (owner[1:] != owner[:-1])
    gram, owner = gram[new], owner[new]
    return gram, np.cumsum(np.bincount(owner, minlength=len(texts)))
