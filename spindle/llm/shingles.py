"""Word shingles of many texts at once, as 64-bit hashes.

A word is a maximal run of ASCII letters and digits and non-ASCII characters of the
lower-cased text.  A shingle is five consecutive words; a text of one to four words
has one shingle of all its words; a text without words has none.
"""

from __future__ import annotations

import numpy as np

SHINGLE = 5
_BASE = np.uint64(0x100000001B3)
_INVERSE = np.uint64(pow(0x100000001B3, -1, 1 << 64))
_WORD = np.array([bytes([c]).isalnum() or c >= 128 for c in range(256)])
_STEP = np.uint64(0x9E3779B97F4A7C15)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: a bijection that spreads every bit."""
    x = x + _STEP
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["up"]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[name] = np.multiply.accumulate(table)
    return _powers["up"], _powers["down"]


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every word, in order."""
    parts = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    raw = np.frombuffer(b" ".join(parts) + b" ", np.uint8)
    starts = np.cumsum([0, *(len(p) + 1 for p in parts)])
    inside = np.concatenate([[False], _WORD[raw]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    first, last = edge[0::2], edge[1::2]
    up, down = power_tables(len(raw) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:len(raw)])])
    words = mix((total[last] - total[first]) * down[first])
    return words, np.searchsorted(starts, first, side="right") - 1


def shingle_hashes(texts: list[str], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every shingle, in order."""
    words, text_of = word_hashes(texts)
    n_words = np.bincount(text_of, minlength=len(texts))
    hashes, owner = np.zeros(len(words), np.uint64), text_of
    begin = np.cumsum(n_words) - n_words
    place = np.arange(len(words)) - begin[text_of]
    left = n_words[text_of] - place
    for j in range(size):
        has = left > j
        at = np.flatnonzero(has)
        hashes[at] += words[at + j] * mix(np.array([j + 1], np.uint64))[0]
    whole = (left >= size) | (place == 0)
    hashes = mix(hashes[whole] + np.minimum(left[whole], size).astype(np.uint64))
    return hashes, owner[whole]


def multisets(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles with their text number and count, ordered by text and hash."""
    order = np.argsort(hashes)
    order = order[np.argsort(owner[order].astype(np.uint16 if len(owner) == 0 or owner[-1] < 65536 else np.int64),
                             kind="stable")]
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    return hashes[at], owner[at], np.diff(at, append=len(hashes))


def expanded(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The multiset as a set: the c-th copy of a shingle becomes an element of its own."""
    distinct, own, count = multisets(hashes, owner)
    copy = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    return mix(np.repeat(distinct, count) ^ mix(copy.astype(np.uint64))), np.repeat(own, count)
