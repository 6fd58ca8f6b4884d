"""Word shingles of many texts at once, as 64-bit hashes in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from xxhash import xxh3_64_intdigest

from tidewater.llm import caches

M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit values that spreads them evenly."""
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[str]) -> np.ndarray:
    """Hashed one by one: a table of known words, looked up and turned into an array, takes three times as long."""
    caches.take("words", pa.default_memory_pool().release_unused)
    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def of_words(h: np.ndarray, first: np.ndarray, n: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of k words of texts whose word hashes are h[first : first + n]; and how many each text has.

    A text with fewer than k words, but one at least, has one shingle of all its words.
    """
    many = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    if not len(h):
        return np.zeros(0, np.uint64), many
    s = np.zeros(len(h), np.uint64)
    for j in range(k):
        s[: len(h) - j] += mixed(h[j:] + np.uint64(j + 1)) * np.uint64(2 * j + 1)
    s = mixed(s)
    for i in np.flatnonzero((n > 0) & (n < k)).tolist():
        own = h[first[i] : first[i] + n[i]]
        s[first[i]] = mixed(np.array([(mixed(own + np.arange(1, n[i] + 1, dtype=np.uint64))).sum(dtype=np.uint64)]))[0]
    keep = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many)
    return s[keep], many


def of_texts(texts: list[str | None], k: int) -> tuple[np.ndarray, np.ndarray]:
    """All shingles of the lower-cased, white-space-split texts, one text after the other, and each text's number."""
    split = [(t or "").lower().split() for t in texts]
    n = np.array([len(w) for w in split], np.int64)
    h = word_hashes([w for ws in split for w in ws])
    return of_words(h, np.cumsum(n) - n, n, k)


def forget() -> None:
    """Gives back what Arrow holds in reserve; a worker may go on to other tasks, of any kind."""
    pa.default_memory_pool().release_unused()
