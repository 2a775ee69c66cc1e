"""Word shingles of a text as 64-bit hashes."""

import numpy as np
import xxhash

WORDS = 5
_STEP = np.uint64(0x9E3779B97F4A7C15)


def words_of(text):
    """Words between white space, in lower case."""
    return (text or "").lower().encode().split()


def shingle_set(text, size=WORDS):
    """Sorted hashes of the different runs of ``size`` words.

    A text of fewer words has one shingle, its words; a text without words has none.
    """
    words = words_of(text)
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < size:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=1)], np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(words) - size + 1
    out = hashes[:n].copy()
    for k in range(1, size):
        out *= _STEP
        out ^= out >> np.uint64(29)
        out += hashes[k : k + n]
    return np.unique(out)
