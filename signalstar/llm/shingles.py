"""Hashed word shingles and min-hash sketches of texts, a batch at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

WORDS = 5
SKETCH = 64  # min-hash values of a set
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.default_rng(20)
_MULTIPLY = _rng.integers(0, 2**31, SKETCH, dtype=np.int64).astype(np.uint32) * np.uint32(2) + np.uint32(1)
_ADD = _rng.integers(0, 2**32, SKETCH, dtype=np.int64).astype(np.uint32)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """The sorted distinct shingles of each text, as 64-bit hashes.

    Words are what white space separates, in lower case. A text of one to four words has one
    shingle, all of them; a text without words has none.
    """
    trimmed = pc.utf8_trim_whitespace(pc.utf8_lower(texts.cast(pa.large_string())))
    lists = pc.utf8_split_whitespace(trimmed)
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    offsets = lists.offsets.to_numpy().astype(np.int64)
    coded = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
    offsets = offsets - offsets[0]
    words = coded.dictionary.to_pylist()
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))
    word = hashes[coded.indices.to_numpy(zero_copy_only=False)]
    # The empty string is what is left of a text without words.
    empty = np.uint64(xxhash.xxh64_intdigest(""))
    window = word.copy()
    for k in range(1, WORDS):
        window = window[:-1] * _FACTOR + word[k:] if len(window) > 1 else window[:0]
    window = mix(window)
    sets = []
    for start, end in zip(offsets[:-1], offsets[1:]):
        n = end - start
        if n == 0 or (n == 1 and word[start] == empty):
            sets.append(np.zeros(0, np.uint64))
        elif n < WORDS:
            one = word[start : start + 1]
            for k in range(start + 1, end):
                one = one * _FACTOR + word[k : k + 1]
            sets.append(mix(one + np.uint64(n)))
        else:
            sets.append(np.unique(window[start : end - WORDS + 1]))
    return sets


def sketch(items: np.ndarray) -> np.ndarray:
    """SKETCH min-hash values of a set that is not empty."""
    low = (items >> np.uint64(32)).astype(np.uint32)
    least = np.full(SKETCH, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), 4096):
        some = low[at : at + 4096, None] * _MULTIPLY + _ADD
        np.minimum(least, some.min(axis=0), out=least)
    return least
