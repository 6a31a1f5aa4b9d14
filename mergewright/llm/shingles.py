"""Sets of hashed word shingles by Arrow and numpy.

Words are runs of letters and digits of the lower-cased text. A text's shingles are
its windows of five words; a shorter text has one shingle, its words; a text without words has none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SIZE = 5
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, size: int = SIZE) -> list[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each text."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    words = pc.split_pattern(pc.utf8_trim(pc.replace_substring_regex(
        pc.utf8_lower(texts), r"[^\p{L}\p{N}]+", " "), " "), " ")
    return window_sets(words, size)


def window_sets(words: pa.ListArray, size: int) -> list[np.ndarray]:
    """The sorted distinct 64-bit hashes of the windows of ``size`` words in each list of words.

    A shorter list has one window, all its words; a list of one empty word has none.
    """
    import xxhash

    coded = words.flatten().dictionary_encode()
    parts = coded.dictionary.to_numpy(zero_copy_only=False)
    hashes = np.fromiter((xxhash.xxh64_intdigest(p) for p in parts), np.uint64, len(parts))
    flat = hashes[coded.indices.to_numpy()]
    bounds = (words.offsets.to_numpy() - words.offsets[0].as_py()).tolist()
    empty = np.array(pc.equal(pc.list_value_length(words), 1).to_numpy(zero_copy_only=False)) & (
        pc.equal(pc.binary_length(pc.list_element(words, 0)), 0).to_numpy(zero_copy_only=False))
    out = []
    for i, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
        if empty[i]:
            out.append(np.zeros(0, np.uint64))
            continue
        h = flat[a:b]
        n, width = max(1, len(h) - size + 1), min(size, len(h))
        s = np.full(n, np.uint64(width))
        for k in range(width):
            s = mix((s + h[k:k + n]) * MULTIPLIER)
        out.append(np.unique(s))
    return out


def permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and offsets of ``count`` hash functions, from a fixed rule."""
    base = mix(np.arange(1, 2 * count + 1, dtype=np.uint64) * MULTIPLIER)
    return base[:count] | np.uint64(1), base[count:]


def minhash(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each hash function the low 16 bits of the least hash; scratch memory is bounded."""
    least = np.full(len(a), np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(shingles), 1024):
        hashed = shingles[at:at + 1024, None] * a + b
        least = np.minimum(least, hashed.min(axis=0))
    return (mix(least) & np.uint64(0xFFFF)).astype("<u2")
