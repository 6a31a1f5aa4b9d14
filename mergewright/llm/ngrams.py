"""Hashed character n-grams of texts by numpy."""

from __future__ import annotations

import unicodedata

import numpy as np

BLANK = 32


def letter_table() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((unicodedata.category(chr(i))[0] == "L" for i in range(0x110000)), np.bool_, 0x110000)


def letters_only(text: str, table: np.ndarray) -> np.ndarray:
    """Code points of the lower-cased text, runs of anything but letters as one blank, a blank at either end."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = table[points]
    points = np.where(letter, points, BLANK)
    keep = letter | np.concatenate([[False], letter[:-1]]) if len(letter) else letter
    return np.concatenate([[BLANK], points[keep], [BLANK]]).astype(np.uint32)


def bucket_counts(points: np.ndarray, sizes: tuple[int, ...], buckets: int) -> np.ndarray:
    """Counts of hashed n-grams of the given sizes; works in blocks, so scratch memory is bounded."""
    out = np.zeros(buckets, np.int64)
    step = 1 << 20
    for at in range(0, len(points), step):
        for size in sizes:
            block = points[at:at + step + size - 1]
            if len(block) < size:
                continue
            mixed = np.full(len(block) - size + 1, size * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
            for i in range(size):
                mixed = (mixed ^ block[i:len(block) - size + 1 + i]) * np.uint32(0x85EBCA6B)
                mixed ^= mixed >> np.uint32(15)
            out += np.bincount(mixed % np.uint32(buckets), minlength=buckets)
    return out
