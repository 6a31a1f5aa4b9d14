"""Similarities of two columns, each between 0 and 1."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mergewright.functions.batches import code_points, pair_batches


def exact(a: Column, b: Column, missing: float = 0.0) -> Column:
    """1 when equal, else 0; ``missing`` when a side is null."""
    return F.coalesce((a == b).cast("double"), F.lit(float(missing)))


def linear(a: Column, b: Column, scale: float, offset: float = 0.0,
           missing: float = 0.0) -> Column:
    """1 up to ``offset``, then falling in a line: one half at ``offset + scale``, 0 from
    ``offset + 2 * scale`` on; ``missing`` when a side is null."""
    d = F.abs(a.cast("double") - b.cast("double"))
    line = 1.0 - (d - F.lit(float(offset))) / F.lit(2.0 * scale)
    # greatest() and least() skip nulls, so a missing side has to be settled first.
    return F.when(d.isNull(), F.lit(float(missing))).otherwise(
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), line)))


def jaro_winkler_arrays(left: list[str], right: list[str], prefix_weight: float = 0.1,
                        boost_above: float = 0.7) -> np.ndarray:
    """Jaro-Winkler similarity of many pairs at once.

    The loops run over character positions; each step works on all pairs of
    the batch, so the cost per pair does not include a Python loop.
    """
    a, len_a = code_points(left)
    b, len_b = code_points(right)
    n, wide_a, wide_b = len(left), a.shape[1], b.shape[1]
    window = np.maximum(np.maximum(len_a, len_b) // 2 - 1, 0)
    hit_a = np.zeros((n, wide_a), dtype=bool)
    hit_b = np.zeros((n, wide_b), dtype=bool)
    reach = int(window.max(initial=0))
    for i in range(wide_a):
        for j in range(max(0, i - reach), min(wide_b, i + reach + 1)):
            meet = ((a[:, i] == b[:, j]) & (i < len_a) & (j < len_b)
                    & (abs(i - j) <= window) & ~hit_a[:, i] & ~hit_b[:, j])
            hit_a[:, i] |= meet
            hit_b[:, j] |= meet
    common = hit_a.sum(axis=1)

    # Line up the matched characters of both sides and count those out of order.
    most = int(common.max(initial=0))
    seq_a, seq_b = np.zeros((n, most), np.int64), np.zeros((n, most), np.int64)
    for hit, chars, seq in ((hit_a, a, seq_a), (hit_b, b, seq_b)):
        row, col = np.nonzero(hit)
        seq[row, (np.cumsum(hit, axis=1) - 1)[row, col]] = chars[row, col]
    swapped = (seq_a != seq_b).sum(axis=1) // 2

    m = np.maximum(common, 1).astype(float)
    jaro = np.where(common == 0, 0.0, (
        common / np.maximum(len_a, 1) + common / np.maximum(len_b, 1)
        + (common - swapped) / m) / 3.0)

    prefix = np.zeros(n)
    open_ = np.ones(n, dtype=bool)
    for i in range(min(4, wide_a, wide_b)):
        open_ &= (a[:, i] == b[:, i]) & (i < len_a) & (i < len_b)
        prefix += open_
    return np.where(jaro > boost_above, jaro + prefix * prefix_weight * (1.0 - jaro), jaro)


@F.pandas_udf(T.DoubleType())
def _jaro_winkler(left: pd.Series, right: pd.Series) -> pd.Series:
    return pair_batches(left, right, jaro_winkler_arrays)


def jaro_winkler(a: Column, b: Column) -> Column:
    """Jaro-Winkler similarity, null if a side is null."""
    return _jaro_winkler(a, b)


def jaro_winkler_at_least(a: Column, b: Column, threshold: float) -> Column:
    """1 when the Jaro-Winkler similarity reaches ``threshold``, else 0; missing gives 0.

    Most pairs never reach Python: equal texts are decided in the JVM, and so
    are pairs whose lengths and common prefix bound the similarity below the
    threshold. Python sees nulls in their place.
    """
    len_a, len_b = F.length(a), F.length(b)
    prefix = sum(
        ((F.substring(a, 1, k) == F.substring(b, 1, k)) & (len_a >= k) & (len_b >= k)).cast("int")
        for k in (1, 2, 3, 4))
    jaro_bound = (2.0 + F.least(len_a, len_b) / F.greatest(len_a, len_b, F.lit(1))) / 3.0
    bound = jaro_bound + prefix * 0.1 * (1.0 - jaro_bound)
    # A small slack, so that rounding in the bound cannot decide a pair.
    far = (len_a == 0) | (len_b == 0) | (bound < threshold - 1e-9)
    same = (a == b) & (len_a > 0)
    # Equal texts are same or far; told first, they need no bound.
    unsure = (a != b) & ~far
    score = _jaro_winkler(F.when(unsure, a), F.when(unsure, b))
    return F.coalesce(
        F.when(same, 1.0).when(far, 0.0).otherwise((score >= threshold).cast("double")),
        F.lit(0.0))
