"""Exact quantiles of many columns without sorting or gathering a column."""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mergewright.operators.profile import STATS, as_number, moments, numeric_columns

QUARTILES = (0.25, 0.5, 0.75)


class Band(NamedTuple):
    """Values lo..hi that hold a wanted rank; ``below`` rows come before, ``inside`` in it."""

    lo: float
    hi: float
    below: int
    inside: int

    def hold(self, value: Column) -> Column:
        return F.when((value >= F.lit(self.lo)) & (value <= F.lit(self.hi)), value)


def _count(slim: DataFrame, ends: dict, found: dict) -> dict:
    """One pass: exact counts around the approximate ends of each band; what is settled goes to ``found``.

    ``ends`` holds (lo, hi) by column and wanted ranks. An end may be repeated many times; ranks that
    fall on one are settled, and the band goes on strictly between the ends.
    """
    if not ends:
        return {}
    counted = []
    for j, ((c, _), (lo, hi)) in enumerate(ends.items()):
        x, lo, hi = F.col(f"`{c}`"), F.lit(lo), F.lit(hi)
        inner = F.when((x > lo) & (x < hi), x)
        counted += [F.count_if(x < lo).alias(f"below{j}"), F.count_if(x == lo).alias(f"lo{j}"),
                    F.count_if((x == hi) & (hi > lo)).alias(f"hi{j}"), F.count(inner).alias(f"inner{j}"),
                    F.min(inner).alias(f"min{j}"), F.max(inner).alias(f"max{j}")]
    n = slim.agg(*counted).first()
    rest = {}
    for j, ((c, ranks), (lo, hi)) in enumerate(ends.items()):
        at_inner = n[f"below{j}"] + n[f"lo{j}"]
        at_hi = at_inner + n[f"inner{j}"]
        if not n[f"below{j}"] <= ranks[0] <= ranks[-1] < at_hi + n[f"hi{j}"]:
            raise RuntimeError(f"the quantile band of {c} does not hold the ranks {ranks}")
        for rank in ranks:
            if rank < at_inner:
                found[c, rank] = lo
            elif rank >= at_hi:
                found[c, rank] = hi
        inner = tuple(r for r in ranks if at_inner <= r < at_hi)
        if inner:
            rest[c, inner] = Band(n[f"min{j}"], n[f"max{j}"], at_inner, n[f"inner{j}"])
    return rest


def _held(slim: DataFrame, bands: dict) -> DataFrame:
    """Only the rows that some open band holds; values outside the bands are null there."""
    some = F.lit(False)
    for (c, _), band in bands.items():
        x = F.col(f"`{c}`")
        some = some | F.coalesce((x >= F.lit(band.lo)) & (x <= F.lit(band.hi)), F.lit(False))
    return slim.filter(some)


def _settle(slim: DataFrame, bands: dict, found: dict, gather: int, accuracy: int) -> dict:
    """One pass over rows of open bands: list small bands, approximate the ends around the ranks of large ones."""
    looks = []
    for j, ((c, ranks), band) in enumerate(bands.items()):
        held = band.hold(F.col(f"`{c}`"))
        if band.inside <= gather:
            looks.append(F.sort_array(F.collect_list(held)).alias(f"v{j}"))
        else:
            shares = [(r - band.below) / band.inside for r in (ranks[0], ranks[-1])]
            ends = [max(0.0, shares[0] - 2 / accuracy), min(1.0, shares[1] + 2 / accuracy)]
            looks.append(F.percentile_approx(held, ends, accuracy).alias(f"v{j}"))
    seen = _held(slim, bands).agg(*looks).first()
    large = {}
    for j, (key, band) in enumerate(bands.items()):
        if band.inside <= gather:
            for rank in key[1]:
                found[key[0], rank] = seen[f"v{j}"][rank - band.below]
        else:
            large[key] = seen[f"v{j}"]
    return large


def described(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float],
              gather: int = 10_000, accuracy: int = 10_000) -> tuple[dict[str, dict], dict[str, list[float | None]]]:
    """Moments, and quantiles with linear interpolation between neighbouring values.

    The first pass takes counts, moments and approximate ends around each
    wanted rank, whose error is bounded. The second counts exactly
    what lies below and between the ends. The third lists the values between
    them, over rows of open bands alone. A band with more than ``gather`` rows, which is then some
    ``accuracy / 4``-th of all, is narrowed again in the same way, so no array ever grows beyond that.
    """
    slim = df.select(*[as_number(df, c).alias(c) for c in columns])
    grid = [min(1.0, max(0.0, p + d)) for p in probabilities for d in (-2 / accuracy, 2 / accuracy)]
    base = slim.agg(*moments(columns), *[F.percentile_approx(f"`{c}`", grid, accuracy).alias(f"{i}_ends")
                                         for i, c in enumerate(columns)]).first()
    stats = {c: {s: base[f"{i}_{s}"] for s in STATS} for i, c in enumerate(columns)}
    places = {c: [p * (stats[c]["count"] - 1) for p in probabilities] if stats[c]["count"] else [] for c in columns}
    ends = {}
    for i, c in enumerate(columns):
        for k, at in enumerate(places[c]):
            lo, hi = base[f"{i}_ends"][2 * k:2 * k + 2]
            # Of few rows the neighbours of a rank may lie outside its approximate ends.
            few = stats[c]["count"] < accuracy
            ends[c, tuple(sorted({math.floor(at), math.ceil(at)}))] = (
                (stats[c]["min"], stats[c]["max"]) if few else (lo, hi))
    found: dict[tuple[str, int], float] = {}
    bands = _count(slim, ends, found)
    while bands:
        bands = _count(slim, _settle(slim, bands, found, gather, accuracy), found)

    def between(c: str, at: float) -> float:
        low, high = found[c, math.floor(at)], found[c, math.ceil(at)]
        return low + (high - low) * (at - math.floor(at))

    return stats, {c: [between(c, at) for at in places[c]] or [None] * len(probabilities) for c in columns}


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float],
                    **limits: int) -> dict[str, list[float | None]]:
    """Exact quantiles by column, see ``described``."""
    return described(df, columns, probabilities, **limits)[1]


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None,
                     **limits: int) -> DataFrame:
    """Moments and exact quartiles of the numeric columns, one row per attribute."""
    columns = list(columns or numeric_columns(df))
    stats, quartiles = described(df, columns, QUARTILES, **limits)
    rows = [(c, *(stats[c][s] for s in STATS), *quartiles[c]) for c in columns]
    return df.sparkSession.createDataFrame(
        rows, "attribute string, count bigint, mean double, std double, min double, max double, "
              + ", ".join(f"q{int(p * 100)} double" for p in QUARTILES))
