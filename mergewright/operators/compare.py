"""Features of given pairs, for the classifier and for the learned linker."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mergewright.functions.distance import TEXT_FIELDS, affine_gap_bounds, affine_gap_fields
from mergewright.functions.numbers import log_distance, mileage_bin
from mergewright.functions.similarity import exact, jaro_winkler_at_least, linear
from mergewright.functions.text import norm_compare
from mergewright.schema import MILEAGE_BIN_SCALE, MODEL_SIMILARITY_THRESHOLD, YEAR_SCALE

# The compared attributes, in the order of the feature vector.
FEATURES = ["model", "year", "mileage", "state", "make"]

# Fields of the linker whose value may be missing.
MAY_BE_MISSING = ["year", "price", "mileage", "state"]
LINKER_FEATURES = ["model", "make", "year", "price", "mileage", "state",
                   *[f"{f}_missing" for f in MAY_BE_MISSING]]


def pair_features(pairs: DataFrame, *keep: str) -> DataFrame:
    """The five similarities of each pair.

    They are computed from the pair's own columns in one projection: no lookup
    of records, no shuffle, one Python step (for undecided model texts only).
    """
    def both(c: str) -> tuple[Column, Column]:
        return F.col(f"{c}_A"), F.col(f"{c}_B")

    texts = {f"_{c}_{s}": norm_compare(F.col(f"{c}_{s}")) for c in ("model", "make") for s in ("A", "B")}
    bin_a, bin_b = (mileage_bin(c) for c in both("mileage"))
    # Texts are normalised in a projection of their own: the similarities name them many times.
    return pairs.withColumns(texts).select(
        "id_A", "id_B",
        jaro_winkler_at_least(F.col("_model_A"), F.col("_model_B"), MODEL_SIMILARITY_THRESHOLD).alias("model"),
        linear(*both("year"), YEAR_SCALE).alias("year"),
        linear(bin_a, bin_b, MILEAGE_BIN_SCALE).alias("mileage"),
        exact(*both("state")).alias("state"),
        exact(F.col("_make_A"), F.col("_make_B")).alias("make"),
        *keep)


def linker_features(pairs: DataFrame, *keep: str) -> DataFrame:
    """Distances of each pair of linker records, 0 plus an indicator where a field is missing."""
    def both(c: str) -> tuple[Column, Column]:
        return F.col(f"{c}_A"), F.col(f"{c}_B")

    far = affine_gap_fields({c: both(c) for c in ("model", "make", "year", "state")})
    far["price"] = log_distance(*both("price"))
    far["mileage"] = log_distance(*both("mileage"))
    return pairs.select(
        *keep,
        *[F.coalesce(far[f], F.lit(0.0)).alias(f)
          for f in ("model", "make", "year", "price", "mileage", "state")],
        *[F.isnull(far[f]).cast("double").alias(f"{f}_missing") for f in MAY_BE_MISSING])


def linker_logit_bound(by_feature: dict[str, float], intercept: float) -> Column:
    """The greatest log-odds that the linker can give a pair, without comparing its texts.

    Prices and missing fields are known exactly; a text counts with the best distance for its weight that
    its lengths allow.
    """
    out = F.lit(float(intercept))
    for field in LINKER_FEATURES[:6]:
        a, b = F.col(f"{field}_A"), F.col(f"{field}_B")
        weight = by_feature[field]
        if field in TEXT_FIELDS:
            low, high = affine_gap_bounds(a, b)
            best = low if weight < 0 else high
        else:
            best = log_distance(a, b)
        out = out + F.lit(weight) * F.coalesce(best, F.lit(0.0))
        if field in MAY_BE_MISSING:
            out = out + F.lit(by_feature[f"{field}_missing"]) * F.isnull(best).cast("double")
    return out


def join_records(pairs: DataFrame, records: DataFrame, *columns: str) -> DataFrame:
    """Put both records next to each pair of ids, suffixed ``_A`` and ``_B``."""
    out = pairs
    for s in ("A", "B"):
        side = records.filter(F.col("source") == s).select(
            F.col("id").alias(f"id_{s}"), *[F.col(c).alias(f"{c}_{s}") for c in columns])
        out = out.join(side, f"id_{s}")
    return out
