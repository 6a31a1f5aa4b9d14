"""One row per key, and set operations on links."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mergewright.functions.text import VIN_LENGTH, vin_characters


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                keep: str = "first") -> DataFrame:
    """Keep the first or last row of each key by explicit order columns.

    Ranking (and not ``dropDuplicates``) makes the kept row well defined. Each
    task keeps one row per key before the shuffle, so a key that holds a large
    share of all rows sends at most one row per task.
    """
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be 'first' or 'last', not {keep!r}")
    by = [F.col(c).asc() if keep == "first" else F.col(c).desc() for c in order]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*by))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def one_per_vin(df: DataFrame, order: Sequence[str], keep: str = "first") -> DataFrame:
    """Rows with a valid cleaned VIN, one per VIN; adds ``vin_clean``."""
    # Filter and projection are evaluated apart; this asks for one pattern match in each.
    characters = vin_characters(F.col("vin"))
    valid = df.filter(F.length(characters) == VIN_LENGTH).withColumn("vin_clean", characters)
    return one_per_key(valid, ["vin_clean"], order, keep)


def links(df: DataFrame) -> DataFrame:
    """The distinct links of a pair table."""
    return df.select("id_A", "id_B").distinct()
