"""Numbers out of text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mergewright.schema import MILEAGE_BIN_WIDTH

# A cast alone is not enough: a plain one raises under ANSI, and a trying one
# takes Java suffixes such as "7d". The guard lets plain decimal text through.
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def to_number(c: Column) -> Column:
    """Text to double; anything that is not a plain number becomes null."""
    return F.when(c.rlike(NUMBER_PATTERN), F.trim(c).try_cast("double"))


def to_year(c: Column) -> Column:
    """Text such as ``2015`` or ``2015.0`` to a whole number; a fractional year is null."""
    number = to_number(c)
    return F.when(number == F.floor(number), number).try_cast("int")


def mileage_bin(c: Column, width: int = MILEAGE_BIN_WIDTH) -> Column:
    """Index of the ``width``-wide bin of a numeric column; non-finite gives null."""
    x = c.cast("double")
    finite = ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.when(finite, F.floor(x / F.lit(float(width)))).try_cast("int")


def log_distance(a: Column, b: Column) -> Column:
    """Distance of two positive amounts on the log10 scale, null if one is not positive."""
    return F.when((a > 0) & (b > 0), F.abs(F.log10(a) - F.log10(b)))
