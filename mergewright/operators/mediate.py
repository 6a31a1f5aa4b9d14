"""Mapping a raw source to the mediated schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mergewright.functions.numbers import to_number, to_year
from mergewright.schema import MEDIATED


def mediate(raw: DataFrame, mapping: dict[str, str | None], keep: Sequence[str] = ()) -> DataFrame:
    """Project ``raw`` to the mediated columns, in their fixed order.

    A source column that is not there, or mapped to None, gives a null of the
    right type. ``keep`` names further raw columns to carry along, such as the
    position of a row in its source.
    """
    def column(field: T.StructField):
        name = mapping.get(field.name)
        if name is None or name not in raw.columns:
            return F.lit(None).cast(field.dataType).alias(field.name)
        c = F.col(f"`{name}`")
        if isinstance(field.dataType, T.IntegerType):
            c = to_year(c)
        elif isinstance(field.dataType, T.DoubleType):
            c = to_number(c)
        return c.alias(field.name)

    return raw.select(*[column(f) for f in MEDIATED.fields], *keep)


def drop_leakage(df: DataFrame, word: str = "vin") -> DataFrame:
    """Drop every column whose name holds ``word`` in any case."""
    return df.drop(*[c for c in df.columns if word in c.lower()])
