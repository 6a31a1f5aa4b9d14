"""Missing-value tokens."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Tokens that every text scan reads as missing (whole cell, case matters).
DEFAULT_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
# Tokens added by the listing sources on top of the defaults.
LISTING_TOKENS = ["", "na", "n/a", "unknown", "None"]
NA_TOKENS = sorted(set(DEFAULT_TOKENS) | set(LISTING_TOKENS))


def null_tokens(c: Column, tokens: Sequence[str] = NA_TOKENS) -> Column:
    """``c`` with every missing-value token turned into null."""
    return F.when(~c.isin(*tokens), c)


def nulls_in_frame(df: DataFrame, tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    """``null_tokens`` over all string columns in one projection.

    Written as SQL text: one call per frame instead of one per column and token.
    """
    listed = ", ".join("'" + t.replace("\\", "\\\\").replace("'", "\\'") + "'" for t in tokens)

    def cell(f: T.StructField) -> str:
        c = f"`{f.name}`"
        if isinstance(f.dataType, T.StringType):
            return f"case when {c} not in ({listed}) then {c} end as {c}"
        return c

    return df.selectExpr(*[cell(f) for f in df.schema.fields])
