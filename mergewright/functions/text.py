"""Text normalisers.

Three are needed because blocking, comparing and the learned linker treat
punctuation, missing values and spaces differently.
"""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# All characters that count as white space, not only the ASCII ones, so that
# text scraped from the web (no-break and ideographic spaces) is squeezed too.
SPACE = (r"\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}"
         r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")
# What printable ASCII in lower case has besides letters, digits and the blank.
_PUNCTUATION = string.punctuation
_EDGE_SPACE = f"^[{SPACE}]+|[{SPACE}]+$"

# What a missing value looks like inside a block key or a compared text.
MISSING_TEXT = "nan"
EMPTIED_TEXT = "None"


def strip_space(c: Column) -> Column:
    return F.regexp_replace(c, _EDGE_SPACE, "")


def norm_block(c: Column) -> Column:
    """Lower case, every run of other than a-z and 0-9 to one space; empty gives null."""
    return F.nullif(F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " ")), F.lit(""))


def block_text(c: Column, null_block: str = "literal") -> Column:
    """``norm_block`` for use in a block key.

    ``literal``: missing values meet in the block ``nan`` and punctuation-only
    values in the block ``None``. ``drop``: both stay null and meet nothing.
    """
    if null_block == "drop":
        return norm_block(c)
    if null_block != "literal":
        raise ValueError(f"null_block must be 'literal' or 'drop', not {null_block!r}")
    return F.when(c.isNull(), F.lit(MISSING_TEXT)).otherwise(
        F.coalesce(norm_block(c), F.lit(EMPTIED_TEXT)))


def norm_compare(c: Column) -> Column:
    """Lower case, punctuation deleted, spaces squeezed; missing becomes the text ``nan``."""
    text = F.lower(F.coalesce(c, F.lit(MISSING_TEXT)))
    kept = F.regexp_replace(text, f"[^a-z0-9{SPACE}]", "")
    # A class of many ranges takes several times as long, so printable ASCII does without.
    plain = F.regexp_replace(F.translate(text, _PUNCTUATION, ""), "  +", " ")
    return F.trim(F.when(text.rlike(r"^[ -~]*\z"), plain).otherwise(F.regexp_replace(kept, f"[{SPACE}]+", " ")))


def norm_linker(c: Column) -> Column:
    """Squeeze blanks, newline to blank, strip spaces and quotes, lower; empty gives null.

    Blanks are squeezed before newlines become blanks, so a blank next to a
    newline leaves two blanks.
    """
    x = F.regexp_replace(c, "  +", " ")
    x = strip_space(F.replace(x, F.lit("\n"), F.lit(" ")))
    x = F.btrim(F.btrim(x, F.lit('"')), F.lit("'"))
    return F.nullif(strip_space(F.lower(x)), F.lit(""))


def vin_characters(c: Column) -> Column:
    """Letters and digits of ``c`` in upper case."""
    # Two ranges, ASCII letters in either case: some five times as fast as three.
    return F.upper(F.regexp_replace(c, "(?i)[^a-z0-9]+", ""))


VIN_LENGTH = 17


def clean_vin(c: Column) -> Column:
    """Letters and digits only, upper case; valid only at exactly 17 characters."""
    x = vin_characters(c)
    return F.when(F.length(x) == VIN_LENGTH, x)
