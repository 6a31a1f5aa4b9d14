"""Column -> Column functions. All native expressions except the text distances."""

import mergewright
from pyspark import cloudpickle

from mergewright.functions.missing import DEFAULT_TOKENS, NA_TOKENS, null_tokens, nulls_in_frame
from mergewright.functions.numbers import log_distance, mileage_bin, to_number, to_year
from mergewright.functions.text import (
    block_text,
    clean_vin,
    norm_block,
    norm_compare,
    norm_linker,
)

# Send the text distances to executors by value: they need no copy of this package.
cloudpickle.register_pickle_by_value(mergewright)

__all__ = [
    "DEFAULT_TOKENS", "NA_TOKENS", "block_text", "clean_vin", "log_distance", "mileage_bin",
    "norm_block", "norm_compare", "norm_linker", "null_tokens", "nulls_in_frame", "to_number",
    "to_year",
]
