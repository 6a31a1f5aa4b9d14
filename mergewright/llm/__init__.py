"""Operators of a training-data pipeline, as functions on DataFrames.

Nothing else in the package imports this subpackage. Importing the parent's
functions registers the package to be sent to executors by value.
"""

import mergewright.functions  # noqa: F401
