"""mergewright: integrate and link two tabular sources with Spark DataFrames."""
