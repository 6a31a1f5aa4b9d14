"""Scans of delimited text."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from mergewright.functions.missing import DEFAULT_TOKENS, NA_TOKENS, nulls_in_frame
from mergewright.sources.quoted import read_quoted


def _reader(spark: SparkSession, multiline: bool):
    # Quotes inside a quoted cell are doubled. With multiLine Spark reads a file as one split, see ``quoted`` for another way.
    return (spark.read.option("header", True).option("escape", '"')
            .option("multiLine", multiline).option("enforceSchema", False))


def scan_text(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
              tokens: Sequence[str] = NA_TOKENS, multiline: bool = False) -> DataFrame:
    """Every column as text, missing-value tokens as null.

    With ``columns`` the header is checked against them. Cells with line breaks need ``multiline``; their records
    are found by byte ranges, so one large file is read by many tasks.
    """
    if multiline:
        return nulls_in_frame(read_quoted(spark, path, columns), tokens)
    reader = _reader(spark, False)
    if columns is not None:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    return nulls_in_frame(reader.csv(path), tokens)


def scan_typed(spark: SparkSession, path: str, schema: T.StructType | None = None,
               multiline: bool = False) -> DataFrame:
    """Typed scan. Without ``schema`` the types are inferred, which reads the data twice."""
    reader = _reader(spark, multiline)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return nulls_in_frame(reader.csv(path), DEFAULT_TOKENS)


def require_columns(df: DataFrame, columns: Iterable[str], what: str = "input") -> DataFrame:
    """Return ``df``, or stop before any job when a column is missing."""
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"{what} lacks the columns {', '.join(absent)}")
    return df


def spread(df: DataFrame, by: str) -> DataFrame:
    """Spread a scan over the cores when its files give fewer splits than that.

    A file of one row group is read by one task, and everything up to the next
    shuffle would run in it. A scan of many files is left as it is, and so is one of files so large that they
    are read by two tasks a core and more: these hold many row groups, and dealing them out would write them all.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if len(df.inputFiles()) >= cores or df._jdf.queryExecution().toRdd().getNumPartitions() >= 2 * cores:
        return df
    return df.repartition(cores, by)
