"""Profiles of a table: missing and distinct values, numeric moments, attribute roles."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mergewright.functions.numbers import to_number
from mergewright.schema import HLL_LG_K, TOP_ROWS
from mergewright.sources.keyed import BUCKET, KeyedTable

# Texts longer than this are counted by their digest, so that long free text
# is not shuffled as a whole.
LONG_TEXT = 64
# Bytes of cells among which a task removes repeats at once.
CELL_BYTES = 32 << 20
# Buckets of a table of kept states; a part has one row an attribute.
STATE_BUCKETS = 16


def _stacked(row: DataFrame, attributes: Sequence[str], fields: dict[str, str]) -> DataFrame:
    """A one-row frame with columns ``<i>_<field>`` to one row per attribute."""
    entries = F.array(*[
        F.struct(F.lit(a).alias("attribute"),
                 *[F.col(f"{i}_{f}").cast(t).alias(f) for f, t in fields.items()])
        for i, a in enumerate(attributes)])
    return row.select(F.explode(entries).alias("e")).select("e.*")


def _cell(name: str, df: DataFrame | None = None) -> Column:
    """A column; with ``df`` given, NaN of a floating-point column is missing."""
    column = F.col(f"`{name}`")
    if df is not None and isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(column), column)
    return column


def missing_counts(df: DataFrame) -> DataFrame:
    """Missing cells of every column, in one pass and without a shuffle of rows."""
    row = df.agg(*[F.count_if(_cell(c, df).isNull()).alias(f"{i}_missing_count")
                   for i, c in enumerate(df.columns)])
    return _stacked(row, df.columns, {"missing_count": "bigint"})


def cells(df: DataFrame, columns: Sequence[str], wanted: Sequence[str], cell_bytes: int = CELL_BYTES) -> DataFrame:
    """Cells of ``columns`` as (i, value, n): repeats and missing cells (a null) counted by column, ``cell_bytes`` at a time.

    Only missing cells are given out for columns not ``wanted``. A value may come several times, from one task too.
    """
    asked = [c in set(wanted) for c in columns]
    schema = pa.schema([("i", pa.int32()), ("value", pa.string()), ("n", pa.int64())])

    def reduced(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        for i, column in enumerate(table.columns):
            if asked[i]:
                found = pc.value_counts(column)
                values, n = found.field("values").cast(pa.string()), found.field("counts")
            elif column.null_count:
                values, n = pa.nulls(1, pa.string()), pa.array([column.null_count])
            else:
                continue
            yield pa.RecordBatch.from_arrays([pa.array([i] * len(values), pa.int32()), values, n.cast(pa.int64())], schema=schema)

    def run(batches):
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= cell_bytes:
                yield from reduced(held)
                held, size = [], 0
        if held:
            yield from reduced(held)

    # Of a column not asked for, only whether it is missing goes to Python.
    texts = df.select(*[(_cell(c, df).cast("string") if own else F.when(_cell(c, df).isNotNull(), F.lit(True))).alias(f"c{i}")
                        for i, (c, own) in enumerate(zip(columns, asked))])
    value = F.when(F.length("value") > LONG_TEXT, F.concat(F.lit("#"), F.sha2("value", 256))).otherwise(F.col("value"))
    return texts.mapInArrow(run, "i int, value string, n long").withColumn("value", value)


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Exact distinct values per column, nulls left out.

    The table is turned into (attribute, value) rows; tasks remove their own
    repeats before the shuffle, which spreads by value and not by column.
    """
    present = [c for c in (columns or df.columns) if c in df.columns]
    found = cells(df, present, present).filter(F.col("value").isNotNull())
    counts = found.select("i", "value").distinct().groupBy("i").agg(F.count("*").alias("unique_count"))
    # A column with nothing but nulls has no cell, yet belongs in the profile.
    spark = df.sparkSession
    names = spark.range(len(present)).select(
        F.col("id").cast("int").alias("i"),
        F.element_at(F.array(*[F.lit(c) for c in present]), (F.col("id") + 1).cast("int")
                     ).alias("attribute"))
    return names.join(counts, "i", "left").select(
        "attribute", F.coalesce("unique_count", F.lit(0)).cast("bigint").alias("unique_count"))


def approx_distinct_counts(df: DataFrame, lg_k: int = HLL_LG_K) -> DataFrame:
    """Missing and approximate distinct values of every column in one pass."""
    row = df.agg(*[e for i, c in enumerate(df.columns) for e in (
        F.count_if(_cell(c, df).isNull()).alias(f"{i}_missing_count"),
        F.coalesce(F.hll_sketch_estimate(F.hll_sketch_agg(_cell(c, df).cast("string"), lg_k)),
                   F.lit(0)).alias(f"{i}_unique_count"))])
    return _stacked(row, df.columns, {"missing_count": "bigint", "unique_count": "bigint"})


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def as_number(df: DataFrame, name: str) -> Column:
    if name not in df.columns:
        return F.lit(None).cast("double")
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return to_number(_cell(name))
    return (_cell(name, df) if isinstance(kind, T.NumericType) else F.lit(None)).cast("double")


_STATS = {"count": "bigint", "mean": "double", "std": "double", "min": "double", "max": "double"}


STATS = tuple(_STATS)


def moments(columns: Sequence[str]) -> list[Column]:
    """Aggregates ``<i>_count`` to ``<i>_max`` of double columns."""
    return [e for i, c in enumerate(columns) for e in (
        F.count(f"`{c}`").alias(f"{i}_count"),
        F.coalesce(F.avg(f"`{c}`"), F.lit(0.0)).alias(f"{i}_mean"),
        F.coalesce(F.stddev_samp(f"`{c}`"), F.lit(0.0)).alias(f"{i}_std"),
        F.min(f"`{c}`").alias(f"{i}_min"), F.max(f"`{c}`").alias(f"{i}_max"))]


def numeric_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum of columns read as numbers.

    The deviation is 0 for fewer than two values. A column that is absent or
    holds no number has count 0 and mean 0; so has a column of another type.
    """
    numbers = df.select(*[as_number(df, c).alias(f"c{i}") for i, c in enumerate(columns)])
    return _stacked(numbers.agg(*moments([f"c{i}" for i in range(len(columns))])), columns, _STATS)


def partial_profile(df: DataFrame, by: Sequence[str], columns: Sequence[str],
                    lg_k: int = HLL_LG_K) -> DataFrame:
    """Mergeable profile of each part of a table, one row per part and attribute.

    Holds the missing count, the moments and a distinct-value sketch, so that
    parts profiled on their own (daily loads, say) can be merged later.
    """
    numbers = df.select(*by, *[_cell(c, df).alias(f"v{i}") for i, c in enumerate(columns)],
                        *[as_number(df, c).alias(f"c{i}") for i, c in enumerate(columns)])
    wide = numbers.groupBy(*by).agg(*[e for i in range(len(columns)) for e in (
        F.count_if(F.col(f"v{i}").isNull()).alias(f"{i}_missing_count"),
        F.count(f"c{i}").alias(f"{i}_count"), F.avg(f"c{i}").alias(f"{i}_mean"),
        (F.var_pop(f"c{i}") * F.count(f"c{i}")).alias(f"{i}_m2"),
        F.min(f"c{i}").alias(f"{i}_min"), F.max(f"c{i}").alias(f"{i}_max"),
        F.hll_sketch_agg(F.col(f"v{i}").cast("string"), lg_k).alias(f"{i}_sketch"))])
    fields = ["missing_count", "count", "mean", "m2", "min", "max", "sketch"]
    entries = F.array(*[
        F.struct(F.lit(c).alias("attribute"), *[F.col(f"{i}_{f}").alias(f) for f in fields])
        for i, c in enumerate(columns)])
    return wide.select(*by, F.explode(entries).alias("e")).select(*by, "e.*")


def keep_state(df: DataFrame, path: str, part: str, columns: Sequence[str]) -> None:
    """Keep the mergeable profile of one part of a table, a file say, under its name.

    A part that is profiled again replaces its own state, so a run that is repeated, or a file that was delivered twice, counts
    once. ``kept_states`` reads all states back.
    """
    state = partial_profile(df.withColumn("part", F.lit(part)), ["part"], columns)
    KeyedTable(path, ("part", "attribute"), buckets=STATE_BUCKETS).upsert(state, ["attribute"])


def kept_states(spark: SparkSession, path: str) -> DataFrame:
    """All states kept under ``path``, for ``merge_profiles``."""
    return spark.read.parquet(path).drop(BUCKET)


def merge_profiles(parts: DataFrame) -> DataFrame:
    """One profile from the profiles of disjoint parts.

    The squared deviations of the whole are those inside the parts plus those
    of the part means around the whole mean, weighted by count.
    """
    mean = parts.groupBy("attribute").agg(
        (F.sum(F.col("count") * F.col("mean")) / F.nullif(F.sum("count"), F.lit(0))).alias("_mean"))
    spread = F.col("count") * F.pow(F.col("mean") - F.col("_mean"), 2)
    merged = parts.join(mean, "attribute").groupBy("attribute").agg(
        F.sum("missing_count").alias("missing_count"), F.sum("count").alias("count"),
        F.coalesce(F.max("_mean"), F.lit(0.0)).alias("mean"),
        (F.sum("m2") + F.sum(spread)).alias("_m2"),
        F.min("min").alias("min"), F.max("max").alias("max"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("unique_count"))
    std = F.when(F.col("count") > 1, F.sqrt(F.col("_m2") / (F.col("count") - 1))).otherwise(0.0)
    return merged.select("attribute", "missing_count", "unique_count", "count", "mean",
                         std.alias("std"), "min", "max")


def profile_summary(df: DataFrame, distinct_of: Sequence[str] | None = None) -> DataFrame:
    """Missing and exact distinct counts by attribute; distinct null where not asked for.

    One pass: tasks count the repeats of each cell, a missing one as a null; of attributes whose values are not
    asked for only missing cells are counted.
    """
    names, wanted = df.columns, set(df.columns if distinct_of is None else distinct_of)
    counts = cells(df, names, list(wanted)).groupBy("i", "value").agg(F.sum("n").alias("n")).groupBy("i").agg(
        F.sum(F.when(F.col("value").isNull(), F.col("n"))).alias("missing"), F.count("value").alias("unique"))
    listed = df.sparkSession.createDataFrame(
        [(i, c, c in wanted) for i, c in enumerate(names)], "i int, attribute string, asked boolean")
    zero = F.lit(0).cast("bigint")
    return listed.join(counts, "i", "left").select(
        "attribute", F.coalesce("missing", zero).alias("missing_count"),
        F.when(F.col("asked"), F.coalesce("unique", zero)).alias("unique_count"))


def profile_top(profile: DataFrame, n: int | None = TOP_ROWS) -> DataFrame:
    """Attributes by missing count, largest first; ties by name."""
    ordered = profile.orderBy(F.col("missing_count").desc(), "attribute")
    return ordered if n is None else ordered.limit(n)


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def column_types(df: DataFrame) -> dict[str, str]:
    return dict(df.dtypes)


def attribute_roles(profile: DataFrame, rows: Column, identifier_from: float = 0.9,
                    category_to: float = 0.01) -> DataFrame:
    """How to use an attribute, by its distinct values per row.

    Close to one value per row is an identifier or free text, few values are a
    category for blocking, and anything between is compared approximately.
    """
    ratio = F.col("unique_count") / F.nullif(rows, F.lit(0))
    role = (F.when(F.col("unique_count") == 0, "empty").when(ratio >= identifier_from, "identifier")
            .when(ratio <= category_to, "categorical").otherwise("approximate"))
    return profile.withColumn("role", role)


def constant_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Which columns hold a single value, and so cannot tell rows apart."""
    row = df.agg(*[F.min(_cell(c)).eqNullSafe(F.max(_cell(c))).alias(f"{i}_constant")
                   for i, c in enumerate(columns)])
    return _stacked(row, columns, {"constant": "boolean"})
