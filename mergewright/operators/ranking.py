"""Exact ranks, cuts and limits without one task that holds a whole group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Hex characters of a digest that one step of bucketing adds: 3 give 4096 buckets.
BUCKET_CHARS = 3
# Rows that one window partition may rank; buckets are made fine enough for it.
ROWS_PER_TASK = 1_000_000


def digest(*parts: Column | str, seed: int = 0) -> Column:
    """Seeded md5 of the parts, joined by ``|``; a repeatable random order."""
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.md5(F.concat_ws("|", *[c.cast("string") for c in columns], F.lit(str(seed))))


def bucket_chars(rows: int, rows_per_task: int = ROWS_PER_TASK) -> int:
    """Characters that make buckets of some tenth of ``rows_per_task`` rows, even if one group holds all rows."""
    chars = BUCKET_CHARS
    while rows / 16.0 ** chars > rows_per_task / 10:
        chars += 1
    return chars


def rank_by_digest(df: DataFrame, group: Sequence[str], by: str, name: str,
                   ties: Sequence[str] = (), rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Exact 1-based rank within each group in the order of a hex digest column.

    The rank is the number of rows in earlier digest buckets plus the rank
    inside the bucket, so a group with a third of all rows is ranked by many
    window partitions, whose number follows from the number of rows.
    """
    bucketed = df.withColumn("_bucket", F.substring(by, 1, bucket_chars(df.count(), rows_per_task)))
    counts = bucketed.groupBy(*group, "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = counts.select(
        *group, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = F.row_number().over(Window.partitionBy(*group, "_bucket").orderBy(by, *ties))
    return (bucketed.withColumn("_inside", inside)
            .join(offsets, [*group, "_bucket"])
            .withColumn(name, (F.col("_offset") + F.col("_inside")).cast("bigint"))
            .drop("_bucket", "_inside", "_offset"))


def class_cuts(keys: DataFrame, label: str, by: str, percents: Sequence[int],
               classes: Sequence[int], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Per class, the digests that cut it exactly at cumulative percentages.

    Returns ``label`` and one column ``cut_<p>`` for each percentage: a row is in
    the first p percent (rounded down) of its class when its digest is not
    above the cut. Rows are counted by bucket; the bucket that holds a cut is
    bucketed again until it has at most ``rows_per_task`` rows, and only these are
    ranked. The result, like each step's, has one row per listed class and cut.
    """
    spark = keys.sparkSession
    rows = keys.filter(F.col(label).isin(*classes)).select(label, by)
    kind = rows.schema[label].dataType.simpleString()
    schema = f"{label} {kind}, _p int, _prefix string, _rank bigint"
    sizes = {r[label]: r["n"] for r in rows.groupBy(label).agg(F.count("*").alias("n")).collect()}
    # Where the share rounds down to no row, the cut is the empty text, below every digest.
    cuts = [(k, p, "") for k, n in sizes.items() for p in percents if n * p // 100 == 0]
    wanted = [(k, p, "", n * p // 100) for k, n in sizes.items() for p in percents if n * p // 100]
    largest, chars = max(sizes.values(), default=0), 0
    while wanted and (chars == 0 or largest > rows_per_task) and chars < 32:
        chars += BUCKET_CHARS
        # One row per class and percentage.
        held = rows.join(F.broadcast(spark.createDataFrame(wanted, schema)), label).filter(
            F.col(by).startswith(F.col("_prefix")))
        counts = held.groupBy(label, "_p", "_rank", F.substring(by, 1, chars).alias("_prefix")).agg(
            F.count("*").alias("_n"))
        running = Window.partitionBy(label, "_p").orderBy("_prefix").rowsBetween(
            Window.unboundedPreceding, Window.currentRow)
        upto = counts.withColumn("_upto", F.sum("_n").over(running))
        edges = upto.filter((F.col("_rank") > F.col("_upto") - F.col("_n")) & (F.col("_rank") <= F.col("_upto"))).collect()
        wanted = [(r[label], r["_p"], r["_prefix"], r["_rank"] - r["_upto"] + r["_n"]) for r in edges]
        largest = max((r["_n"] for r in edges), default=0)
    inside = F.row_number().over(Window.partitionBy(label, "_p").orderBy(by))
    exact = (rows.join(F.broadcast(spark.createDataFrame(wanted, schema)), label)
             .filter(F.col(by).startswith(F.col("_prefix"))).withColumn("_inside", inside)
             .filter(F.col("_inside") == F.col("_rank")).select(label, "_p", F.col(by).alias("_cut")))
    empty = spark.createDataFrame(cuts, f"{label} {kind}, _p int, _cut string")
    return exact.unionByName(empty).groupBy(label).agg(*[
        F.max(F.when(F.col("_p") == p, F.col("_cut"))).alias(f"cut_{p}") for p in percents])


def first_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows by ``order``, columns of any ordered type, nulls first.

    A plain ordered limit makes every task send up to ``n`` rows to one task.
    Here the order columns alone are range-partitioned; counts and upper ends of the
    partitions give the bound that holds the first ``n`` rows, and only rows
    up to it are sorted. ``df`` is read twice: write it first if it is dear.
    """
    key = F.struct(*[F.col(c) for c in order])
    ends = (df.select(*order).repartitionByRange(*order).groupBy(F.spark_partition_id().alias("part"))
            .agg(F.count("*").alias("n"), F.max(key).alias("last")).orderBy("part").collect())
    held = 0
    for end in ends:
        held += end["n"]
        if held >= n:
            bound = F.struct(*[F.lit(v).cast(df.schema[c].dataType).alias(c) for c, v in zip(order, end["last"])])
            df = df.filter(key <= bound)
            break
    return df if held < n else df.orderBy(*order).limit(n)
