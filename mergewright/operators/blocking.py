"""Block keys and the join of two sources within blocks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mergewright.functions.numbers import mileage_bin
from mergewright.functions.text import MISSING_TEXT, block_text
from mergewright.schema import CANDIDATES_PER_BLOCK


@dataclass(frozen=True)
class BlockingStrategy:
    """Name and typed key columns of a blocking; records meet when all keys agree."""

    name: str
    keys: tuple[str, ...]
    keep_vin: bool = True

    @property
    def columns(self) -> list[str]:
        return [f"block_{k}" for k in self.keys]


# The two strategies. Pairs of the second carry no VIN columns.
B1 = BlockingStrategy("b1", ("make", "model"))
B2 = BlockingStrategy("b2", ("make", "model", "year", "mileage_bin"), keep_vin=False)
STRATEGIES = {s.name: s for s in (B1, B2)}


# Fields that keys are made of.
KEY_FIELDS = ("make", "model", "year", "mileage")


def key_column(key: str, null_block: str = "literal", suffix: str = "") -> Column:
    if key in ("make", "model"):
        return block_text(F.col(key + suffix), null_block)
    if key == "mileage_bin":
        return mileage_bin(F.col("mileage" + suffix))
    return F.col(key + suffix)


def with_block(df: DataFrame, strategy: BlockingStrategy, null_block: str = "literal",
               suffix: str = "") -> DataFrame:
    """Add the ``block_*`` columns. Under ``drop`` a record with a null key meets nothing."""
    out = df.withColumns({f"block_{k}": key_column(k, null_block, suffix) for k in strategy.keys})
    return out.dropna(subset=strategy.columns) if null_block == "drop" else out


def counted_keys(df: DataFrame, strategy: BlockingStrategy, null_block: str = "literal") -> DataFrame:
    """The block columns with ``_rows``: rows are counted by their plain texts first, so a text that repeats is normalised once a task."""
    plain = [F.col(k) if k in KEY_FIELDS else key_column(k).alias(k) for k in strategy.keys]
    counts = df.select(*plain).groupBy(*strategy.keys).agg(F.count("*").alias("_rows"))
    out = counts.select(*[(block_text(F.col(k), null_block) if k in ("make", "model") else F.col(k)).alias(c)
                          for k, c in zip(strategy.keys, strategy.columns)], "_rows")
    return out.dropna(subset=strategy.columns) if null_block == "drop" else out


def block_label(strategy: BlockingStrategy) -> Column:
    """The block key as text, for display only."""
    return F.concat_ws("|", *[
        F.coalesce(F.col(c).cast("string"), F.lit(MISSING_TEXT)) for c in strategy.columns])


def first_per_block(df: DataFrame, columns: Sequence[str], order: Sequence[str],
                    k: int = CANDIDATES_PER_BLOCK, rank: str = "block_rank") -> DataFrame:
    """The first ``k`` rows of each block. Each task drops later rows before the shuffle."""
    row = F.row_number().over(Window.partitionBy(*columns).orderBy(*order))
    return df.withColumn(rank, row).filter(F.col(rank) <= k)


def same_keys(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """Null-safe equality of two key lists: two missing values are the same block."""
    condition = F.lit(True)
    for a, b in zip(left, right):
        condition = condition & a.eqNullSafe(b)
    return condition


def block_sizes(df: DataFrame, columns: Sequence[str], name: str, rows: int) -> DataFrame:
    """Blocks with more than ``rows`` rows of ``df`` and the number of parts each is dealt into; ``_rows`` counts a row several times."""
    n = F.sum("_rows") if "_rows" in df.columns else F.count("*")
    return (df.groupBy(*columns).agg(n.alias("_n")).filter(F.col("_n") > rows)
            .select(*[F.col(c).alias(f"_hot_{c}") for c in columns],
                    F.ceil(F.col("_n") / F.lit(rows)).cast("int").alias(name)))


def _parts(df: DataFrame, hot: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Add the number of parts of each row's block, 1 where the block is not listed."""
    on = same_keys([F.col(c) for c in columns], [F.col(f"_hot_{c}") for c in columns])
    return (df.join(hot, on, "left").drop(*[f"_hot_{c}" for c in columns])
            .withColumn(name, F.coalesce(name, F.lit(1))))


def pair_tasks(spark: SparkSession) -> int:
    """Tasks that form the pairs of a join: some for each core, and no fewer than any shuffle has."""
    return max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def join_blocks(many: DataFrame, few: DataFrame, columns: Sequence[str], row_id: str,
                counted: DataFrame | None = None, rows_per_task: int = 1_000_000) -> DataFrame:
    """Join within blocks, where ``few`` has a bounded number of rows per block.

    A block with more than ``rows_per_task`` rows of ``many`` is dealt into as
    many parts as its own count asks for, and its few rows are repeated once
    per part. Counts are pre-aggregated over the key columns of ``counted`` alone.
    The number of tasks is fixed: few bytes make many pairs, so bytes must not decide it.
    """
    hot = block_sizes(many if counted is None else counted, columns, "_parts", rows_per_task)
    tasks = pair_tasks(many.sparkSession)
    left = _parts(many, hot, columns, "_parts").withColumn(
        "_salt", F.pmod(F.xxhash64(row_id), F.col("_parts")).cast("int")).drop("_parts")
    left = left.withColumn("_deal", F.xxhash64(*columns, "_salt")).repartition(tasks, "_deal")
    right = _parts(few, hot, columns, "_parts").withColumn(
        "_salt_few", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts")
    right = right.withColumnsRenamed({c: f"_few_{c}" for c in columns})
    right = right.withColumn("_deal_few", F.xxhash64(*[f"_few_{c}" for c in columns], "_salt_few")).repartition(tasks, "_deal_few")
    on = same_keys([F.col(c) for c in columns], [F.col(f"_few_{c}") for c in columns])
    return (left.join(right, (F.col("_deal") == F.col("_deal_few")) & on & (F.col("_salt") == F.col("_salt_few")))
            .drop("_deal", "_deal_few", "_salt", "_salt_few", *[f"_few_{c}" for c in columns]))


def grid_join(left: DataFrame, right: DataFrame, columns: Sequence[str], left_id: str,
              right_id: str, rows_per_task: int = 20_000) -> DataFrame:
    """All pairs within blocks (equal, non-null ``columns``, which both sides have).

    A block large on either side becomes a grid: left rows are dealt into n
    parts, right rows into m, both from the block's own counts, and each cell
    is joined by itself. No task holds a block, and no pair is lost.
    """
    present = F.lit(True)
    for c in columns:
        present = present & F.col(c).isNotNull()
    left, right = left.filter(present), right.filter(present)
    hot = [block_sizes(side, columns, name, rows_per_task)
           for side, name in ((left, "_n"), (right, "_m"))]
    dealt = []
    for side, row, (own, other) in ((left, left_id, ("_n", "_m")), (right, right_id, ("_m", "_n"))):
        for sizes, name in zip(hot, ("_n", "_m")):
            side = _parts(side, sizes, columns, name)
        dealt.append(side.withColumn(f"_cell{own}", F.pmod(F.xxhash64(row), F.col(own)).cast("int"))
                     .withColumn(f"_cell{other}", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
                     .drop("_n", "_m"))
    return dealt[0].join(dealt[1], [*columns, "_cell_n", "_cell_m"]).drop("_cell_n", "_cell_m")
