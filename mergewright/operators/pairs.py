"""Labelled pairs of two mediated sources, and the records behind pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mergewright.functions.text import norm_linker
from mergewright.operators.blocking import (
    KEY_FIELDS,
    BlockingStrategy,
    counted_keys,
    first_per_block,
    join_blocks,
    with_block,
)
from mergewright.operators.dedup import one_per_key, one_per_vin
from mergewright.operators.ranking import first_rows
from mergewright.schema import CANDIDATES_PER_BLOCK, MEDIATED
from mergewright.sources.scans import require_columns
from mergewright.sources.staging import stage

_RANK = "_rank_B"


def _side(df: DataFrame, suffix: str, order: Sequence[str], keep: str) -> DataFrame:
    """One row per VIN with suffixed columns; the order columns become ``_order_*``."""
    require_columns(df, [*MEDIATED.names, *order], f"source {suffix}")
    rows = one_per_vin(df, order, keep)
    return rows.select(
        *[F.col("vin_clean" if c == "vin" else c).alias(f"{c}_{suffix}") for c in MEDIATED.names],
        *[F.col(c).alias(f"_order_{suffix}_{i}") for i, c in enumerate(order)])


def pair_columns(strategy: BlockingStrategy) -> list[str]:
    names = [c for c in MEDIATED.names if strategy.keep_vin or c != "vin"]
    return [f"{c}_{s}" for c in names for s in ("A", "B")]


def _order_of(a: DataFrame) -> list[str]:
    return [c for c in a.columns if c.startswith("_order_A_")]


def _order(df: DataFrame) -> list[str]:
    return [*_order_of(df), _RANK]


def positives(a: DataFrame, b: DataFrame) -> DataFrame:
    """Pairs that share a VIN, whatever their blocks; ``a``, ``b`` come from ``sides``.

    Both sides were ranked by VIN, so they are already partitioned for this join.
    """
    return (a.join(b, F.col("vin_A") == F.col("vin_B"))
            .withColumns({_RANK: F.lit(0), "label": F.lit(1)}))


def negatives(a: DataFrame, b: DataFrame, strategy: BlockingStrategy,
              k: int = CANDIDATES_PER_BLOCK, null_block: str = "literal",
              counted: DataFrame | None = None, **spread: int) -> DataFrame:
    """Pairs in one block whose VINs differ, with the first ``k`` rows of B per block.

    The rank is taken before the VIN test, so a block that ranks A's own VIN
    gives one pair less.
    """
    # The VIN last: rows level in all order columns come in one order, however often they are ranked.
    order_b = [*[c for c in b.columns if c.startswith("_order_B_")], "vin_B"]
    top = first_per_block(with_block(b, strategy, null_block, "_B"), strategy.columns, order_b,
                          k, _RANK)
    met = join_blocks(with_block(a, strategy, null_block, "_A"), top, strategy.columns, "id_A",
                      counted, **spread)
    return met.filter(F.col("vin_A") != F.col("vin_B")).withColumn("label", F.lit(0))


def matched(a: DataFrame, b: DataFrame) -> DataFrame:
    """The order columns of rows of A that share a VIN with a row of B."""
    return a.join(b, F.col("vin_A") == F.col("vin_B"), "left_semi").select(*_order_of(a))


def _blocked(a: DataFrame, b: DataFrame, strategy: BlockingStrategy, k: int, null_block: str, **spread: int) -> DataFrame:
    """The order columns of rows of A with a pair in ``negatives``: a VIN besides their own among the first ``k`` of their block."""
    top = first_per_block(with_block(b, strategy, null_block, "_B"), strategy.columns,
                          [c for c in b.columns if c.startswith("_order_B_")], k, _RANK)
    ends = top.groupBy(*strategy.columns).agg(F.min("vin_B").alias("_least"), F.max("vin_B").alias("_greatest"))
    met = join_blocks(with_block(a, strategy, null_block, "_A"), ends, strategy.columns, "id_A", **spread)
    return met.filter((F.col("_least") != F.col("vin_A")) | (F.col("_greatest") != F.col("vin_A"))).select(*_order_of(a))


def up_to(a: DataFrame, order: Sequence[str], paired: DataFrame, n: int) -> DataFrame:
    """Rows of A, before the choice by VIN, up to the ``n``-th of the rows whose order columns ``paired`` holds."""
    last = first_rows(paired, paired.columns, n).agg(F.max(F.struct(*paired.columns))).first()[0]
    if last is None:
        return a.limit(0)
    bound = F.struct(*[F.lit(v).cast(a.schema[c].dataType).alias(f"_{i}") for i, (c, v) in enumerate(zip(order, last))])
    # The first column alone says less, but a scan can be filtered by it.
    early = F.col(order[0]).isNull()
    if last[0] is not None:
        early = early | (F.col(order[0]) <= F.lit(last[0]).cast(a.schema[order[0]].dataType))
    return a.filter(early & (F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(order)]) <= bound))


def sides(a: DataFrame, b: DataFrame, order_a: Sequence[str] = ("id",),
          order_b: Sequence[str] = ("id",), keep_a: str = "first",
          keep_b: str = "last") -> tuple[DataFrame, DataFrame]:
    """Both sources, one row per valid VIN: the first of A, the last of B."""
    return _side(a, "A", order_a, keep_a), _side(b, "B", order_b, keep_b)


def label_pairs(a: DataFrame, b: DataFrame, strategy: BlockingStrategy,
                order_a: Sequence[str] = ("id",), order_b: Sequence[str] = ("id",),
                k: int = CANDIDATES_PER_BLOCK, cap: int | None = None,
                null_block: str = "literal", held: tuple[DataFrame, DataFrame] | None = None, **spread: int) -> DataFrame:
    """Matches by VIN and non-matches by block, as one labelled pair table.

    ``cap`` keeps the first so many pairs of each label in the order of A, of any
    ordered type. Which rows of A have a pair is then found first, on the columns that tell it; only the pairs of the
    first ``cap`` such rows are formed, written once, in the shared folder, and cut: no other pair can be among the first.
    ``held`` is what ``sides`` gave for ``a`` and ``b``, written, for callers that need pairs more than once; a ``cap`` does not go by it.
    """
    side_a, side_b = held or sides(a, b, order_a, order_b)
    if held and cap is None:
        plain = side_a.select(*[F.col(f"{c}_A").alias(c) for c in MEDIATED.names])
        parts = [positives(side_a, side_b), negatives(side_a, side_b, strategy, k, null_block,
                                                      counted_keys(plain, strategy, null_block), **spread)]
    elif cap is None:
        parts = [positives(side_a, side_b), negatives(side_a, side_b, strategy, k, null_block,
                                                      counted_keys(a, strategy, null_block), **spread)]
    else:
        side_a, side_b = sides(a, b, order_a, order_b)
        side_b = stage(side_b, "side-b")
        keys = stage(side_a.select("id_A", "vin_A", *_order_of(side_a), *[f"{c}_A" for c in MEDIATED.names if c in {*KEY_FIELDS, *strategy.keys} - {"id", "vin"}]), "keys-a")
        met = [matched(keys, side_b), _blocked(keys, side_b, strategy, k, null_block, **spread)]
        first = [(_side(up_to(a, order_a, stage(m, "paired"), cap), "A", order_a, "first"), side_b) for m in met]
        parts = [positives(*first[0]), negatives(*first[1], strategy, k, null_block, **spread)]
        parts = [first_rows(stage(p, "uncapped"), _order(p), cap) for p in parts]
    columns = [*pair_columns(strategy), "label"]
    return parts[0].select(*columns).unionByName(parts[1].select(*columns))


def sides_of_pairs(pairs: DataFrame, order: Sequence[str]) -> DataFrame:
    """Both sides of a pair table under each other, suffix stripped, ``source`` added."""
    require_columns(pairs, ["id_A", "id_B"], "pair table")
    names = [c[:-2] for c in pairs.columns if c.endswith("_A")]

    def side(s: str) -> Column:
        return F.struct(F.lit(s).alias("source"), *[F.col(f"{c}_{s}").alias(c) for c in names])

    # Both sides of a row at once: a union would form the pairs twice.
    return pairs.select(F.explode(F.array(side("A"), side("B"))).alias("_side"),
                        *[F.col(c).alias(f"_order_{i}") for i, c in enumerate(order)]).select("_side.*", *[
                            f"_order_{i}" for i in range(len(order))])


def records_from_pairs(pairs: DataFrame, order: Sequence[str] = ("id_A", "id_B"),
                       keep: str = "first") -> DataFrame:
    """The records of a pair table, one per (source, id)."""
    rows = sides_of_pairs(pairs, order)
    by = [c for c in rows.columns if c.startswith("_order_")]
    return one_per_key(rows, ["source", "id"], by, keep).drop(*by)


def records_for_linker(pairs: DataFrame, order: Sequence[str] = ("id_A", "id_B")) -> DataFrame:
    """Records as the learned linker compares them: last one wins, texts normalised.

    Price and mileage stay numbers; every other field becomes normalised text.
    """
    records = records_from_pairs(pairs, order, keep="last")
    fixed = {"source", "id", "price", "mileage"}
    return records.select(*[
        F.col(c) if c in fixed else norm_linker(F.col(c).cast("string")).alias(c)
        for c in records.columns])


def true_links(pairs: DataFrame) -> DataFrame:
    return pairs.filter(F.col("label") == 1).select("id_A", "id_B").distinct()


def label_sample(pairs: DataFrame, n: int, order: Sequence[str] = ("id_A", "id_B")) -> DataFrame:
    """The first ``n`` pairs of each label."""
    return first_per_block(pairs, ["label"], order, n, "_row").drop("_row")
