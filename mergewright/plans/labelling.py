"""Raw tables to labelled, split pairs."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from mergewright.functions.missing import NA_TOKENS, nulls_in_frame
from mergewright.operators.blocking import STRATEGIES, BlockingStrategy
from mergewright.operators.mediate import mediate
from mergewright.operators.pairs import label_pairs, sides
from mergewright.operators.split import PARTS, split_stratified
from mergewright.schema import SOURCE_A, SOURCE_B
from mergewright.sources.sinks import write_splits
from mergewright.sources.staging import stage


def mediated_sources(raw_a: DataFrame, raw_b: DataFrame, keep: Sequence[str] = (),
                     tokens: Sequence[str] = NA_TOKENS) -> tuple[DataFrame, DataFrame]:
    """Both raw text tables with missing-value tokens removed, in the mediated schema."""
    return (mediate(nulls_in_frame(raw_a, tokens), SOURCE_A, keep),
            mediate(nulls_in_frame(raw_b, tokens), SOURCE_B, keep))


@dataclass(frozen=True)
class Prepared:
    """Where the splits were written, and what was counted on the way.

    ``counts`` has, by strategy, split and label, the pairs written and those without a price on either side.
    """

    path: str
    counts: DataFrame


def counted_while_written(splits: DataFrame, path: str, mode: str, classes: Sequence[int] = (0, 1)) -> list[tuple]:
    """Write ``splits``; (split, label, pairs, pairs without a price) are observed on the plan that writes, by no further job."""
    cells = [(part, label) for part in PARTS for label in classes]
    bare = F.col("price_A").isNull() | F.col("price_B").isNull()
    metrics = []
    for i, (part, label) in enumerate(cells):
        here = (F.col("split") == part) & (F.col("label") == label)
        metrics += [F.count_if(here).alias(f"n{i}"), F.count_if(here & bare).alias(f"bare{i}")]
    seen = Observation()
    write_splits(splits.observe(seen, *metrics), path, mode)
    found = seen.get
    return [(part, label, found[f"n{i}"], found[f"bare{i}"]) for i, (part, label) in enumerate(cells)]


def prepare_splits(a: DataFrame, b: DataFrame, path: str,
                   strategies: Sequence[BlockingStrategy] = tuple(STRATEGIES.values()),
                   order: Sequence[str] = ("id",), cap: int | None = None) -> Prepared:
    """Label pairs under each strategy, split them and write them by strategy and split.

    One row per VIN is chosen and written once for all strategies. The split reads the ids of pairs three times, so these are written;
    the pairs, which are several times the records, are formed once more as they are written by split. ``cap`` keeps
    the first so many pairs of each label; by default all are kept. Pairs that are capped are written before the split.
    """
    counts = []
    held = tuple(stage(side, "side") for side in sides(a, b, order, order)) if cap is None else None
    for i, strategy in enumerate(strategies):
        pairs = label_pairs(a, b, strategy, order, order, cap=cap, held=held)
        if held:
            keys = stage(pairs.select("id_A", "id_B", "label"), f"keys-{strategy.name}")
        else:
            keys = pairs = stage(pairs, f"pairs-{strategy.name}")
        splits = split_stratified(pairs, keys=keys).withColumn("strategy", F.lit(strategy.name))
        counts += [(strategy.name, *row) for row in counted_while_written(splits, path, "overwrite" if i == 0 else "append")]
    # One row per strategy, split and label.
    table = a.sparkSession.createDataFrame(counts, "strategy string, split string, label int, n bigint, without_price bigint")
    return Prepared(path, table.filter("n > 0"))
