"""A corpus pipeline: each stage reads what its predecessor kept, written as Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mergewright.llm import exact_dedup, near_join, packing, secrets, toxicity
from mergewright.sources.staging import stage

STAGES = [
    ("toxicity", toxicity.toxicity_stage),
    ("exact dedup", exact_dedup.dedup_stage),
    ("n-gram jaccard join", near_join.near_stage),
    ("secret scans", secrets.secrets_stage),
    ("packing", packing.pack_stage),
]

#: Model scores and token ids are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents`` one after another."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stage(docs, f"stage-{name.replace(' ', '-')}")
    return docs
