"""A stored table with one row per key, brought up to date chunk by chunk."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mergewright.operators.dedup import one_per_key
from mergewright.sources.staging import stage

BUCKET = "key_bucket"


@dataclass(frozen=True)
class KeyedTable:
    """Rows by key under ``path``, in one folder per hash bucket of the keys.

    A new chunk replaces rows of equal keys and adds the others. Only buckets that the chunk touches are read and written again; the files
    of the others stay as they are. Choose ``buckets`` so that one is a task's work; it must not change
    for a table.
    """

    path: str
    keys: tuple[str, ...]
    buckets: int = 64

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def read(self, spark: SparkSession, like: DataFrame) -> DataFrame:
        """The table, with the columns of ``like``; empty where nothing was written yet."""
        schema = T.StructType([*like.schema.fields, T.StructField(BUCKET, T.IntegerType())])
        try:
            held = spark.read.schema(schema).parquet(self.path)
        except Exception as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            held = spark.createDataFrame([], schema)
        return held

    def upsert(self, chunk: DataFrame, order: Sequence[str]) -> None:
        """Bring the table up to date with ``chunk``; of rows with one key in it the last by ``order`` counts.

        The new buckets are written beside the table first, so that a run that fails half-way leaves it as it was; putting them
        in place replaces whole folders.
        """
        spark = chunk.sparkSession
        fresh = one_per_key(chunk, self.keys, order, keep="last").withColumn(BUCKET, self._bucket())
        fresh = stage(fresh, "upsert-chunk")
        # At most one number a bucket.
        touched = [r[0] for r in fresh.select(BUCKET).distinct().collect()]
        if not touched:
            return
        held = self.read(spark, chunk).filter(F.col(BUCKET).isin(touched))
        kept = held.join(fresh.select(BUCKET, *self.keys), [BUCKET, *self.keys], "left_anti").select(*fresh.columns)
        merged = stage(kept.unionByName(fresh).repartition(min(len(touched), self.buckets), BUCKET), "upsert-merged")
        (merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(self.path))
