"""Written tables between steps.

An iterative job must cut its lineage somewhere that survives the loss of
executors: a table in the folder that the cluster names for checkpoints.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_folder: str | None = None


def shared_folder(spark: SparkSession, folder: str | None = None) -> str:
    """``folder`` if given, else the folder named by ``spark.checkpoint.dir``.

    Only a session in one process (``local`` or ``local[n]``) may do without: it gets a temporary
    folder. Otherwise a missing setting is an error, since executors share no local disk.
    """
    named = folder or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    global _local_folder
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="mergewright-")
    return _local_folder


def new_path(spark: SparkSession, name: str, folder: str | None = None) -> str:
    return f"{shared_folder(spark, folder)}/mergewright/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back."""
    spark = df.sparkSession
    path = new_path(spark, name, folder)
    # Texts that repeat from row to row shrink to a fraction.
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
