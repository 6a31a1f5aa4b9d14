"""Session settings used by the bench, the tests and stand-alone runs.

The library itself never changes a session it is given; everything here is a
default for sessions that we start ourselves.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Re-plan at run time: coalesce small shuffle partitions, split skewed
    # ones, and turn sort-merge joins into broadcasts only once the real size
    # of a side is known.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "mergewright", **extra: str) -> SparkSession:
    """Start (or get) a session with the settings above.

    ``shuffle_partitions`` is best left alone on a cluster: set it there to two
    or three times the number of cores and let adaptive execution coalesce.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
