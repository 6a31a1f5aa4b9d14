"""Running sums within a key, with no task that holds a key."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BooleanType, IntegerType, LongType, StructField, StructType

from mergewright.sources.staging import stage


def running(df: DataFrame, key: str, order: Sequence[Column], values: Sequence[str]) -> DataFrame:
    """Add ``before_<v>``: the sum of ``v`` over the earlier rows of the same key, in the given order.

    ``key`` and ``values`` are longs without nulls. Rows are range-partitioned by key and order, summed inside tasks,
    and written; each task adds a mark with the sum of its last key. The marks, one a partition, tell what the
    partitions before had of a key that goes on into the next one.
    """
    spark = df.sparkSession
    columns, names = df.columns, [f"before_{v}" for v in values]
    schema = StructType([*[StructField(f.name, f.dataType) for f in df.schema], *[StructField(n, LongType()) for n in names],
                         StructField("part", IntegerType()), StructField("mark", BooleanType())])
    arrow = to_arrow_schema(schema)

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        last, held = None, np.zeros(len(values), np.int64)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = batch.column(key).to_numpy()
            own = np.stack([batch.column(v).to_numpy() for v in values], axis=1)
            upto = np.cumsum(own, axis=0) - own
            change = np.concatenate([[True], keys[1:] != keys[:-1]])
            first = np.maximum.accumulate(np.where(change, np.arange(n), 0))
            before = upto - upto[first]
            if last is not None and keys[0] == last:
                before[first == 0] += held
            last, held = int(keys[-1]), before[-1] + own[-1]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).cast(arrow.field(c).type) for c in columns),
                 *(pa.array(before[:, i]) for i in range(len(values))), pa.array(np.full(n, part, np.int32)),
                 pa.array(np.zeros(n, bool))], schema=arrow)
        if last is not None:
            row = {c: [None] for c in columns} | {key: [last], "part": [part], "mark": [True]}
            row |= {name: [int(v)] for name, v in zip(names, held, strict=True)}
            yield pa.RecordBatch.from_pydict(row, schema=arrow)

    summed = stage(df.repartitionByRange(F.col(key), *order).sortWithinPartitions(F.col(key), *order)
                   .mapInArrow(run, schema), "running")
    marks = summed.filter("mark").select("part", key, *names).orderBy("part").collect()
    carried, gone = [], None
    for mark in marks:
        sums = [mark[n] for n in names]
        if gone is not None:
            carried.append((mark["part"], *gone))
            if gone[0] == mark[key]:
                sums = [a + b for a, b in zip(sums, gone[1:], strict=True)]
        gone = (mark[key], *sums)
    kind = ", ".join(["part int", f"{key} long", *[f"__{n} long" for n in names]])
    return (summed.filter("not mark").join(F.broadcast(spark.createDataFrame(carried, kind)), ["part", key], "left")
            .select(*columns, *[(F.col(n) + F.coalesce(f"__{n}", F.lit(0))).alias(n) for n in names]))
