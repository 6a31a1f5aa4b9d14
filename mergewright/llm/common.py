"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
#: Fixed value: the C library's number for the size from which a buffer is the system's own; and that size in bytes.
M_MMAP_THRESHOLD, LARGE_BUFFER = -3, 1 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_or_empty(text: Column | str) -> Column:
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(column.cast("string"), F.lit(""))


def in_test_fold(doc_id: Column | str) -> Column:
    """The fifth of the documents that no model may learn from: crc32 of the id as text, modulo 5, is 0.

    A null id has no digest and counts as held out.
    """
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def worker_cache(name: str, make: Callable[[], Any]) -> Any:
    """An object kept by a Python worker between tasks (functions are sent by value, so their globals are not).

    A worker keeps one object: a function that asks for another, or for none
    (``forget_worker_cache``), frees what an earlier stage left in it.
    """
    store = sys.modules.setdefault("_llm_worker_cache", types.ModuleType("_llm_worker_cache"))
    held = vars(store).setdefault("held", {})
    if name not in held:
        held.clear()
        free_memory()
        held[name] = make()
    return held[name]


def free_memory() -> None:
    """Hand memory that is free in this process back to the system: Arrow's, and the C library's where it can.

    Workers live on between tasks; without this each would keep the most that any stage took. From the first call on, large
    buffers come from the system one by one and go back when they are freed.
    """
    import ctypes

    try:
        library = ctypes.CDLL(None)
        if pa.default_memory_pool().backend_name != "system":
            pa.set_memory_pool(pa.system_memory_pool())
            library.mallopt(M_MMAP_THRESHOLD, LARGE_BUFFER)
        library.malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass
    pa.default_memory_pool().release_unused()


def forget_worker_cache() -> None:
    """For functions that keep nothing: drop what an earlier stage kept, and hand free memory back."""
    if "_llm_worker_cache" in sys.modules:
        vars(sys.modules["_llm_worker_cache"]).get("held", {}).clear()
    free_memory()


def slices(batch: pa.RecordBatch, column: str, budget: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the texts of a slice have about ``budget`` bytes (one longer text is a slice)."""
    import numpy as np
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes) // budget
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for start, end in zip(edges, edges[1:], strict=False):
        if end > start:
            yield batch.slice(start, end - start)
            # What a slice used goes back to the system before the next one.
            free_memory()


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one by one, so that one large row at a time is held as Python objects."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def lower_ascii(texts: pa.Array) -> pa.Array:
    """A-Z lower-cased in an array of texts (null: empty), on the bytes themselves."""
    import numpy as np
    import pyarrow.compute as pc

    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    lowered = table[np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]]] if offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(np.ascontiguousarray(offsets - offsets[0])), pa.py_buffer(lowered))


def bounded_sample(docs: DataFrame, keys: DataFrame, by: str, bound: int) -> DataFrame:
    """(``by``, doc_id, text) of at most ``bound`` rows for each value of ``by``: the first by a hash of the id.

    ``keys`` has doc_id and ``by``. The chosen ids are few (bound times values), so they are broadcast; a
    second cut keeps the bound where many rows of ``docs`` share a chosen id. Ranking is
    limited inside each task before anything is shuffled.
    """
    first = Window.partitionBy(by).orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = (keys.select(by, "doc_id").filter(F.col("doc_id").isNotNull()).distinct()
              .withColumn("__n", F.row_number().over(first)).filter(F.col("__n") <= bound)
              .select(by, F.col("doc_id").alias("__chosen")))
    second = Window.partitionBy(by).orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"))
    return (docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("__chosen"))
            .drop("__chosen").withColumn("__n", F.row_number().over(second)).filter(F.col("__n") <= bound).drop("__n"))
