"""Exact deduplication by two passes with a Bloom filter.

The first pass sets, for each text digest, a few bits in a filter, and learns
which bits were set by two rows or more. The second pass asks for each digest
whether all its bits were; if not, the digest is unique and its row passes
straight through. Only the other rows are shuffled and compared.

The filter has a fixed largest size. Where the corpus needs more, digests are
dealt into slices, and the two passes run slice by slice over the narrow table
of digests; the result is the same. The filter may only err by sending a unique
row through the shuffle.

Texts are equal when they are after deleting every blank of [\\x20\\x09-\\x0D]; a
null text equals an empty one. Of equal texts, the row with most code points
stays, then the one with the smallest doc_id (a null id counts as smallest),
then, for repeated rows, one of them.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mergewright.llm import common
from mergewright.sources.staging import stage

#: Largest filter (of which a task holds two) and its parameters.
FILTER_BYTES = 64 << 20
BITS_PER_ROW = 10
HASHES = 3
CHUNK = 4096
#: Chunks that a task gives out at a time.
CHUNKS_AT_ONCE = 512


def digest(text: Column | str) -> Column:
    """SHA-256 of the normalised text, 32 bytes."""
    return F.unhex(F.sha2(F.translate(common.text_or_empty(text), common.WHITE, "").cast("binary"), 256))


def slice_of(sha: Column | str, slices: int) -> Column:
    return F.pmod(F.xxhash64(sha), F.lit(slices))


def positions(shas: pa.Array, bits: int) -> np.ndarray:
    """The bits of each digest (of 16 bytes or more): rows by hashes."""
    words = np.frombuffer(b"".join(shas.to_pylist()), "<u8").reshape(len(shas), -1)
    steps = np.arange(HASHES, dtype=np.uint64)
    return ((words[:, :1] + steps * (words[:, 1:2] | np.uint64(1))) % np.uint64(bits)).astype(np.int64)


def has_all(bitmap: np.ndarray, at: np.ndarray) -> np.ndarray:
    return ((bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=1)


def set_all(bitmap: np.ndarray, at: np.ndarray) -> None:
    flat = at.ravel()
    np.bitwise_or.at(bitmap, flat >> 3, np.left_shift(1, flat & 7).astype(np.uint8))


def filter_bits(shas: DataFrame, bits: int, which: str = "twice") -> np.ndarray:
    """Pass 1: the bits that were set twice, or with ``which`` "seen" all that were set.

    Each task fills two bitmaps, bits seen and bits seen twice. Their touched
    chunks are merged by chunk number: a bit that two tasks saw is a bit seen
    twice. What reaches the driver is the one bitmap, of at most FILTER_BYTES.
    """
    size = bits // 8
    chunk = min(CHUNK, size)
    need_twice = which == "twice"

    def fill(batches):
        common.forget_worker_cache()
        seen, twice = np.zeros(size, np.uint8), np.zeros(size if need_twice else 0, np.uint8)
        for batch in batches:
            if not batch.num_rows:
                continue
            at = positions(batch.column(0), bits)
            if need_twice:
                keys, counts = np.unique(at, axis=0, return_counts=True)
                set_all(twice, keys[(counts > 1) | has_all(seen, keys)])
                set_all(seen, keys)
            else:
                set_all(seen, at)
        yield from emit({i: (seen[i * chunk:(i + 1) * chunk], twice[i * chunk:(i + 1) * chunk])
                         for i in np.flatnonzero(seen.reshape(-1, chunk).any(axis=1)).tolist()})

    def emit(chunks):
        items = list(chunks.items())
        for i in range(0, len(items), CHUNKS_AT_ONCE):
            some = items[i:i + CHUNKS_AT_ONCE]
            yield pa.RecordBatch.from_pydict({"chunk": pa.array([c for c, _ in some], pa.int32()),
                                              "seen": pa.array([s.tobytes() for _, (s, _) in some], pa.binary()),
                                              "twice": pa.array([t.tobytes() if need_twice else b"" for _, (_, t) in some], pa.binary())})
        del items
        chunks.clear()
        common.free_memory()

    def merge(batches):
        chunks: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for i, s, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                s, t = np.frombuffer(s, np.uint8), np.frombuffer(t, np.uint8)
                if i in chunks:
                    a, b = chunks[i]
                    chunks[i] = (a | s, b | t | (a & s) if need_twice else t)
                else:
                    chunks[i] = (s, t)
        yield from emit(chunks)

    kind = "chunk int, seen binary, twice binary"
    merged = (shas.mapInArrow(fill, kind).repartition("chunk").mapInArrow(merge, kind)
              .select("chunk", F.col(which).alias("bitmap")))
    out = np.zeros(size, np.uint8)
    # At once: row by row each partition would be a job of its own, and merge its chunks after the one before.
    for row in merged.collect():
        out[row.chunk * chunk:(row.chunk + 1) * chunk] = np.frombuffer(row.bitmap, np.uint8)
    return out


def bits_for(rows: int, filter_bytes: int) -> int:
    """A power of two, BITS_PER_ROW a row or more, at most the filter's size."""
    return min(max(1 << max(16, (BITS_PER_ROW * rows - 1).bit_length()), 8), filter_bytes * 8)


class Repeats:
    """The finished filters: one per slice."""

    def __init__(self, shas: DataFrame, filter_bytes: int = FILTER_BYTES):
        spark = shas.sparkSession
        rows = shas.count()
        self.slices = max(1, -(-rows * BITS_PER_ROW // (filter_bytes * 8)))
        self.bits = bits_for(-(-rows // self.slices), filter_bytes)
        self.filters = []
        for i in range(self.slices):
            some = shas if self.slices == 1 else shas.filter(slice_of("sha", self.slices) == i)
            self.filters.append(spark.sparkContext.broadcast(filter_bits(some.select("sha"), self.bits)))

    def maybe(self, sha: Column, i: int) -> Column:
        """Pass 2: whether a digest of slice ``i`` may occur twice (never false for one that does)."""
        bits, held = self.bits, self.filters[i]

        @F.arrow_udf("boolean")
        def ask(shas: pa.Array) -> pa.Array:
            return pa.array(has_all(held.value, positions(shas, bits)) if len(shas) else [], pa.bool_())

        return ask(sha)

    def split(self, df: DataFrame, sha: str) -> tuple[DataFrame, DataFrame]:
        """Rows that pass straight through, and rows that may have an equal."""
        once, more = [], []
        for i in range(self.slices):
            part = df if self.slices == 1 else df.filter(slice_of(sha, self.slices) == i)
            part = part.withColumn("__more", self.maybe(F.col(sha), i))
            once.append(part.filter(~F.col("__more")).drop("__more"))
            more.append(part.filter(F.col("__more")).drop("__more"))
        return union(once), union(more)


def member_filter(keys: DataFrame, filter_bytes: int = FILTER_BYTES) -> Callable[[Column], Column]:
    """Whether a digest may be among ``keys`` (one column, not null): never false for one that is.

    The filter has a bounded size; past it more digests are taken in, none is lost.
    """
    bits = bits_for(keys.count(), filter_bytes)
    held = keys.sparkSession.sparkContext.broadcast(filter_bits(keys, bits, "seen"))

    @F.arrow_udf("boolean")
    def ask(shas: pa.Array) -> pa.Array:
        return pa.array(has_all(held.value, positions(shas, bits)) if len(shas) else [], pa.bool_())

    return ask


def union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def groups(docs: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Only ids, digests and lengths are staged or shuffled. A group is first
    reduced to its best row in each task; the join back to its rows is an
    equi-join that adaptive execution may split.
    """
    narrow = stage(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), digest("text").alias("sha"),
        F.length(common.text_or_empty("text")).alias("points"), F.monotonically_increasing_id().alias("row")), "digests")
    once, more = Repeats(narrow.select("sha"), filter_bytes).split(narrow, "sha")
    # Staged, so that both sides of the join are shuffled and a hot digest can be split at run time.
    best = stage(more.groupBy("sha").agg(
        F.min(F.struct((-F.col("points")).alias("less"), "doc_id", "row")).alias("best"),
        F.count("*").alias("group_size")), "groups")
    hexed = F.lower(F.hex("sha")).alias("text_sha256")
    return (more.join(best, "sha").select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"), hexed)
        .unionByName(once.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
                                 F.lit(True).alias("kept"), hexed)))


def keep_one(docs: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Unique texts are never shuffled. Of the rest, a task sends at most one row
    of each text.
    """
    columns = docs.columns
    with_sha = docs.withColumn("__sha", digest("text"))
    once, more = Repeats(stage(with_sha.select(F.col("__sha").alias("sha")), "digests"), filter_bytes).split(
        with_sha, "__sha")
    best = more.groupBy("__sha").agg(F.min_by(
        F.struct(*[F.col(f"`{c}`") for c in columns]),
        F.struct((-F.length(common.text_or_empty("text"))).alias("less"), F.col("doc_id"), F.col("text"))).alias("best"))
    return once.select(*[f"`{c}`" for c in columns]).unionByName(best.select("best.*"))


def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of equal texts over all documents."""
    return groups(common.table(spark, folder, "documents"))


def dedup_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return keep_one(docs)


OP5_SQL = r"""
with d as (
  select doc_id, coalesce(text, '') as t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as n from documents),
g as (select doc_id, sha256(n) as text_sha256, length(t) as points from d)
select doc_id,
       first_value(doc_id) over (partition by text_sha256 order by points desc, doc_id) as keep_id,
       count(*) over (partition by text_sha256) as group_size,
       row_number() over (partition by text_sha256 order by points desc, doc_id) = 1 as kept,
       text_sha256
from g
"""
