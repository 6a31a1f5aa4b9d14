"""Token ids as length-delimited binary records, with an offset index beside them.

File format (little-endian), one record after another:

    uint64 n | uint32 masked checksum of those 8 bytes | n bytes | uint32 masked checksum of them

The n bytes are one serialised sequence: int64 doc_id, uint8 flags (1: the id
is null, 2: ids are uint32 rather than uint16), then the ids. A checksum is
crc32, rotated right by 15 bits plus a constant, so that a checksum of data
that holds checksums stays meaningful.

Documents are range-partitioned by doc_id, so files in order of (part, file)
hold ascending ids. A task gives its files fresh names; the index, a Parquet
table that Spark commits, lists the files that count. Files of failed or
repeated attempts are never listed, so executors may be lost at any time.

Null ids come first; a null text is an empty one; rows with an equal id follow each other
in an order that a digest of their text decides between files and the text within one. No row is dropped; an empty table gives an empty index.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mergewright.llm import common, tokens
from mergewright.sources.staging import new_path

#: Fixed value of the checksum mask.
MASK = 0xA282EAD8
FILE_BYTES = 256 << 20
INDEX = ("part long, file_no int, file string, doc_id long, offset long, length long, n_tokens long")
READ = "doc_id long, start long, n_tokens long, ids binary"


@dataclass(frozen=True)
class RecordSet:
    """Where a set of records lies: a folder of record files and a Parquet index."""

    folder: str
    index: str


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK) & 0xFFFFFFFF


def serialise(doc_id: int | None, ids: np.ndarray) -> bytes:
    wide = bool(len(ids)) and int(ids.max()) > 0xFFFF
    head = struct.pack("<qB", doc_id or 0, (doc_id is None) + 2 * wide)
    return head + ids.astype("<u4" if wide else "<u2").tobytes()


def parse(payload: bytes) -> tuple[int | None, np.ndarray]:
    doc_id, flags = struct.unpack_from("<qB", payload)
    ids = np.frombuffer(payload, "<u4" if flags & 2 else "<u2", offset=9)
    return None if flags & 1 else doc_id, ids.astype("<u4")


def frame(payload: bytes) -> bytes:
    size = struct.pack("<Q", len(payload))
    return b"".join((size, struct.pack("<I", masked(size)), payload, struct.pack("<I", masked(payload))))


def unframe(source, name: str) -> Iterator[bytes]:
    """Payloads of an open file, one at a time; a wrong checksum or a cut record is an error."""
    while head := source.read(12):
        size, check = struct.unpack("<QI", head) if len(head) == 12 else (0, -1)
        if masked(head[:8]) != check:
            raise ValueError(f"{name}: broken record length")
        body = source.read(size + 4)
        if len(body) != size + 4 or masked(body[:-4]) != struct.unpack("<I", body[-4:])[0]:
            raise ValueError(f"{name}: broken record")
        yield body[:-4]


def opened(uri: str):
    """The file system of a folder that all executors share, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def write_records(docs: DataFrame, end_id: int | None = 0, path: str | None = None,
                  file_bytes: int = FILE_BYTES) -> RecordSet:
    """Encode ``docs`` (doc_id, text), append ``end_id`` to each, and write them in ascending doc_id order."""
    spark = docs.sparkSession
    root = new_path(spark, "records")
    folder, index = f"{root}/data", f"{root}/index"
    text = spark.sparkContext.broadcast(tokens.definition(path))
    schema = pa.schema([("part", pa.int64()), ("file_no", pa.int32()), ("file", pa.string()), ("doc_id", pa.int64()),
                        ("offset", pa.int64()), ("length", pa.int64()), ("n_tokens", pa.int64())])
    end = np.array([] if end_id is None else [end_id], np.uint32)

    def write(batches):
        from pyspark import TaskContext

        encoder = tokens.worker_encoder(text.value)
        part = TaskContext.get().partitionId()
        store, base = opened(folder)
        store.create_dir(base, recursive=True)
        sink, name, file_no, at = None, "", -1, 0
        try:
            for batch in batches:
                for piece in common.slices(batch, "text"):
                    rows = []
                    doc_ids = piece.column("doc_id").to_pylist()
                    for doc_id, ids in zip(doc_ids, encoder.encode(piece.column("text")), strict=True):
                        ids = np.concatenate([ids, end])
                        record = frame(serialise(doc_id, ids))
                        if sink is None or at + len(record) > file_bytes and at:
                            if sink is not None:
                                sink.close()
                            file_no, at = file_no + 1, 0
                            name = f"part-{part:06d}-{file_no:04d}-{uuid.uuid4().hex}.rec"
                            sink = store.open_output_stream(f"{base}/{name}", buffer_size=1 << 20)
                        sink.write(record)
                        rows.append((part, file_no, name, doc_id, at, len(record), len(ids)))
                        at += len(record)
                    if rows:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)],
                            schema=schema)
        finally:
            if sink is not None:
                sink.close()

    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_or_empty("text").alias("text"))
     .repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")
     .mapInArrow(write, INDEX).write.parquet(index))
    return RecordSet(folder, index)


def read_index(spark: SparkSession, records: RecordSet) -> DataFrame:
    return spark.read.schema(INDEX).parquet(records.index)


def file_starts(index: DataFrame) -> DataFrame:
    """One row per file: ids in all files before it. The window is over files, not records."""
    files = index.groupBy("part", "file_no", "file").agg(F.sum("n_tokens").alias("ids"), F.count("*").alias("records"))
    before = Window.orderBy("part", "file_no").rowsBetween(Window.unboundedPreceding, -1)
    return files.select("file", "records", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))


def read_records(spark: SparkSession, records: RecordSet) -> DataFrame:
    """Records of every listed file, streamed and checked: doc_id, ids before it in all files, ids (uint32)."""
    folder = records.folder
    files = file_starts(read_index(spark, records))
    tasks = max(1, min(files.count(), 100_000))
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def as_batch(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    def read(batches):
        store, base = opened(folder)
        for batch in batches:
            for name, start in zip(*(batch.column(c).to_pylist() for c in ("file", "base")), strict=True):
                rows, held = [], 0
                with store.open_input_stream(f"{base}/{name}", buffer_size=1 << 20) as source:
                    for payload in unframe(source, name):
                        doc_id, ids = parse(payload)
                        rows.append((doc_id, start, len(ids), ids.tobytes()))
                        start += len(ids)
                        held += len(payload)
                        if held > 4 << 20:
                            yield as_batch(rows)
                            rows, held = [], 0
                if rows:
                    yield as_batch(rows)

    return files.repartition(tasks).mapInArrow(read, READ)


def op2_token_records(spark: SparkSession, folder: str) -> DataFrame:
    """Write all documents as records and give what the files hold: doc_id, start, n_tokens, ids_crc32."""
    records = write_records(common.table(spark, folder, "documents"), end_id=0)
    return read_records(spark, records).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
