"""Pack documents into sequences of a fixed number of tokens, best fit decreasing.

A document is its ids and an end id. A document over the window is first cut
into full windows and a rest. Rests are taken from the longest down, and each
goes to the open window with the least room that still holds it; a segment tree
over room finds that window in a dozen steps.

Every task packs the rows it reads, in blocks of a bounded number of tokens, so
nothing is shuffled and no key can grow hot. Only the last windows of a block
stay partly empty. Sequence ids are (partition, number in it); a repeated
task gives the same ones. A null text is an empty one (its end id is still packed); rows
with an equal id are packed each for itself; an empty table gives no sequence.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mergewright.llm import common, tokens

WINDOW = 2048
#: Tokens and pieces of a block, the memory bound of a task (4 bytes a token).
BLOCK_TOKENS = 8 << 20
BLOCK_PIECES = 1 << 17
#: Distinct parts that a worker's encoder keeps and bytes it encodes at a time: speed for memory. A stage of a
#: longer run, whose executors hold more, takes the smaller ones.
KEEP, SLICE_BYTES = tokens.KEEP, 4 << 20
STAGE_KEEP, STAGE_SLICE_BYTES = 200_000, 2 << 20
SEQUENCES = ("sequence_id long, filled long, padded long, ids binary, "
             "pieces array<struct<doc_id:long,start:long,length:long,doc_tokens:long,offset:long>>")


class RoomTree:
    """A segment tree over the remaining room 0..size: which rooms have an open window."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.some = bytearray(2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(size + 1)]

    def add(self, room: int, window: int) -> None:
        self.open[room].append(window)
        at = self.leaves + room
        while at and not self.some[at]:
            self.some[at] = 1
            at >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return the (room, window) with the least room of at least ``need``."""
        at, some = self.leaves + need, self.some
        if not some[at]:
            while at > 1 and (at & 1 or not some[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if some[2 * at] else 2 * at + 1
        room = at - self.leaves
        window = self.open[room].pop()
        if not self.open[room]:
            some[at] = 0
            while at > 1 and not some[at ^ 1]:
                at >>= 1
                some[at] = 0
        return room, window


def best_fit(lengths: list[int], window: int) -> list[list[int]]:
    """Windows as lists of piece numbers, pieces taken from the longest down (ties in given order)."""
    tree, windows = RoomTree(window), []
    for piece in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        need = lengths[piece]
        found = tree.take(need)
        if found is None:
            found = (window, len(windows))
            windows.append([])
        room, number = found
        windows[number].append(piece)
        if room > need:
            tree.add(room - need, number)
    return windows


def padded_size(filled: int, window: int) -> int:
    """A sequence is padded to the window, unless what it holds is a power of two."""
    return filled if filled & (filled - 1) == 0 else window


def pack(docs: DataFrame, window: int = WINDOW, end_id: int = 1, path: str | None = None,
         block_tokens: int = BLOCK_TOKENS, block_pieces: int = BLOCK_PIECES, keep: int = KEEP,
         slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """One row per sequence: its ids (uint32, little-endian, without padding) and the pieces in it."""
    text = docs.sparkSession.sparkContext.broadcast(tokens.definition(path))
    piece_type = pa.struct([(n, pa.int64()) for n in ("doc_id", "start", "length", "doc_tokens", "offset")])
    schema = pa.schema([("sequence_id", pa.int64()), ("filled", pa.int64()), ("padded", pa.int64()),
                        ("ids", pa.binary()), ("pieces", pa.list_(piece_type))])
    names = ("doc_id", "start", "length", "doc_tokens")

    def rows_of(groups, first):
        ids, pieces, filled = [], [], []
        for group in groups:
            offset, placed = 0, []
            for piece, _ in group:
                placed.append(dict(zip(names, piece, strict=True)) | {"offset": offset})
                offset += piece[2]
            pieces.append(placed)
            filled.append(offset)
            ids.append(b"".join(part.tobytes() for _, part in group))
        return pa.RecordBatch.from_arrays(
            [pa.array(range(first, first + len(ids)), pa.int64()), pa.array(filled, pa.int64()),
             pa.array([padded_size(f, window) for f in filled], pa.int64()), pa.array(ids, pa.binary()),
             pa.array(pieces, pa.list_(piece_type))], schema=schema)

    def run(batches):
        from pyspark import TaskContext

        encoder = tokens.worker_encoder(text.value, keep)
        number = TaskContext.get().partitionId() << 33
        end = np.array([end_id], np.uint32)
        rests, held = [], 0

        def emit(groups):
            nonlocal number
            for at in range(0, len(groups), 512):
                yield rows_of(groups[at:at + 512], number)
                number += len(groups[at:at + 512])

        def settle():
            nonlocal rests, held
            done = [[rests[i] for i in g] for g in best_fit([p[2] for p, _ in rests], window)]
            rests, held = [], 0
            yield from emit(done)

        for batch in batches:
            for part in common.slices(batch, "text", slice_bytes):
                full = []
                doc_ids = part.column("doc_id").to_pylist()
                for doc_id, ids in zip(doc_ids, encoder.encode(part.column("text")), strict=True):
                    ids = np.concatenate([ids, end])
                    n = len(ids)
                    for start in range(0, n, window):
                        piece = ids[start:start + window].astype("<u4")
                        item = ((doc_id, start, len(piece), n), piece)
                        if len(piece) == window:
                            full.append([item])
                        else:
                            rests.append(item)
                            held += len(piece)
                yield from emit(full)
                if held > block_tokens or len(rests) > block_pieces:
                    yield from settle()
        yield from settle()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       common.text_or_empty("text").alias("text")).mapInArrow(run, SEQUENCES)


def pieces(sequences: DataFrame) -> DataFrame:
    """One row per piece of ``pack``'s sequences, with the checksum of its ids in the sequence."""
    return (sequences.select("sequence_id", "padded", "ids", F.explode("pieces").alias("p"))
            .select("p.doc_id", "p.start", "p.length",
                    F.crc32(F.substring("ids", 4 * F.col("p.offset") + 1, 4 * F.col("p.length"))).alias("ids_crc32"),
                    "p.doc_tokens", "sequence_id", "p.offset", F.col("padded").alias("padded_length")))


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Pack all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, padded_length."""
    return pieces(pack(common.table(spark, folder, "documents")))


def pack_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Last stage of the pipeline: the pieces of all documents that were kept."""
    return pieces(pack(docs, keep=STAGE_KEEP, slice_bytes=STAGE_SLICE_BYTES))
