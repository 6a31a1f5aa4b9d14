"""Byte-level BPE of whole texts by overlapping chunks, and back to bytes.

Long texts are cut into chunks that overlap their successors. Chunks are rows of their own,
dealt over all tasks, and each is pre-tokenised from its own start. A chunk that
starts inside a pre-token soon falls into step with its predecessor: from the
first boundary that both find in the overlap, both find the same ones, since a
match depends only on what follows it. That seam ends one piece and begins the
next. Seams are taken only after a character that is not blank, because a run of
blanks is matched by what comes after it; then each piece may be encoded alone.
A text with a seam that never falls into step (a run longer than the overlap) is
encoded whole. Texts of at most one chunk are pieces of their own and are not shuffled.

Ids of a text are put together in chunk order (bounded by the text, itself one row).
Decoding concatenates the bytes of the ids. A null or empty text has no ids; rows with an
equal doc_id are encoded each for itself.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mergewright.llm import common
from mergewright.sources.staging import stage

CHUNK = 1 << 16
OVERLAP = 1 << 11
CODED = "row long, doc_id long, n_tokens long, ids binary, bytes binary"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def read_ranks(path: str | None = None) -> tuple[bytes, str]:
    """The rank file (a bounded 0.8 MB, sent to tasks) and the pre-token pattern."""
    import public_tokenizers

    with open(path or default_path(), "rb") as file:
        return file.read(), public_tokenizers.PATTERN


class Coder:
    """Encodes and decodes pieces by ranks."""

    def __init__(self, ranks: bytes, pattern: str):
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.bytes_of = [b""] * (max(table.values(), default=-1) + 1)
        for token, rank in table.items():
            self.bytes_of[rank] = token

    def encode(self, piece: str) -> bytes:
        # A lone surrogate cannot come out of Spark's strings, so every piece has UTF-8 bytes.
        return np.array(self.encoding.encode_ordinary(piece), "<u4").tobytes()

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def worker_coder(ranks: bytes, pattern: str) -> Coder:
    """The worker's coder for a rank file."""
    return common.worker_cache(f"coder-{zlib.crc32(ranks)}", lambda: Coder(ranks, pattern))


def boundaries(pattern: regex.Pattern, text: str, start: int, stop: int, from_: int = 0) -> list[int]:
    """Starts of pre-tokens in [start, stop) after a character that is not blank, matching from ``from_`` on."""
    found = []
    for match in pattern.finditer(text, from_):
        at = match.start()
        if at >= stop:
            break
        if at >= start and at and not text[at - 1].isspace():
            found.append(at)
    return found


def cut(text: str, chunk: int, overlap: int) -> list[tuple[int, str]]:
    """Chunks as (start, text): each reaches ``overlap`` into the next."""
    return [(at, text[at:at + chunk + overlap]) for at in range(0, max(len(text), 1), chunk)]


def ends_of(pattern: regex.Pattern, text: str, first: bool, last: bool, chunk: int,
            overlap: int) -> tuple[list[int], list[int]]:
    """Boundaries near a chunk's start (seen from inside) and in its overlap, both relative to its start.

    The last match of a chunk may be cut off by its end; boundaries up to its start are sound.
    """
    head = [] if first else boundaries(pattern, text, 0, overlap)
    if last:
        return head, []
    found = [m.start() for m in pattern.finditer(text)]
    tail = [at for at in found[:-1] if at >= chunk and not text[at - 1].isspace()]
    return head, [at - chunk for at in tail]


def as_binary(rows: Iterable[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def encode(docs: DataFrame, path: str | None = None, chunk: int = CHUNK, overlap: int = OVERLAP,
           decoded: bool = False) -> DataFrame:
    """row, doc_id, n_tokens, ids (uint32 little-endian) of each row of ``docs`` (doc_id, text).

    With ``decoded`` also ``bytes``, decoded from the ids in the same pass: a second Python step
    would keep a second worker, with tables of its own, beside each task.
    """
    context = docs.sparkSession.sparkContext
    ranks, pattern_text = read_ranks(path)
    held = context.broadcast(ranks)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       common.text_or_empty("text").alias("text"))
    coded = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()),
                       ("bytes", pa.binary())])
    chunks = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("number", pa.int64()), ("last", pa.bool_()),
                        ("text", pa.string())])
    seams = pa.schema([*chunks, ("head", pa.list_(pa.int64())), ("tail", pa.list_(pa.int64()))])

    def coder() -> Coder:
        return worker_coder(held.value, pattern_text)

    def short(batches):
        code = coder()
        for batch in batches:
            for part in common.slices(batch, "text"):
                ids = [code.encode(t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), part.column("doc_id"), pa.array([len(i) // 4 for i in ids], pa.int64()),
                     pa.array(ids, pa.binary()),
                     pa.array([code.decode(i) if decoded else None for i in ids], pa.binary())], schema=coded)

    def explode(batches):
        for batch in batches:
            for row, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                parts = cut(text, chunk, overlap)
                for number, (_, part) in enumerate(parts):
                    yield as_binary([(row, doc_id, number, number == len(parts) - 1, part)], chunks)

    def pre_tokenise(batches):
        pattern = regex.compile(pattern_text)
        for batch in batches:
            for item in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                _, _, number, last, text = item
                yield as_binary([(*item, *ends_of(pattern, text, number == 0, last, chunk, overlap))], seams)

    few = rows.filter(F.length("text") <= chunk).mapInArrow(short, CODED)
    many = stage(rows.filter(F.length("text") > chunk).mapInArrow(
        explode, "row long, doc_id long, number long, last boolean, text string")
        .repartition("row", "number")
        .mapInArrow(pre_tokenise, "row long, doc_id long, number long, last boolean, text string, "
                                  "head array<long>, tail array<long>"), "chunks")
    by_row = Window.partitionBy("row").orderBy("number")
    # Where this piece begins in its chunk, where it ends, and what is not in step.
    links = (many.select("row", "number", "last", "head", "tail")
             .withColumn("begin", F.when(F.col("number") == 0, F.lit(0)).otherwise(
                 F.array_min(F.array_intersect("head", F.lag("tail").over(by_row)))))
             .withColumn("end", F.when(F.col("last"), F.lit(-1)).otherwise(F.lead("begin").over(by_row) + chunk))
             .select("row", "number", "begin", "end"))
    broken = links.groupBy("row").agg(F.max((F.col("begin").isNull() | F.col("end").isNull()).cast("int")).alias("broken"))
    pieces = (many.join(links, ["row", "number"]).join(broken, "row")
              .select("row", "doc_id", "number", "last", "broken",
                      F.coalesce(F.when(F.col("broken") == 1, 0).otherwise(F.col("begin")), F.lit(0)).alias("begin"),
                      F.when(F.col("broken") == 1, F.when(F.col("last"), -1).otherwise(chunk))
                      .otherwise(F.col("end")).alias("end"), "text"))
    encoded = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("number", pa.int64()), ("broken", pa.int32()),
                         ("part", pa.binary())])

    def encode_pieces(batches):
        code = coder()
        for batch in batches:
            for row, doc_id, number, _, broken, begin, end, text in zip(
                    *(c.to_pylist() for c in batch.columns), strict=True):
                piece = text[begin:] if end < 0 else text[begin:end]
                yield as_binary([(row, doc_id, number, broken,
                                  piece.encode() if broken else code.encode(piece))], encoded)

    def whole(batches):
        code = coder()
        for batch in batches:
            for row, doc_id, broken, parts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                joined = b"".join(p["part"] for p in parts)
                ids = code.encode(joined.decode()) if broken else joined
                yield as_binary([(row, doc_id, len(ids) // 4, ids, code.decode(ids) if decoded else None)], coded)

    long_rows = (pieces.mapInArrow(encode_pieces, "row long, doc_id long, number long, broken int, part binary")
                 .groupBy("row", "doc_id", "broken")
                 .agg(F.array_sort(F.collect_list(F.struct("number", "part"))).alias("parts"))
                 .mapInArrow(whole, CODED))
    out = few.unionByName(long_rows)
    return out if decoded else out.drop("bytes")


def decode(coded: DataFrame, path: str | None = None) -> DataFrame:
    """``coded`` with a column ``bytes``: the concatenated bytes of its ``ids``."""
    ranks, pattern_text = read_ranks(path)
    held = coded.sparkSession.sparkContext.broadcast(ranks)

    @F.arrow_udf("binary")
    def back(ids: pa.Array) -> pa.Array:
        code = worker_coder(held.value, pattern_text)
        return pa.array([code.decode(i) for i in ids.to_pylist()], pa.binary())

    return coded.withColumn("bytes", back("ids"))


def op8_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Encode and decode all documents: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    coded = encode(common.table(spark, folder, "documents"), decoded=True)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("bytes", 256).alias("decoded_sha256"))
