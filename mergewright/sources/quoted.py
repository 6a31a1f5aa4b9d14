"""Records of quoted CSV files whose cells hold line breaks, found in parallel.

A line break ends a record only outside quotes, and whether a place is inside quotes depends on all quotes before it. Files are read
as plain lines by byte ranges (splits). One pass counts the quotes of each split; sums over the splits of a file, one
number a split, tell which splits begin inside quotes. With that, every task puts its own lines together. Only what is cut by
the end of a split, at most two pieces a split, is put together afterwards. Complete records then go to Spark's own ``from_csv``.

Quotes must stand as RFC 4180 has them: around whole cells, doubled inside. Lines end with a line feed, or with carriage return and line
feed; inside a cell both are kept as a line feed, as the reader of whole files does.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mergewright.sources.staging import stage

QUOTE = '"'
PIECES = "file string, split long, number long, opens boolean, closes boolean, first boolean, text string"


class Cutter:
    """Puts the lines of one split together to pieces of records: (text, whether it opens its record, whether it closes it)."""

    def __init__(self, inside: bool):
        """``inside``: the split begins inside quotes."""
        self.inside, self.opens, self.held = inside, not inside, []

    def feed(self, lines: Iterable[str]) -> Iterator[tuple[str, bool, bool]]:
        for line in lines:
            self.held.append(line)
            self.inside ^= line.count(QUOTE) % 2 == 1
            if not self.inside:
                yield "\n".join(self.held), self.opens, True
                self.opens, self.held = True, []

    def finish(self) -> Iterator[tuple[str, bool, bool]]:
        if self.held:
            yield "\n".join(self.held), self.opens, False


def lines_of(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of the files, each read by byte ranges: file, split (its first byte), text."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.col("value").alias("text"))


def open_splits(lines: DataFrame) -> DataFrame:
    """Splits that begin inside quotes: file, split. One number a split is shuffled."""
    quotes = F.length("text") - F.length(F.replace(F.col("text"), F.lit(QUOTE), F.lit("")))
    counts = lines.groupBy("file", "split").agg(F.sum(quotes).alias("quotes"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("before", F.sum("quotes").over(before)).filter("before % 2 = 1").select("file", "split")


def pieces(lines: DataFrame, begin_inside: DataFrame) -> DataFrame:
    """Records, and pieces of those that a split's end cuts. ``begin_inside`` has a row for some of the splits."""
    # One pair a split at most: the number of splits bounds what is sent.
    known = lines.sparkSession.sparkContext.broadcast({(r["file"], r["split"]) for r in begin_inside.collect()})

    schema = pa.schema([("file", pa.string()), ("split", pa.int64()), ("number", pa.int64()), ("opens", pa.bool_()),
                        ("closes", pa.bool_()), ("first", pa.bool_()), ("text", pa.string())])

    def run(batches):
        key, cutter, number = None, None, 0

        def rows(found):
            nonlocal number
            out = []
            for text, opens, closes in found:
                out.append((*key, number, opens, closes, key[1] == 0 and number == 0, text))
                number += 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)

        for batch in batches:
            if not batch.num_rows:
                continue
            texts, splits = batch.column("text").to_pylist(), batch.column("split").to_numpy()
            coded = batch.column("file").dictionary_encode()
            files = coded.indices.to_numpy()
            change = np.flatnonzero((splits[1:] != splits[:-1]) | (files[1:] != files[:-1])) + 1
            edges = [0, *change.tolist(), len(texts)]
            for a, b in zip(edges, edges[1:]):
                here = (coded.dictionary[int(files[a])].as_py(), int(splits[a]))
                if here != key:
                    if key is not None:
                        yield from rows(cutter.finish())
                    key, cutter, number = here, Cutter(here in known.value), 0
                yield from rows(cutter.feed(texts[a:b]))
        if key is not None:
            yield from rows(cutter.finish())

    return lines.mapInArrow(run, PIECES)


def records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Complete records of the files: file, first (the first of its file, a header), text. Blank records are left out."""
    lines = lines_of(spark, path)
    found = stage(pieces(lines, open_splits(lines)), "csv-pieces")
    whole, cut = found.filter("opens and closes"), found.filter("not (opens and closes)")
    # Pieces of a record follow each other: a new record begins at each opening piece.
    order = Window.partitionBy("file").orderBy("split", "number")
    joined = (cut.withColumn("record", F.count_if("opens").over(order)).groupBy("file", "record")
              .agg(F.max("first").alias("first"), F.sort_array(F.collect_list(F.struct("split", "number", "text"))).alias("parts"))
              .select("file", "first", F.array_join(F.transform("parts", lambda p: p["text"]), "\n").alias("text")))
    text = F.regexp_replace(F.regexp_replace("text", "\r\n", "\n"), "\r$|^\ufeff", "")
    return whole.select("file", "first", "text").unionByName(joined).withColumn("text", text).filter(F.trim("text") != "")


def header_of(found: DataFrame) -> str:
    """The header record, which all files must share."""
    headers = [r["text"] for r in found.filter("first").select("text").distinct().limit(2).collect()]
    if len(headers) != 1:
        raise ValueError("files without a header" if not headers else "files with different headers")
    return headers[0]


def read_quoted(spark: SparkSession, path: str | list[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Every column of quoted CSV files as text; with ``columns`` the header is checked against them."""
    found = records(spark, path)
    header = header_of(found)
    names = next(csv.reader([header]))
    if columns is not None and list(columns) != names:
        raise ValueError(f"header {header!r} is not {', '.join(columns)}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    parsed = F.from_csv(F.col("text"), F.lit(schema_text(schema)), {"escape": QUOTE, "quote": QUOTE, "maxCharsPerColumn": "-1"})
    return found.filter("not first").select(parsed.alias("_r")).select(*[F.col("_r").getField(c).alias(c) for c in names])


def schema_text(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
