"""Quoted files read by byte ranges, the keyed table, counts taken while writing, states by part."""

import os
import random

import pytest
from pyspark.sql import functions as F

from mergewright.operators import profile
from mergewright.plans import labelling
from mergewright.sources import scan_text, write_csv
from mergewright.sources.keyed import KeyedTable
from mergewright.sources.quoted import Cutter, lines_of, open_splits, pieces, read_quoted, records
from mergewright.sources.staging import new_path

NASTY = ["plain", 'with "quotes"', "two\nlines", '"\n"', ",", "", "\n\n", 'a""b', "é\nü", '""', "x" * 30 + "\n" + "y" * 30, '"', "\n"]


def file_of(path, rows, header=("id", "text"), end="\n"):
    def cell(c):
        return '"' + c.replace('"', '""') + '"' if any(x in c for x in '",\n\r') or not c else c
    os.makedirs(path, exist_ok=True)
    name = f"{path}/one.csv"
    with open(name, "w", encoding="utf-8", newline="") as f:
        f.write(end.join(",".join(cell(c) for c in row) for row in [header, *rows]) + end)
    return name


def pieces_of(data: bytes, cuts: list[int]):
    """What the splits that begin at ``cuts`` give, as a reader of lines deals them: a line belongs to the split it begins in."""
    starts, at = [0], data.find(b"\n")
    while at >= 0:
        starts.append(at + 1)
        at = data.find(b"\n", at + 1)
    lines = [(s, data[s:e - 1 if e else None].decode()) for s, e in zip(starts, [*starts[1:], None], strict=True)]
    if lines and not lines[-1][1]:
        lines.pop()
    edges = [0, *cuts, len(data) + 1]
    out, inside = [], False
    for a, b in zip(edges, edges[1:], strict=False):
        # A line that begins exactly where a split does is read by the split before it.
        own = [t for s, t in lines if (a < s <= b) or (a == 0 and s == 0)]
        cutter = Cutter(inside)
        out += [*cutter.feed(own), *cutter.finish()]
        inside ^= sum(t.count('"') for t in own) % 2 == 1
    joined = []
    for text, opens, _ in out:
        if opens:
            joined.append(text)
        else:
            joined[-1] += "\n" + text
    return joined


def test_records_whatever_the_cut():
    data = 'id,text\n1,"a\n""b"",\n"\n2,c\n3,"\n\n"\n4,""""\n'.encode()
    whole = pieces_of(data, [])
    assert whole == ["id,text", '1,"a\n""b"",\n"', "2,c", '3,"\n\n"', '4,""""']
    for cut in range(1, len(data)):
        assert pieces_of(data, [cut]) == whole, cut
        for other in range(cut + 1, len(data), 3):
            assert pieces_of(data, [cut, other]) == whole, (cut, other)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_one_file_is_read_by_many_tasks(spark, tmp_path, end):
    rng = random.Random(1)
    rows = [(str(i), rng.choice(NASTY)) for i in range(200)]
    path = file_of(str(tmp_path / "csv"), rows, end=end)
    settings = {"spark.sql.files.maxPartitionBytes": "97", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "60"}
    kept = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        lines = lines_of(spark, path)
        assert lines.select(F.spark_partition_id()).distinct().count() > 20
        assert open_splits(lines).count() > 5
        cut = pieces(lines, open_splits(lines)).filter("not (opens and closes)")
        assert cut.count() > 5
        got = {r["id"]: r["text"] or "" for r in read_quoted(spark, path, ["id", "text"]).collect()}
    finally:
        for k, v in kept.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert got == {i: t for i, t in rows}


def test_equals_the_reader_of_whole_files(spark, tmp_path):
    rng = random.Random(2)
    df = spark.createDataFrame([(str(i), rng.choice(NASTY), rng.choice([None, "z"])) for i in range(200)], "id string, a string, b string")
    path = write_csv(df.repartition(3), str(tmp_path / "csv"))
    plain = spark.read.schema(df.schema).option("header", True).option("escape", '"').option("multiLine", True).csv(path)
    assert sorted(map(str, read_quoted(spark, path).collect())) == sorted(map(str, plain.collect()))
    assert scan_text(spark, path, ["id", "a", "b"], multiline=True).count() == 200
    with pytest.raises(ValueError, match="header"):
        read_quoted(spark, path, ["id", "b", "a"])
    assert records(spark, path).filter("first").count() == 3


def test_a_stored_table_is_brought_up_to_date_chunk_by_chunk(spark):
    rng = random.Random(3)
    rows = [(f"k{rng.randrange(60)}", i, rng.random()) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, o long, v double")
    kept = KeyedTable(new_path(spark, "keyed"), ("k",), buckets=8)
    assert kept.read(spark, df).count() == 0
    for low in (0, 100, 200):
        kept.upsert(df.filter((F.col("o") >= low) & (F.col("o") < low + 100)), ["o"])
    want = {}
    for k, o, v in rows:
        want[k] = (o, v)
    assert {r["k"]: (r["o"], r["v"]) for r in kept.read(spark, df).collect()} == want
    def files_of():
        return {os.path.join(d, f) for d, _, fs in os.walk(kept.path) for f in fs if f.endswith(".parquet")}

    files = files_of()
    kept.upsert(spark.createDataFrame([("k1", 1000, 0.5)], df.schema), ["o"])
    after = files_of()
    assert len(files) == len(after) == 8 and len(files & after) == 7
    assert kept.read(spark, df).filter("k = 'k1'").first()["o"] == 1000
    kept.upsert(df.limit(0), ["o"])
    assert files_of() == after


def test_a_part_profiled_again_counts_once(spark):
    df = spark.range(100).select((F.col("id") % 10).alias("x"), F.col("id").alias("y"))
    path = new_path(spark, "states")
    for part, rows in (("a", df.filter("y < 40")), ("b", df.filter("y >= 90")), ("b", df.filter("y >= 40")), ("a", df.filter("y < 40"))):
        profile.keep_state(rows, path, part, ["x", "y"])
    got = {r["attribute"]: r for r in profile.merge_profiles(profile.kept_states(spark, path)).collect()}
    assert (got["y"]["count"], got["y"]["min"], got["y"]["max"], got["x"]["unique_count"]) == (100, 0, 99, 10)


def test_counts_come_with_the_writing(spark):
    splits = spark.range(1000).select(
        F.when(F.col("id") % 10 < 7, "train").when(F.col("id") % 10 < 9, "valid").otherwise("test").alias("split"),
        (F.col("id") % 3 == 0).cast("int").alias("label"), F.lit("b1").alias("strategy"),
        F.when(F.col("id") % 4 > 0, F.lit(1.0)).alias("price_A"), F.lit(2.0).alias("price_B"))
    path = new_path(spark, "splits")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("counted", "counted")
    try:
        got = labelling.counted_while_written(splits, path, "overwrite")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(tracker.getJobIdsForGroup("counted")) == 1
    want = {(r["split"], r["label"]): (r["n"], r["bare"]) for r in spark.read.parquet(path).groupBy("split", "label").agg(
        F.count("*").alias("n"), F.count_if(F.col("price_A").isNull()).alias("bare")).collect()}
    assert {(s, k): (n, b) for s, k, n, b in got} == want


def test_large_files_are_not_dealt_out(spark, tmp_path):
    from mergewright.sources import spread
    path = str(tmp_path / "one")
    spark.range(40_000).repartition(1).write.option("parquet.block.size", 16_384).parquet(path)
    assert "Exchange" in spread(spark.read.parquet(path), "id")._jdf.queryExecution().executedPlan().toString()
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        kept = spread(spark.read.parquet(path), "id")
        assert "Exchange" not in kept._jdf.queryExecution().executedPlan().toString() and kept.count() == 40_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
