import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from mergewright.llm import collocations


def brute(rows, support, top=2000, longest=5):
    words, counts = {}, {}
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = (text or "").translate({i: i + 32 for i in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            own = [w for w in re.split(r"[\x20\x09]", piece) if w]
            words[lang] = words.get(lang, 0) + len(own)
            for k in range(1, longest + 1):
                for i in range(len(own) - k + 1):
                    key = lang, tuple(own[i:i + k])
                    counts[key] = counts.get(key, 0) + 1
    found = {k: f for k, f in counts.items() if f >= support}
    out = {}
    for (lang, phrase), a in found.items():
        if len(phrase) < 2:
            continue
        covered = any(f >= a and lang == x and len(p) > len(phrase)
                      and any(p[i:i + len(phrase)] == phrase for i in range(len(p) - len(phrase) + 1))
                      for (x, p), f in found.items())
        if covered:
            continue
        n = words[lang]
        cuts = []
        for k in range(1, len(phrase)):
            left, right = counts[lang, phrase[:k]], counts[lang, phrase[k:]]
            cuts.append((1000 * a * n // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((score, a, " ".join(phrase), left, right, n))
    rows = []
    for lang, held in out.items():
        held.sort(key=lambda h: (-h[0], -h[1], h[2].encode()))
        rows += [(lang, i, p, a, left, right, n, s) for i, (s, a, p, left, right, n) in enumerate(held[:top], 1)]
    return sorted(rows)


def texts(seed=2, docs=150):
    r = random.Random(seed)
    vocabulary = ["Alpha", "bravo", "été", "delta", "É", "foxtrot", "日本", "hotel"]
    out = []
    for i in range(docs):
        pieces = [" ".join(r.choice(vocabulary) for _ in range(r.randrange(9))) + r.choice(". , ; ! ? \n \r \x0b".split(" ") + [" . "])
                  for _ in range(r.randrange(6))]
        if r.random() < .3:
            pieces.append("New York City Hall\tsquare x")
        out.append((r.choice(["en", "en", "de", None]), "  ".join(pieces)))
    return [*out, (None, None), ("en", ""), ("fr", " \t"), ("en", "no stop " * 300), *out[:20]]


def found(df):
    return sorted(map(tuple, df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


@pytest.mark.parametrize("block_words", [3, 50, 1 << 20])
def test_equals_brute_force_whatever_the_blocks(spark, block_words):
    rows = texts() if block_words > 3 else [(lang, text[:200] if text else text) for lang, text in texts(docs=40)]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3).withColumns(
        {c: F.lit("clash") for c in ("phrase", "words", "f", "doc_id")})
    assert found(collocations.collocations(df, support=6, block_words=block_words)) == brute(rows, 6)


def test_top_and_ties(spark):
    rows = [("en", f"a{i} b{i}.") for i in range(30) for _ in range(5)]
    got = found(collocations.collocations(spark.createDataFrame(rows, "lang string, text string"), support=5, top=7))
    assert got == brute(rows, 5, 7)
    assert [g[2] for g in sorted(got, key=lambda g: g[1])] == sorted(f"a{i} b{i}" for i in range(30))[:7]


def test_empty_table(spark):
    assert collocations.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0


def test_large_products_are_exact(spark):
    phrases = spark.createDataFrame([("x", 1, "a", 3_000_000_007), ("x", 1, "b", 2_999_999_929), ("x", 2, "a b", 2_999_999_000)],
                                    "lang string, words int, phrase string, f long")
    n = 123_456_789_012_345
    row = collocations.scored(phrases, spark.createDataFrame([("x", n)], "lang string, n long")).first()
    assert row.score == 1000 * 2_999_999_000 * n // (3_000_000_007 * 2_999_999_929)


def test_blocks_are_mined_below_the_support(spark):
    """A phrase spread thinly over blocks is in no block at the full support, yet is found."""
    rows = [("en", f"rare pair f{i} g{i}") for i in range(40)]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(8)
    made = collocations.blocks(df, 20).cache()
    most = max(int(c.max()) for r in made.collect() for _, c in collocations.Block(r.asDict()).phrases(2, None))
    assert most < 40
    assert [g[2] for g in found(collocations.collocations(df, support=40, block_words=20))] == ["rare pair"]


def test_words_and_breaks():
    got = collocations.words_of(pa.array(["A b.\tc", None, "", "x y!"])).to_pylist()
    assert got == [["a", "b", "\n", "c", "\n"], ["\n"], ["\n"], ["x y", "\n", "\n"]]


def test_what_leaves_a_task_does_not_grow_with_blocks_or_rare_phrases(spark):
    """Many blocks of phrases that occur once: a table of slots a task, and next to nothing to count."""
    rows = [("en", f"w{i} x{i * 7 % 4001} y{i * 11 % 4001}") for i in range(4000)]
    made = collocations.blocks(spark.createDataFrame(rows, "lang string, text string").repartition(2), 20).cache()
    assert made.count() > 500
    slots = collocations.slots_for(12_000)
    assert collocations.tallied(made, 2, None, slots, 5).count() <= made.rdd.getNumPartitions() * collocations.PIECES
    assert collocations.counted(made, 2, None, collocations.full_slots(made, 2, None, slots, 5)).count() < 40


def test_a_phrase_leaves_a_task_once_whatever_its_blocks(spark):
    docs = spark.createDataFrame(texts(docs=60), "lang string, text string")
    made = collocations.stage(collocations.blocks(docs, 40), "blocks").coalesce(1)
    assert made.count() > 10
    full = collocations.full_slots(made, 2, None, collocations.LEAST_SLOTS, 3)
    whole = collocations.counted(made, 2, None, full)
    assert collocations.counted_in_tasks(made, 2, None, full).count() == whole.count()
    # Phrases that do not fit leave it more often, with the same sums.
    some = collocations.counted_in_tasks(made, 2, None, full, held_rows=8)
    assert some.count() > whole.count()
    assert sorted(some.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).collect()) == sorted(whole.collect())


def test_tables_of_slots_do_not_grow_in_number(spark):
    docs = spark.createDataFrame(texts(docs=60), "lang string, text string").repartition(60)
    cores = spark.sparkContext.defaultParallelism
    tables = collocations.tallied(collocations.staged_blocks(docs, 40), 1, None, collocations.LEAST_SLOTS, 3)
    assert tables.groupBy("piece").count().agg(F.max("count")).first()[0] <= 4 * cores


def test_sums_of_slots_stop_at_the_end(spark):
    rows = [("en", "a b. " * 300), ("en", "c d. " * 254), ("en", "c d")]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    for support in (255, 256, 300):
        assert found(collocations.collocations(df, support=support, block_words=100)) == brute(rows, support)


def test_jobs_do_not_grow_with_partitions(spark):
    """Bitmaps reach the driver by one job, not by one for each partition of a shuffle."""
    df = spark.createDataFrame([("en", "a b c. " * 8)] * 3, "lang string, text string")
    made = collocations.staged_blocks(df, 40)
    keys = spark.range(1000).selectExpr("unhex(md5(string(id))) as key")
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    context = spark.sparkContext
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        context.setJobGroup("bitmaps", "bitmaps")
        collocations.full_slots(made, 2, None, collocations.LEAST_SLOTS, 3)
        collocations.filter_of(keys, 1 << 16)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        for k, v in held.items():
            spark.conf.set(k, v)
    assert 0 < len(context.statusTracker().getJobIdsForGroup("bitmaps")) < 12


def test_tables_of_small_counts_leave_compressed(spark):
    rows = [("en", " ".join(f"w{(i * 7919 + k * k) % 50021}" for k in range(2000))) for i in range(10)]
    made = collocations.staged_blocks(spark.createDataFrame(rows, "lang string, text string").coalesce(1))
    tables = collocations.tallied(made, 2, None, collocations.LEAST_SLOTS, 100)
    sizes = tables.selectExpr("sum(length(counts))").first()[0]
    assert sizes < collocations.LEAST_SLOTS // 2
