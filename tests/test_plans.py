"""Whole runs and the shape of their plans."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from mergewright.operators import blocking, candidates, compare, models, pairs
from mergewright.plans import classification, labelling, linkage
from mergewright.schema import MEDIATED
from mergewright.sources import staging
from mergewright.sources.staging import new_path
from tests.test_operators import linker_records, make_sources, md5, source


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def cars(spark, rng, n=240):
    """Two sources of the same cars, with small differences."""
    a, b = [], []
    for i in range(n):
        car = {"make": f"make {i % 4}", "model": f"model {i % 9}", "year": 2000 + i % 7,
               "price": 1000.0 + 37 * i, "mileage": 500.0 * i, "state": "TX", "vin": f"P{i:016d}"}
        a.append({**car, "id": f"a{i:04d}"})
        b.append({**car, "id": f"b{i:04d}", "make": car["make"].upper(),
                  "price": car["price"] + rng.choice([0, 0, 25]), "model": car["model"] + rng.choice(["", "!"])})
    return tuple(spark.createDataFrame(source(r), MEDIATED) for r in (a, b))


@pytest.fixture(scope="module")
def splits(spark):
    a, b = cars(spark, random.Random(1))
    path = new_path(spark, "splits")
    labelling.prepare_splits(a, b, path)
    return spark.read.parquet(path)


def test_splits_on_disk(spark, splits):
    sizes = Counter((r["strategy"], r["split"]) for r in splits.select("strategy", "split").collect())
    assert set(sizes) == {(s, p) for s in ("b1", "b2") for p in ("train", "valid", "test")}
    assert not [c for c in splits.columns if "vin" in c.lower()]
    one = splits.filter((F.col("strategy") == "b1") & (F.col("split") == "test")).select("id_A")
    scan = plan_of(one)
    assert re.search(r"PartitionFilters: \[[^\]]*strategy", scan) and "ReadSchema: struct<id_A:string>" in scan


def test_pairs_are_written_once_by_split(spark, monkeypatch):
    """Rows are chosen by VIN once for all strategies; besides the splits only ids and labels of pairs are written."""
    a, b = cars(spark, random.Random(3), 60)
    written, plain = [], labelling.stage
    monkeypatch.setattr(labelling, "stage", lambda df, name: written.append((name, df.columns)) or plain(df, name))
    path = new_path(spark, "splits")
    labelling.prepare_splits(a, b, path)
    assert [name for name, _ in written] == ["side", "side", "keys-b1", "keys-b2"]
    assert all(columns == ["id_A", "id_B", "label"] for name, columns in written if name.startswith("keys"))
    for strategy in (blocking.B1, blocking.B2):
        # As when the pairs themselves are written and split.
        whole = labelling.split_stratified(staging.stage(pairs.label_pairs(a, b, strategy), "whole"))
        got = spark.read.parquet(path).filter(F.col("strategy") == strategy.name).select(whole.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, whole.collect()))


def test_capped_splits_on_text_ids(spark):
    a, b = cars(spark, random.Random(1))
    path = new_path(spark, "splits")
    labelling.prepare_splits(a, b, path, strategies=(blocking.B1,), cap=20)
    rows = spark.read.parquet(path).collect()
    assert Counter(r["label"] for r in rows) == {0: 20, 1: 20}
    assert {r["id_A"] for r in rows if r["label"] == 1} == {f"a{i:04d}" for i in range(20)}


def parts(splits, strategy="b1"):
    mine = splits.filter(F.col("strategy") == strategy)
    return mine.filter(F.col("split") == "train"), mine.filter(F.col("split") == "test")


def test_classifier_finds_the_matches(splits):
    train, test = parts(splits)
    result = classification.classify(train, test)
    row = result.metrics.first()
    assert row["recall"] > 0.9 and row["precision"] > 0.9
    assert sum(r["n"] for r in result.confusion.collect()) == test.count()


def test_linker_finds_the_matches(spark, splits):
    train, test = parts(splits)
    model, examples = new_path(spark, "model"), new_path(spark, "examples")
    result = linkage.train_and_link(train, test, model, examples)
    links = [(r["id_A"], r["id_B"]) for r in result.links.collect()]
    assert len({a for a, _ in links}) == len({b for _, b in links}) == len(links)
    assert result.metrics.first()["recall"] > 0.8 and result.blocking.uncovered == 0
    assert spark.read.json(examples).filter("label = 1").count() == pairs.true_links(train).count()
    # Only what was saved is needed to link again.
    saved = linkage.link_saved(pairs.records_for_linker(test), model)
    assert sorted(map(tuple, saved.collect())) == sorted(map(tuple, result.links.collect()))
    assert linkage.load_linker(spark, model)[1] == result.blocking
    again = linkage.train_and_link(train.limit(0), test, model)
    assert sorted(map(tuple, again.links.collect())) == sorted(map(tuple, result.links.collect()))


def test_copies_are_linked_like_single_records(spark):
    """Greedy over all record pairs, in the order of their profiles, by brute force."""
    rng = random.Random(2)
    records = linker_records(spark, rng, 60)
    profiled = candidates.with_profile(records).cache()
    rows = profiled.collect()
    score = {}
    for x in rows:
        for y in rows:
            if x["source"] == "A" and y["source"] == "B" and x["model"] == y["model"]:
                key = (x["profile"], y["profile"])
                score[key] = round(1 - abs(x["price"] - y["price"]) / 10000 - (x["year"] != y["year"]) / 10, 3)
    copies = Counter((r["source"], r["profile"]) for r in rows)
    table = spark.createDataFrame(
        [(a, b, s, copies["A", a], copies["B", b]) for (a, b), s in score.items()],
        "id_A string, id_B string, score double, copies_A long, copies_B long")
    from mergewright.operators.assign import assign
    got = [(r["id_A"], r["id_B"]) for r in linkage.expand_copies(assign(table), profiled).collect()]
    assert len({a for a, _ in got}) == len({b for _, b in got}) == len(got)

    left, expected = dict(copies), Counter()
    for a, b in sorted(score, key=lambda k: (score[k], md5(*k)), reverse=True):
        n = min(left["A", a], left["B", b])
        left["A", a] -= n
        left["B", b] -= n
        if n:
            expected[a, b] = n
    of = {(r["source"], r["id"]): r["profile"] for r in rows}
    assert Counter((of["A", a], of["B", b]) for a, b in got) == expected


def test_links_of_one_profile_with_many_runs(spark):
    """2,000 copies taken in 200 runs: as many numbers as links, whatever the chunk."""
    runs = [("p", f"q{i}", 0.9, 2000, 10, 10 * i, 0, 10) for i in range(200)]
    assigned = spark.createDataFrame(runs, "id_A string, id_B string, score double, copies_A long, copies_B long, "
                                           "from_A long, from_B long, take long")
    for chunk in (3, 10_000):
        numbers = linkage.link_numbers(assigned, chunk).collect()
        assert len(numbers) == 2000 and {r["number_A"] for r in numbers} == set(range(1, 2001))
    rows = [("A", "p", f"a{i}") for i in range(2000)] + [("B", f"q{i // 10}", f"b{i}") for i in range(2000)]
    records = spark.createDataFrame(rows + [("A", "unused", "z")], "source string, profile string, id string")
    got = linkage.expand_copies(assigned, records).collect()
    assert len(got) == len({r["id_A"] for r in got}) == len({r["id_B"] for r in got}) == 2000


def test_assignment_plans_without_sort_aggregates(spark):
    from mergewright.operators.assign import mutual_best, with_tie
    table = spark.createDataFrame([("a", "b", 0.5)], "id_A string, id_B string, score double")
    plan = plan_of(mutual_best(with_tie(table)))
    assert "SortAggregate" not in plan and "WindowGroupLimit" in plan


def test_plans_have_no_cross_join_and_one_python_step(spark):
    a, b = (spark.createDataFrame(source(r), MEDIATED) for r in make_sources(random.Random(3)))
    for strategy in (blocking.B1, blocking.B2):
        table = pairs.label_pairs(a, b, strategy)
        plan = plan_of(table)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
        assert "WindowGroupLimit" in plan
    features = compare.pair_features(pairs.label_pairs(a, b, blocking.B1), "label")
    scored = models.predict(features, {f: 1.0 for f in compare.FEATURES}, -2.0)
    # One Python step on either side of the union of matches and non-matches.
    assert plan_of(scored).split("== Initial Plan ==")[0].count("ArrowEvalPython") <= 2
    linker = compare.linker_features(spark.createDataFrame(source([{"id": "x"}]), MEDIATED).select(
        *[F.col(c).alias(f"{c}_{s}") for c in candidates.COMPARED for s in ("A", "B")]))
    assert plan_of(linker).count("ArrowEvalPython") == 1
    rules = [candidates.Rule(("model_whole",)), candidates.Rule(("price_log", "year_whole"))]
    plan = plan_of(candidates.candidate_pairs(linker_records(spark, random.Random(4)), rules))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_tests_of_pairs_are_not_part_of_the_join(spark):
    # As conditions of the join, the formula of agreeing keys stood there once for each rule, more code than the JVM compiles.
    records = candidates.profiles(candidates.with_profile(linker_records(spark, random.Random(4))))
    rules = tuple(candidates.rules_of(2)[:30])
    model = models.Matcher(tuple(compare.LINKER_FEATURES), (-1.0,) * len(compare.LINKER_FEATURES), 4.0)
    for table in (candidates.candidate_pairs(records, rules, *candidates.COMPARED), linkage.scored_candidates(records, model, rules)):
        joins = [line for line in plan_of(table).splitlines() if "Join" in line]
        assert joins and not any("CASE" in line or "least(" in line or "Broadcast" in line for line in joins)


def test_a_score_bound_drops_no_link(spark):
    """Pairs out of reach are told from numbers and lengths; no pair at the threshold is among them."""
    rng = random.Random(6)
    texts = ["red bolt", "red bolts", "a", "abcdefghij", "cold widget x", "cold widgets", None]
    rows = [(str(i), *[rng.choice(texts) for _ in range(4)], *[rng.choice([None, 5.0, 70.0, 8000.0]) for _ in range(4)],
             *[rng.choice(["2000", "2001", "99", None]) for _ in range(2)], *[rng.choice(["tx", "ca", None]) for _ in range(2)]) for i in range(400)]
    table = spark.createDataFrame(rows, "id_A string, model_A string, model_B string, make_A string, make_B string, price_A double, "
                                  "price_B double, mileage_A double, mileage_B double, year_A string, year_B string, state_A string, state_B string")
    signs = [(-1.0, -2.0, -3.0, -1.0, -2.0, 0.5, -1.0, 0.2, -0.5, -0.1), (1.5, -0.7, 0.9, -2.0, 1.0, -0.4, 0.3, -0.6, 0.2, 0.8)]
    for numbers in signs:
        model = models.Matcher(tuple(compare.LINKER_FEATURES), numbers, 4.0)
        bound = compare.linker_logit_bound(*models.weights(model))
        features = compare.linker_features(table.withColumn("bound", bound).withColumn("can", linkage.can_reach(model)), "id_A", "bound", "can")
        scored = models.predict(features, *models.weights(model)).withColumn("z", F.log(F.col("score") / (1 - F.col("score"))))
        assert scored.filter("z > bound + 1e-6").count() == 0
        assert scored.filter("prediction = 1 and not can").count() == 0
        assert 0 < scored.filter("not can").count() < 400


def test_the_bound_of_a_pair_is_little_code(spark):
    # A method of more than 8,000 bytes is interpreted, which took three times as long as the join itself.
    model = models.Matcher(tuple(compare.LINKER_FEATURES), (-1.0,) * len(compare.LINKER_FEATURES), 4.0)
    assert str(linkage.can_reach(model)).count("length(") <= 80


def test_pairs_of_blocks_are_formed_by_a_fixed_number_of_tasks(spark):
    # Few bytes make many pairs: left to bytes, adaptive execution gives them all to one task or two.
    many = spark.range(4000).selectExpr("concat('a', id) as id_A", "cast(id % 97 as string) as block_make", "if(id % 5 = 0, null, id % 5) as block_year")
    few = spark.range(97 * 5).selectExpr("concat('b', id) as id_B", "cast(id % 97 as string) as block_make", "if(id div 97 = 0, null, id div 97) as block_year")
    met = blocking.join_blocks(many, few, ["block_make", "block_year"], "id_A")
    held = met.withColumn("part", F.spark_partition_id()).groupBy("part").agg(F.count("*").alias("n")).collect()
    assert sum(r["n"] for r in held) == 4000
    assert len(held) > spark.sparkContext.defaultParallelism


def test_pairs_are_formed_once_for_both_sides(spark):
    rows = spark.range(10).selectExpr("concat('a', id) as id_A", "concat('b', id) as id_B", "id as price_A", "id as price_B")
    assert "Union" not in plan_of(pairs.records_from_pairs(rows))


def test_texts_of_a_pair_are_normalised_once(spark):
    columns = [f"{c}_{s} {k}" for c, k in (("id", "string"), ("model", "string"), ("make", "string"), ("year", "int"),
                                           ("mileage", "double"), ("state", "string")) for s in ("A", "B")]
    features = compare.pair_features(spark.createDataFrame([], ", ".join(columns)))
    # Four texts, each by at most four replacements.
    assert plan_of(features).count("regexp_replace") <= 16


def test_written_tables_are_packed_well(spark):
    written = staging.stage(spark.range(10).selectExpr("'some text' as t"), "packed")
    assert all(".zstd." in f for f in written.inputFiles())
