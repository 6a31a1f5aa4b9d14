"""Operators against brute force in plain Python on small tables."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from mergewright.operators import (
    assign,
    blocking,
    candidates,
    components,
    dedup,
    mediate,
    metrics,
    models,
    pairs,
    profile,
    quantiles,
    ranking,
    sampling,
    split,
)
from mergewright.schema import MEDIATED, SOURCE_A, SOURCE_B
from mergewright.sources import require_columns, scan_text, scan_typed, shared_folder, write_csv


def md5(*parts, seed=0):
    return hashlib.md5("|".join([*map(str, parts), str(seed)]).encode()).hexdigest()


def test_require_columns(spark):
    df = spark.range(1)
    assert require_columns(df, ["id"]) is df
    with pytest.raises(ValueError, match="x, y"):
        require_columns(df, ["id", "x", "y"])


def test_csv_keeps_difficult_text(spark, tmp_path):
    rows = [("1", ' two "quoted", words '), ("2", "line\nbreak"), ("3", None), ("4", "na"), ("5", "NA")]
    df = spark.createDataFrame(rows, "id string, t string")
    path = write_csv(df, str(tmp_path / "t"))
    got = {r["id"]: r["t"] for r in scan_text(spark, path, multiline=True).collect()}
    assert got == {"1": ' two "quoted", words ', "2": "line\nbreak", "3": None, "4": None, "5": None}
    typed = scan_typed(spark, path, multiline=True)
    assert dict(typed.dtypes)["id"] == "int"
    assert {r["id"]: r["t"] for r in typed.collect()}[4] == "na"


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_mediate(spark):
    raw = spark.createDataFrame(
        [("7", "Ford", "x1", "2015.0", "abc", "5d")],
        "listing_id string, franchise_make string, vin string, year string, price string, mileage string")
    got = mediate.mediate(raw, SOURCE_A)
    assert got.columns == MEDIATED.names and got.schema["year"].dataType == MEDIATED["year"].dataType
    row = got.first()
    assert (row["id"], row["make"], row["year"], row["price"], row["state"]) == ("7", "Ford", 2015, None, None)
    assert mediate.mediate(raw, SOURCE_B).first()["engine_displacement"] is None
    assert mediate.drop_leakage(raw.withColumn("VIN_A", F.lit(1))).columns == [
        "listing_id", "franchise_make", "year", "price", "mileage"]


def test_one_per_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("b", 2, "z"), ("a", 2, "w")],
                               "k string, o int, v string")
    first = {r["k"]: r["v"] for r in dedup.one_per_key(df, ["k"], ["o"]).collect()}
    last = {r["k"]: r["v"] for r in dedup.one_per_key(df, ["k"], ["o"], "last").collect()}
    assert first == {"a": "x", "b": "z"} and last == {"a": "y", "b": "z"}
    with pytest.raises(ValueError):
        dedup.one_per_key(df, ["k"], ["o"], "any")


def test_rank_by_digest(spark):
    rng = random.Random(1)
    rows = [("hot" if rng.random() < 0.5 else f"g{rng.randrange(20)}", i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, id long").withColumn("d", ranking.digest("id"))
    expected, by_group = {}, defaultdict(list)
    for g, i in rows:
        by_group[g].append((md5(i), i))
    for members in by_group.values():
        expected.update({i: n + 1 for n, (_, i) in enumerate(sorted(members))})
    got = ranking.rank_by_digest(df, ["g"], "d", "r", ["id"]).collect()
    assert {r["id"]: r["r"] for r in got} == expected
    whole = ranking.rank_by_digest(df, [], "d", "r", ["id"]).collect()
    order = sorted((md5(i), i) for _, i in rows)
    assert {r["id"]: r["r"] for r in whole} == {i: n + 1 for n, (_, i) in enumerate(order)}


@pytest.mark.parametrize("n", [5, 700, 5000])
def test_first_rows(spark, n):
    rng = random.Random(2)
    rows = [(rng.choice([0, rng.randrange(10 ** 6)]), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "o long, id long").repartition(7)
    got = ranking.first_rows(df, ["o", "id"], n).collect()
    assert sorted((r["o"], r["id"]) for r in got) == sorted(rows)[:n]


def source(rows):
    names = MEDIATED.names
    return [tuple(r.get(c) for c in names) for r in rows]


def make_sources(rng, hot=False):
    makes, models_ = ["Ford", "FORD!", "Fiat", None, "--"], ["F-150", "f 150", "Panda", None]
    def records(prefix, n):
        return [{
            "id": f"{prefix}{i:04d}", "make": "Ford" if hot and i % 3 else rng.choice(makes),
            "model": "F-150" if hot and i % 3 else rng.choice(models_),
            "year": rng.choice([2000, 2001, None]), "price": float(rng.randrange(1, 9)),
            "mileage": rng.choice([None, float(rng.randrange(30000))]), "state": rng.choice(["TX", None]),
            "vin": rng.choice(["bad", None] + [f"P{rng.randrange(60):016d}"] * 8)} for i in range(n)]
    return records("a", 150), records("b", 90)


def brute_block(text):
    import re
    if text is None:
        return "nan"
    out = re.sub("[^a-z0-9]+", " ", text.lower()).strip()
    return out or "None"


def brute_pairs(a, b, keys, k=5):
    def valid(rows, keep):
        seen = {}
        for r in sorted(rows, key=lambda r: r["id"]):
            if r["vin"] and len(r["vin"]) == 17 and (keep == "last" or r["vin"] not in seen):
                seen[r["vin"]] = r
        return list(seen.values())
    def key(r):
        full = {"make": brute_block(r["make"]), "model": brute_block(r["model"]), "year": r["year"],
                "mileage_bin": None if r["mileage"] is None else math.floor(r["mileage"] / 10000)}
        return tuple(full[c] for c in keys)
    left, right = valid(a, "first"), valid(b, "last")
    by_vin, by_key = {r["vin"]: r for r in right}, defaultdict(list)
    for r in sorted(right, key=lambda r: r["id"]):
        by_key[key(r)].append(r)
    out = {(r["id"], by_vin[r["vin"]]["id"], 1) for r in left if r["vin"] in by_vin}
    return out | {(r["id"], s["id"], 0) for r in left for s in by_key[key(r)][:k] if s["vin"] != r["vin"]}


@pytest.mark.parametrize("strategy", [blocking.B1, blocking.B2])
@pytest.mark.parametrize("hot", [False, True])
def test_label_pairs(spark, strategy, hot):
    a, b = make_sources(random.Random(3), hot)
    df_a, df_b = (spark.createDataFrame(source(r), MEDIATED) for r in (a, b))
    # A small limit, so that blocks are dealt into parts by their own counts.
    got = pairs.label_pairs(df_a, df_b, strategy, rows_per_task=4)
    assert got.columns == [*pairs.pair_columns(strategy), "label"]
    rows = [(r["id_A"], r["id_B"], r["label"]) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == brute_pairs(a, b, strategy.keys)


def test_label_pairs_do_not_depend_on_partitions(spark):
    a, b = make_sources(random.Random(4))
    df_a, df_b = (spark.createDataFrame(source(r), MEDIATED) for r in (a, b))
    results = [sorted(map(tuple, pairs.label_pairs(
        df_a.repartition(n), df_b.repartition(n), blocking.B1).select("id_A", "id_B", "label").collect()))
        for n in (1, 16)]
    assert results[0] == results[1]


def test_capped_pairs(spark):
    a, b = make_sources(random.Random(5))
    df_a, df_b = (spark.createDataFrame(source(r), MEDIATED).withColumn(
        "pos", F.substring("id", 2, 4).cast("long")) for r in (a, b))
    got = pairs.label_pairs(df_a, df_b, blocking.B1, ("pos", "id"), ("pos", "id"), cap=12)
    whole = brute_pairs(a, b, blocking.B1.keys)
    rows = {(r["id_A"], r["id_B"], r["label"]) for r in got.collect()}
    assert rows <= whole and Counter(r[2] for r in rows) == {0: 12, 1: 12}
    for label in (0, 1):
        last = max(r[0] for r in rows if r[2] == label)
        assert {r for r in whole if r[2] == label and r[0] < last} <= rows


def pair_table(spark, n=400, share=0.2):
    rows = [(f"a{i}", f"b{i % 37}", int(i < n * share), f"v{i}") for i in range(n)]
    return spark.createDataFrame(rows, "id_A string, id_B string, label int, vin_A string")


def test_split_is_exact_complete_and_safe(spark):
    got = split.split_stratified(pair_table(spark))
    assert not [c for c in got.columns if "vin" in c.lower()]
    rows = got.collect()
    assert len(rows) == 400 and len({(r["id_A"], r["id_B"]) for r in rows}) == 400
    sizes = Counter((r["label"], r["split"]) for r in rows)
    assert sizes == {(1, "train"): 56, (1, "valid"): 12, (1, "test"): 12,
                     (0, "train"): 224, (0, "valid"): 48, (0, "test"): 48}
    first = sorted((md5(r["id_A"], r["id_B"], seed=42), r["split"]) for r in rows if r["label"] == 1)
    assert [s for _, s in first] == ["train"] * 56 + ["valid"] * 12 + ["test"] * 12


def test_split_of_few_rows_and_unknown_label(spark):
    tiny = spark.createDataFrame([("a", "b", 1), ("c", "d", 0)], "id_A string, id_B string, label int")
    assert {r["split"] for r in split.split_stratified(tiny).collect()} == {"test"}
    with pytest.raises(Exception, match="not one of the classes"):
        split.split_stratified(tiny.withColumn("label", F.lit(7))).collect()


def test_grouped_split_keeps_groups_together(spark):
    rows = split.split_stratified(pair_table(spark), group_by=["id_B"]).collect()
    seen = defaultdict(set)
    for r in rows:
        seen[r["id_B"]].add(r["split"])
    assert len(rows) == 400 and all(len(s) == 1 for s in seen.values())


def test_records_from_pairs(spark):
    df = spark.createDataFrame(
        [("1", "1", "x", "p"), ("1", "2", "y", "q"), ("3", "1", "z", "r")],
        "id_A string, id_B string, t_A string, t_B string")
    first = {(r["source"], r["id"]): r["t"] for r in pairs.records_from_pairs(df).collect()}
    last = {(r["source"], r["id"]): r["t"] for r in pairs.records_from_pairs(df, keep="last").collect()}
    assert first == {("A", "1"): "x", ("A", "3"): "z", ("B", "1"): "p", ("B", "2"): "q"}
    assert last == {("A", "1"): "y", ("A", "3"): "z", ("B", "1"): "r", ("B", "2"): "q"}


def test_sample_ids(spark):
    ids = spark.range(500).select(F.col("id").cast("string").alias("id"))
    matched = ids.filter(F.col("id").cast("int") < 40)
    got = [(r["id"], r["matched"]) for r in sampling.sample_ids(ids, matched, 100).collect()]
    assert len(got) == len(set(got)) == 100 and sum(m for _, m in got) == 40
    others = sorted((md5(i, seed=42), str(i)) for i in range(40, 500))[:60]
    assert {i for i, m in got if not m} == {i for _, i in others}
    assert sampling.sample_ids(ids, matched, 10).count() == 40


def test_sample_negatives(spark):
    a = spark.createDataFrame([(f"a{i}",) for i in range(30)], "id string")
    b = spark.createDataFrame([(f"b{i}",) for i in range(20)], "id string")
    known = spark.createDataFrame([(f"a{i}", f"b{i}") for i in range(20)], "id_A string, id_B string")
    rows = sampling.sample_negatives(a, b, known).collect()
    assert len(rows) == 40 and not {(r["id_A"], r["id_B"]) for r in rows} & {(f"a{i}", f"b{i}") for i in range(20)}
    again = sampling.sample_negatives(a.repartition(5), b, known).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    assert sampling.sample_negatives(a, b, known, most=7).count() == 7


def test_profile(spark):
    rows = [("x", 1.0, None), ("x", 2.0, None), (None, 4.0, None), ("y" * 100, None, None)]
    df = spark.createDataFrame(rows, "t string, n double, e string")
    summary = {r["attribute"]: (r["missing_count"], r["unique_count"])
               for r in profile.profile_summary(df).collect()}
    assert summary == {"t": (1, 2), "n": (1, 3), "e": (4, 0)}
    stats = {r["attribute"]: r for r in profile.numeric_stats(df, ["n", "absent"]).collect()}
    assert stats["n"]["count"] == 3 and stats["n"]["std"] == pytest.approx(1.5275, abs=1e-4)
    assert (stats["absent"]["count"], stats["absent"]["mean"], stats["absent"]["min"]) == (0, 0.0, None)
    constant = {r["attribute"]: r["constant"] for r in profile.constant_columns(df, df.columns).collect()}
    assert constant == {"t": False, "n": False, "e": True}


def test_sketch_error_and_merge(spark):
    df = spark.range(60_000).select((F.col("id") % 15_000).alias("v"), (F.col("id") % 7).alias("part"))
    near = profile.approx_distinct_counts(df.select("v")).first()["unique_count"]
    assert abs(near - 15_000) <= 0.05 * 15_000
    merged = profile.merge_profiles(profile.partial_profile(df, ["part"], ["v"])).first()
    whole = profile.numeric_stats(df, ["v"]).first()
    assert merged["unique_count"] == near
    for c in ("count", "mean", "std", "min", "max"):
        assert merged[c] == pytest.approx(whole[c])


@pytest.mark.parametrize("gather", [3, 100_000])
def test_exact_quantiles(spark, gather):
    import numpy as np
    rng = random.Random(6)
    a = [float(rng.choice([5, 5, 5, rng.randrange(1000)])) for _ in range(3000)]
    b = [rng.random() for _ in range(2999)] + [None]
    df = spark.createDataFrame([*zip(a, b)], "a double, b double").withColumn("c", F.lit(None).cast("double"))
    probabilities = [0.0, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = quantiles.exact_quantiles(df, ["a", "b", "c"], probabilities, gather=gather, accuracy=20)
    assert got["a"] == pytest.approx(np.quantile(a, probabilities))
    assert got["b"] == pytest.approx(np.quantile([x for x in b if x is not None], probabilities))
    assert got["c"] == [None] * 6


def test_metrics(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 1), (0, 0), (1, 1)], "label int, prediction int")
    cells = {(r["label"], r["prediction"]): r["n"] for r in metrics.confusion(df).collect()}
    assert cells == {(0, 0): 1, (0, 1): 1, (1, 0): 1, (1, 1): 2}
    row = metrics.pair_metrics(df).first()
    assert row["precision"] == row["recall"] == row["f1"] == pytest.approx(2 / 3)
    none = metrics.pair_metrics(df.withColumn("prediction", F.lit(0))).first()
    assert (none["precision"], none["recall"], none["f1"]) == (0.0, 0.0, 0.0)
    links = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "y")], "id_A string, id_B string")
    other = spark.createDataFrame([("a", "x"), ("c", "z"), ("c", "z")], "id_A string, id_B string")
    row = metrics.link_metrics(links, other).first()
    assert (row["tp"], row["fp"], row["fn"]) == (1, 1, 1)


def greedy(rows):
    used_a, used_b, out = set(), set(), set()
    for a, b, s in sorted(rows, key=lambda r: (r[2], md5(r[0], r[1])), reverse=True):
        if a not in used_a and b not in used_b:
            used_a.add(a)
            used_b.add(b)
            out.add((a, b))
    return out


def test_one_to_one_small(spark):
    rows = [("a", "x", 0.9), ("a", "y", 0.8), ("b", "x", 0.85), ("b", "y", 0.6), ("c", "y", 0.4)]
    df = spark.createDataFrame(rows, "id_A string, id_B string, score double")
    assert {(r["id_A"], r["id_B"]) for r in assign.one_to_one(df).collect()} == {("a", "x"), ("b", "y")}
    assert assign.one_to_one(df, threshold=0.95).count() == 0


def test_one_to_one_equals_greedy(spark):
    rng = random.Random(7)
    rows = list({(f"a{rng.randrange(60)}" if rng.random() < 0.7 else "hot", f"b{rng.randrange(50)}"):
                 rng.choice([0.5, 0.7, 0.7, rng.random() / 2 + 0.5]) for _ in range(900)}.items())
    rows = [(a, b, s) for (a, b), s in rows]
    df = spark.createDataFrame(rows, "id_A string, id_B string, score double")
    got = [(r["id_A"], r["id_B"]) for r in assign.one_to_one(df).collect()]
    assert len({a for a, _ in got}) == len({b for _, b in got}) == len(got)
    assert set(got) == greedy(rows)


def test_equal_scores_settle_in_few_rounds(spark):
    rows = [(f"a{i}", f"b{j}", 0.9) for i in range(30) for j in range(30)]
    df = spark.createDataFrame(rows, "id_A string, id_B string, score double")
    for limit, most in ((500_000, 4), (100, 40)):
        rounds = []
        got = assign.one_to_one(df, settled_in_task=limit, rounds=rounds).collect()
        assert {(r["id_A"], r["id_B"]) for r in got} == greedy(rows) and len(got) == 30
        assert len(rounds) <= most


def test_a_chain_of_rising_scores_takes_few_rounds(spark):
    """Each pair is better than the one before it, so mutually best pairs would settle one a round."""
    n = 10_000
    rows = [(f"a{(i + 1) // 2}", f"b{i // 2}", 0.5 + i / (2.5 * n)) for i in range(n)]
    df = spark.createDataFrame(rows, "id_A string, id_B string, score double")
    rounds = []
    got = assign.one_to_one(df, rounds=rounds).collect()
    assert {(r["id_A"], r["id_B"]) for r in got} == greedy(rows)
    assert len(rounds) <= 20


def test_large_components_are_halved(spark):
    rng = random.Random(12)
    rows = list({(f"a{rng.randrange(120)}", f"b{rng.randrange(90)}"): rng.choice([0.6, 0.6, rng.random() / 2 + 0.5])
                 for _ in range(1500)}.items())
    rows = [(a, b, s) for (a, b), s in rows]
    df = spark.createDataFrame(rows + rows[:50], "id_A string, id_B string, score double")
    got = [(r["id_A"], r["id_B"]) for r in assign.one_to_one(df, settled_in_task=60).collect()]
    assert len(got) == len(set(got)) and set(got) == greedy(rows)


def test_pairs_formed_anew_are_settled_by_their_best(spark, monkeypatch):
    """Only the best pairs of each id are written; what they leave open is formed again. Copies count."""
    rng, best = random.Random(21), 2
    score = {(f"a{rng.randrange(40)}", f"b{rng.randrange(20)}"): rng.choice([0.6, 0.6, rng.random() / 2 + 0.5]) for _ in range(700)}
    copies = {i: rng.choice([1, 1, 1, 3]) for pair in sorted(score) for i in pair}
    df = spark.createDataFrame([(a, b, s, copies[a], copies[b]) for (a, b), s in score.items()],
                               "id_A string, id_B string, score double, copies_A long, copies_B long")
    written = []
    plain = assign.stage
    monkeypatch.setattr(assign, "stage", lambda d, name: written.append((name, plain(d, name))) or written[-1][1])

    def without(a, b):
        return df.join(a.withColumnRenamed("id", "id_A"), "id_A", "left_anti").join(b.withColumnRenamed("id", "id_B"), "id_B", "left_anti")

    left, expected = dict(copies), Counter()
    for a, b in sorted(score, key=lambda k: (score[k], md5(*k)), reverse=True):
        if n := min(left[a], left[b]):
            expected[a, b] = n
            left[a] -= n
            left[b] -= n
    for limit in (500_000, 100):
        got = assign.assign(df, settled_in_task=limit, without=without, best=best).collect()
        assert Counter({(r["id_A"], r["id_B"]): r["take"] for r in got}) == expected and len(got) == len(expected)
        runs = Counter()
        for r in got:
            for i, start in ((r["id_A"], r["from_A"]), (r["id_B"], r["from_B"])):
                runs.update((i, start + n) for n in range(r["take"]))
        assert max(runs.values()) == 1
    assert next(d for name, d in written if name == "open-pairs").count() <= best * len(copies)


def test_tasks_keep_the_best_of_either_side(spark):
    rows = [(f"a{i}", f"b{j}", (i * 7 + j * 11) % 50 / 50) for i in range(40) for j in range(40)]
    df = assign.with_tie(spark.createDataFrame(rows, "id_A string, id_B string, score double")).coalesce(1)
    for at_once in (100, 10_000):
        kept = {(r["id_A"], r["id_B"]) for r in assign.best_in_tasks(df, 2, at_once).collect()}
        order = sorted(rows, key=lambda r: (r[2], md5(r[0], r[1])), reverse=True)
        best = {r[:2] for side in (0, 1) for i in {r[side] for r in rows} for r in [r for r in order if r[side] == i][:2]}
        assert best <= kept and (at_once == 100 or kept == best)


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(500)]
    star = [(1000, 1000 + i) for i in range(1, 200)] + [(1100, 1000), (7000, 7000)]
    rounds = []
    got = {r["node"]: r["component"] for r in components.components(
        spark.createDataFrame(path + star, "a long, b long"), rounds).collect()}
    assert got == {i: 0 for i in range(501)} | {i: 1000 for i in range(1000, 1200)}
    assert len(rounds) <= 10
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def linker_records(spark, rng, n=80):
    rows = []
    for s in ("A", "B"):
        for i in range(n):
            m = rng.randrange(12)
            rows.append((s, f"{s.lower()}{i}", f"model {m}", f"make{m % 3}", rng.choice(["2000", "2001", None]),
                         float(rng.choice([100, 200, 4000])), rng.choice([None, 500.0, 90000.0]), None))
    return spark.createDataFrame(rows, "source string, id string, model string, make string, year string, "
                                 "price double, mileage double, state string")


def brute_met(records, rules):
    keyed = [r.asDict() for r in candidates.with_keys(records).collect()]
    a, b = ([r for r in keyed if r["source"] == s] for s in ("A", "B"))
    return {(x["id"], y["id"]) for x in a for y in b for r in rules
            if all(x[f"_p_{t}"] is not None and x[f"_p_{t}"] == y[f"_p_{t}"] for t in r.terms)}


def test_candidates_and_costs(spark):
    records = linker_records(spark, random.Random(8)).cache()
    rules = [candidates.Rule(("model_whole", "price_log")), candidates.Rule(("make_first3", "year_whole")),
             candidates.Rule(("price_whole", "mileage_whole"))]
    met = [(r["id_A"], r["id_B"]) for r in candidates.candidate_pairs(records, rules, "price").collect()]
    assert len(met) == len(set(met)) and set(met) == brute_met(records, rules)
    costs = {r["rule"]: r["pairs"] for r in candidates.rule_costs(records, rules).collect()}
    assert costs == {i: float(len(brute_met(records, [r]))) for i, r in enumerate(rules)}
    # Values far above a task's records are counted in parts, and weights count a record several times.
    for limit in (1, 5):
        parts = candidates.rule_costs(records, rules, rows_per_task=limit).collect()
        assert {r["rule"]: r["pairs"] for r in parts} == costs
    heavy = candidates.rule_costs(records.withColumn("w", F.lit(3)), rules, "w").collect()
    assert {r["rule"]: r["pairs"] for r in heavy} == {k: 9 * v for k, v in costs.items()}
    counted = candidates.block_counts(records, rules).groupBy("rule").agg(F.max(F.col("a") * F.col("b")).alias("m")).collect()
    assert {r["rule"]: float(r["m"]) for r in counted} == {
        r["rule"]: r["largest"] for r in candidates.rule_costs(records, rules).collect()}
    # Blocks far above a cell's rows are joined as grids: the same pairs.
    for limit in (1, 3, 7):
        grid = [(r["id_A"], r["id_B"]) for r in candidates.candidate_pairs(records, rules, rows_per_task=limit).collect()]
        assert len(grid) == len(set(grid)) and set(grid) == set(met)


def test_tasks_form_equal_shares_of_the_pairs(spark):
    """One huge block and many small ones: no task has over twice the mean, and one join makes the pairs of all rules."""
    model = F.when(F.col("i") < 1500, F.lit("popular")).otherwise(F.concat(F.lit("rare "), (F.col("i") / 4).cast("int")))
    none = [F.lit(None).cast(t).alias(c) for c, t in (("make", "string"), ("mileage", "double"), ("state", "string"))]
    records = spark.range(16_000).select(
        F.when(F.col("id") % 2 == 0, "A").otherwise("B").alias("source"), F.col("id").cast("string").alias("id"),
        F.floor(F.col("id") / 2).alias("i")).select("source", "id", model.alias("model"), F.lit("2000").alias("year"),
                                                    (F.col("i") % 50).cast("double").alias("price"), *none)
    rules = [candidates.Rule(("model_whole",)), candidates.Rule(("year_whole", "price_whole"))]
    # Joins by shuffle, as at size.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        met = candidates.candidate_pairs(records, rules, pairs_per_task=250_000)
        tasks = [r["n"] for r in met.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
        # Cells find their records by two joins, the pairs of both rules are formed by one.
        plan = met._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert plan.count("Join Inner") == 3 and plan.count("(_a#") >= 1
    assert len(tasks) >= 12 and max(tasks) <= 2 * sum(tasks) / len(tasks)


def test_a_large_block_is_spread_over_tasks(spark):
    side = spark.range(3000).select(F.lit(1).alias("k"), F.col("id").alias("x"))
    met = blocking.grid_join(side.withColumnRenamed("x", "id_A"), side.withColumnRenamed("x", "id_B"), ["k"],
                             "id_A", "id_B", rows_per_task=500)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        parts = [r["n"] for r in met.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(parts) == 9_000_000 and len(parts) > 10 and max(parts) < 2_000_000


def test_learned_rules_cover_the_matches(spark):
    records = linker_records(spark, random.Random(9)).cache()
    rows = records.collect()
    by = defaultdict(list)
    for r in rows:
        by[(r["model"], r["price"])].append(r)
    known = [(x["id"], y["id"]) for g in by.values() for x in g if x["source"] == "A"
             for y in g if y["source"] == "B"][:25]
    links = spark.createDataFrame(known, "id_A string, id_B string")
    learned = candidates.learn_blocking(records, links)
    assert learned.uncovered == 0 and sum(learned.covered) == learned.matches == len(known)
    assert set(known) <= brute_met(records, learned.rules)
    # Whatever is measured, all are covered, and the measured counts are exact.
    crowd = records.unionByName(records.filter("source = 'A'").withColumn(
        "id", F.explode(F.transform(F.sequence(F.lit(1), F.lit(30)), lambda i: F.concat_ws("-", "id", i)))))
    near = candidates.learn_blocking(records, links, crowd)
    assert near.rules == learned.rules and near.uncovered == 0
    counts = candidates.block_counts(crowd, near.rules).groupBy("rule").agg(F.sum(F.col("a") * F.col("b")).alias("pairs")).collect()
    assert {near.rules[r["rule"]]: float(r["pairs"]) for r in counts if r["pairs"]} == {
        r: p for r, p in zip(near.rules, near.pairs) if p}
    # Records repeated tenfold under new ids lead to the same rules.
    tenfold = records.withColumn("id", F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(9)), lambda i: F.when(i == 0, F.col("id")).otherwise(F.concat_ws("-", "id", i)))))
    assert candidates.learn_blocking(tenfold, links).rules == learned.rules


def test_rules_are_ordered_by_a_count_of_all_records(spark):
    # One profile with many copies on both sides, whose digest is the last of 200: a share by digest goes without it.
    row = [F.lit(None).cast(t).alias(c) for c, t in (
        ("make", "string"), ("year", "string"), ("price", "double"), ("mileage", "double"))]
    names = spark.range(200).select(F.format_string("copied%d", "id").alias("model"), *row, F.lit(None).cast("string").alias("state"))
    heavy = names.orderBy(ranking.digest(*candidates.COMPARED).desc()).first()["model"]
    n = F.col("id")
    state = F.when(n < 10, F.format_string("s%d", n)).when(n < 50, "many")
    model = F.when(n < 20_000, F.format_string("m%d", n)).otherwise(heavy)
    records = spark.range(22_000).select(
        F.explode(F.array(F.lit("A"), F.lit("B"))).alias("source"), "id", model.alias("model"), *row, state.alias("state"))
    records = records.withColumn("id", F.concat_ws("-", "source", "id")).filter(
        "source = 'A' or model not like 'm%' or state is not null").cache()
    links = spark.createDataFrame([(f"A-{i}", f"B-{i}") for i in range(10)], "id_A string, id_B string")
    learned = candidates.learn_blocking(records, links, terms=1)
    assert records.count() > 20_000
    # By state 10 + 40 * 40 pairs meet, by model 50 + 2,000 * 2,000: the copies decide.
    assert [r.name for r in learned.rules] == ["state_whole"] and learned.pairs == (1610.0,)


def test_saved_rules_are_read_again(spark):
    from mergewright.sources.staging import new_path
    learned = candidates.Learned((candidates.Rule(("a", "b")), candidates.Rule(("c",))), (3, 2), (9.0, 4.0), 6, 1)
    path = new_path(spark, "rules")
    learned.save(spark, path)
    assert candidates.load_rules(spark, path) == learned


def test_profiles_count_copies(spark):
    records = linker_records(spark, random.Random(10))
    expected = Counter((r["source"], *[r[c] for c in candidates.COMPARED]) for r in records.collect())
    got = candidates.profiles(candidates.with_profile(records)).collect()
    assert {(r["source"], *[r[c] for c in candidates.COMPARED]): r["copies"] for r in got} == expected


def test_weighted_fit_equals_the_plain_loss(spark):
    rng = random.Random(11)
    rows = [(float(x := rng.randrange(3)), float(y := rng.randrange(2)), int(rng.random() < (x + y + 1) / 5))
            for _ in range(600)]
    df = spark.createDataFrame(rows, "x double, y double, label int")
    by_feature, b = models.weights(models.fit_matcher(df, ["x", "y"], c=1.0))
    w = [by_feature["x"], by_feature["y"]]
    # At the optimum the gradient of  sum(loss) + |w|^2 / 2  vanishes.
    g = [0.0, 0.0, 0.0]
    for x, y, label in rows:
        e = 1 / (1 + math.exp(-(w[0] * x + w[1] * y + b))) - label
        g = [g[0] + e * x, g[1] + e * y, g[2] + e]
    assert max(abs(g[0] + w[0]), abs(g[1] + w[1]), abs(g[2])) < 1e-6


def test_fit_takes_few_jobs_and_stands_separable_data(spark, monkeypatch):
    steps = []
    monkeypatch.setattr(models, "newton_sums", lambda *a, f=models.newton_sums: steps.append(1) or f(*a))
    rng = random.Random(5)
    rows = [(x := rng.random() * 40 - 20, rng.random(), int(x > 0)) for _ in range(400)]
    df = spark.createDataFrame(rows, "x double, y double, label int")
    fitted = models.fit_matcher(df, ["x", "y"])
    assert len(steps) <= 25 and models.weights(fitted)[0]["x"] > 0.5
    wrong = models.predict(df, *models.weights(fitted)).filter("prediction <> label").count()
    assert wrong <= 4
    with pytest.raises(ValueError, match="no pairs"):
        models.fit_matcher(df.limit(0), ["x", "y"])
    one = models.fit_matcher(df.filter("label = 1"), ["x", "y"])
    assert models.predict(df, *models.weights(one)).filter("prediction = 0").count() == 0


def test_nan_is_missing(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1.0,), (2.0,), (nan,), (4.0,), (None,)], "x double")
    row = quantiles.describe_numeric(df).first().asDict()
    assert (row["count"], round(row["mean"], 4), row["max"], row["q50"], row["q75"]) == (3, 2.3333, 4.0, 2.0, 3.0)
    assert profile.numeric_stats(df, ["x"]).first()["max"] == 4.0
    summary = profile.profile_summary(df).first()
    assert (summary["missing_count"], summary["unique_count"]) == (2, 3)
    assert profile.missing_counts(df).first()["missing_count"] == 2
    assert profile.approx_distinct_counts(df).first()["unique_count"] == 3
    parts = profile.partial_profile(df.withColumn("p", F.lit(1)), ["p"], ["x"])
    assert profile.merge_profiles(parts).first()["max"] == 4.0


def test_cuts_refine_a_large_bucket(spark):
    rows = [(i % 2, hashlib.md5(str(i % 50).encode()).hexdigest()[:6] + hashlib.md5(str(i).encode()).hexdigest()[6:])
            for i in range(2000)]
    df = spark.createDataFrame(rows, "label int, d string")
    for limit in (5, 10 ** 6):
        got = {r["label"]: (r["cut_70"], r["cut_85"]) for r in ranking.class_cuts(
            df, "label", "d", [70, 85], [0, 1], rows_per_task=limit).collect()}
        for label in (0, 1):
            ordered = sorted(d for k, d in rows if k == label)
            assert got[label] == (ordered[699], ordered[849])
    assert ranking.bucket_chars(10 ** 12) > ranking.bucket_chars(10 ** 6) == 3


def test_model_is_used_again(spark):
    from mergewright.sources.staging import new_path
    df = spark.createDataFrame([(0.0, 0), (1.0, 1), (0.5, 1), (0.4, 0)], "x double, label int")
    path, calls = new_path(spark, "model"), []
    def fit():
        calls.append(1)
        return models.fit_matcher(df, ["x"])
    first = models.weights(models.load_or_fit(spark, path, fit))
    assert models.weights(models.load_or_fit(spark, path, fit)) == first and len(calls) == 1


def test_cells_leave_a_task_without_repeats(spark):
    df = spark.range(5_000, numPartitions=2).select((F.col("id") % 3).alias("few"), F.col("id").cast("string").alias("all"),
                                                    F.when(F.col("id") < 7, F.lit("x" * 80)).alias("some"))
    got = profile.cells(df, df.columns, ["few", "some"]).collect()
    assert len(got) <= 2 * (3 + 2) and sum(r["n"] for r in got) == 10_000
    assert {r["value"][:1] for r in got if r["i"] == 2 and r["value"]} == {"#"}
    # Cut anywhere, the counts are the same.
    small = profile.cells(df, df.columns, df.columns, cell_bytes=1)
    assert small.agg(F.sum("n")).first()[0] == 15_000
    assert {r["attribute"]: (r["missing_count"], r["unique_count"]) for r in profile.profile_summary(df).collect()} == {
        "few": (0, 3), "all": (0, 5_000), "some": (4_993, 1)}


def test_capped_pairs_are_formed_for_the_first_rows_only(spark, monkeypatch):
    """The first pairs of each label, although nearly all rows have one and an order column is missing here and there."""
    rows = [(f"a{i:03}", "m", "one" if i % 2 else "two", f"{i:017d}", None if i % 50 == 3 else i // 2) for i in range(300)]
    a = spark.createDataFrame(rows, "id string, make string, model string, vin string, pos long")
    b = a.withColumn("id", F.replace("id", F.lit("a"), F.lit("b"))).filter("pos % 3 = 0 or pos is null")
    a, b = (d.select(*[F.col(f.name) if f.name in d.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in MEDIATED.fields], "pos")
            for d in (a, b))
    staged = {}

    def kept(df, name):
        staged[name] = max(staged.get(name, 0), df.count())
        return df.localCheckpoint()

    monkeypatch.setattr(pairs, "stage", kept)
    got = pairs.label_pairs(a, b, blocking.B1, ("pos", "id"), ("pos", "id"), cap=9)
    whole = pairs.label_pairs(a, b, blocking.B1, ("pos", "id"), ("pos", "id"))
    place = {r[0]: i for i, r in enumerate(sorted(rows, key=lambda r: (r[4] is not None, r[4] or 0, r[0])))}
    for label in (0, 1):
        own = sorted(place[r["id_A"]] for r in got.filter(F.col("label") == label).collect())
        assert own == sorted(place[r["id_A"]] for r in whole.filter(F.col("label") == label).collect())[:9]
    assert staged["uncapped"] <= 9 * 5
