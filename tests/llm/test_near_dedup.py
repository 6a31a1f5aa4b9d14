import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from mergewright.llm import common, near_dedup

BLANKS = " \t\n\x0b\x0c\r"


def brute(rows, percent=80):
    """(doc_id, n_shingles, component_id, kept) by comparing all pairs of sets."""
    sets = []
    for _, text in rows:
        words = (text or "").translate({i: i + 32 for i in range(65, 91)}).translate(dict.fromkeys(map(ord, BLANKS), " ")).split(" ")
        words = [w for w in words if w]
        sets.append({tuple(words[i:i + 4]) for i in range(max(1, len(words) - 3))} if words else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(i)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in groups[find(i)] if rows[j][0] is not None]
        least = min(ids) if ids else None
        out.append((doc_id, len(sets[i]), least, doc_id == least))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(map(tuple, df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)


def corpus(seed=4):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for base in range(12):
        words = [r.choice(vocabulary) for _ in range(60)]
        for _ in range(1 + 6 * (base % 4)):
            copy = list(words)
            for _ in range(r.choice([0, 0, 1, 1, 2, 3])):
                copy[r.randrange(len(copy))] = r.choice(vocabulary)
            rows.append(" ".join(copy))
    # A chain: each text is near its neighbours alone.
    words = [r.choice(vocabulary) for _ in range(120)]
    for step in range(25):
        rows.append(" ".join(words[4 * step:] + [f"x{i}" for i in range(4 * step)]))
    return list(enumerate(rows))


@pytest.mark.parametrize("block", [4, 1024])
def test_components_equal_brute_force_whatever_the_block(spark, block):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(near_dedup.near_duplicates(docs, block=block)) == brute(rows)


def test_edge_rows(edge):
    rows = [(r.doc_id, r.text) for r in edge.select("doc_id", "text").collect()]
    assert rows_of(near_dedup.near_duplicates(edge)) == brute(rows)


def test_empty_table(none):
    assert near_dedup.near_duplicates(none).count() == 0


def test_the_threshold_is_met_exactly(spark):
    # 8 of 10 shingles shared: linked; 7 of 10: not.
    def text(shared, own, tag):
        words = [f"s{i}" for i in range(shared + 3)] + [f"{tag}{i}" for i in range(own)]
        return " ".join(words)

    # Sets of 9 with 8 common: 8 / 10. Sets of 17 with 15 common: 15 / 19.
    rows = [(1, text(8, 1, "a")), (2, text(8, 1, "b")), (3, "q " + text(15, 1, "c")), (4, "r " + text(15, 1, "d"))]
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {doc_id: least for doc_id, _, least, _ in brute(rows)}
    assert got[2] == 1 and got[4] == 4


def test_lone_pairs_at_the_threshold_are_found(spark):
    pairs = 1500
    rows = []
    for p in range(pairs):
        # 40 and 40 shingles with 36 common: 36 / 44 = 0.818.
        words = [f"p{p}w{i}" for i in range(43)]
        rows += [(2 * p, " ".join(words)), (2 * p + 1, " ".join(words[:39] + [f"p{p}v{i}" for i in range(4)]))]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got.filter("not kept").count() == pairs


def test_posterior_bounds():
    least = near_dedup.least_matches()
    assert len(least) == near_dedup.HASHES // near_dedup.BATCH
    # Beta posterior with a uniform prior, integrated numerically.
    s = np.linspace(0, 1, 200_001)
    for n, low in zip(range(near_dedup.BATCH, near_dedup.HASHES + 1, near_dedup.BATCH), least, strict=True):
        for m, kept in ((low, True), (low - 1, False)):
            density = s ** m * (1 - s) ** (n - m)
            chance = density[s >= 0.8].sum() / density.sum()
            assert (chance >= near_dedup.MISS * 0.99) == kept


def test_lower_case_of_sliced_texts():
    texts = pa.array(["ÄB" * 50, None, "Zz", "", "日本A"] * 30)
    for part in (texts, texts.slice(7, 61), texts.slice(3, 0)):
        want = [(t or "").translate({i: i + 32 for i in range(65, 91)}) for t in part.to_pylist()]
        assert common.lower_ascii(part).to_pylist() == want


def test_repeated_rows_and_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(None, text), (None, text), (5, text + " more"), (5, text + " more"), (None, "alone here")],
                                 "doc_id long, text string").withColumn("digest", F.lit("clash"))
    got = rows_of(near_dedup.near_duplicates(docs))
    assert got == brute([(None, text), (None, text), (5, text + " more"), (5, text + " more"), (None, "alone here")])
