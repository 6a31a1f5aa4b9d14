"""Exact and near duplicates against brute force."""

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from mergewright.llm import exact_dedup, near_join, shingles
from tests.llm.conftest import sentence


def expected_groups(rows):
    groups = {}
    for r in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", r.text or ""), []).append(r)
    out = []
    for text, group in groups.items():
        group.sort(key=lambda r: (-len(r.text or ""), r.doc_id is not None, r.doc_id or 0))
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(r.doc_id, group[0].doc_id, len(group), i == 0, sha) for i, r in enumerate(group)]
    return sorted(out, key=repr)


def as_tuples(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_exact_groups(spark, edge, none):
    columns = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    more = edge.unionByName(edge.withColumn("doc_id", F.col("doc_id") + 100)).repartition(5)
    for size in (exact_dedup.FILTER_BYTES, 16):  # 16 bytes: many slices, nearly full filters
        assert as_tuples(exact_dedup.groups(more, size), *columns) == expected_groups(more.collect())
    assert exact_dedup.groups(none).count() == 0


def test_filter_never_misses_a_repeat():
    shas = pa.array([hashlib.sha256(str(i).encode()).digest() for i in range(500)], pa.binary())
    at = exact_dedup.positions(shas, 1 << 16)
    bitmap = np.zeros((1 << 16) // 8, np.uint8)
    exact_dedup.set_all(bitmap, at[:250])
    found = exact_dedup.has_all(bitmap, at)
    assert found[:250].all() and found[250:].mean() < 0.05


def test_most_unique_rows_pass_straight_through(spark):
    docs = spark.range(3000).select(exact_dedup.digest(F.concat(F.lit("t"), F.least("id", F.lit(2900)))).alias("sha"))
    once, more = exact_dedup.Repeats(docs).split(docs, "sha")
    assert once.count() + more.count() == 3000
    assert 100 <= more.count() < 160


def test_kept_rows(spark, edge, none):
    kept = exact_dedup.keep_one(edge)
    assert kept.columns == edge.columns
    rows = edge.collect()
    assert as_tuples(kept, "doc_id") == sorted(((d,) for d, _, _, k, _ in expected_groups(rows) if k), key=repr)
    assert exact_dedup.keep_one(none).count() == 0


def brute(rows, threshold):
    words = [re.findall(r"[^\W_]+", (r.text or "").lower()) for r in rows]
    sets = [{tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set() for w in words]
    n, links, parent = len(rows), [0] * len(rows), list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(n):
        for j in range(i):
            same = sets[i] == sets[j]
            if same or sets[i] and sets[j] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    members = {}
    for i in range(n):
        members.setdefault(root(i), []).append(rows[i].doc_id)
    smallest = {k: min((d for d in v if d is not None), default=None) for k, v in members.items()}
    return sorted(((rows[i].doc_id, smallest[root(i)], links[i]) for i in range(n)), key=repr)


def near_copies(spark):
    rows = []
    for g in range(12):
        base = sentence(100 + 7 * g, 150).split()
        for k in range(9):
            copy = list(base)
            for change in range(k // 3):
                copy[(17 * k + 41 * change) % 150] = f"new{k}{change}"
            rows.append((g * 100 + k, " ".join(copy) if k != 4 else " ".join(base)))
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_near_classes_equal_brute_force(spark, edge, none, monkeypatch):
    docs = near_copies(spark).unionByName(edge.select("doc_id", "text")).repartition(3)
    expected = brute(docs.collect(), 0.8)
    assert as_tuples(near_join.classes(docs), "doc_id", "class_id", "n_links") == expected
    assert near_join.classes(none).count() == 0


def test_lone_pairs_at_the_threshold_are_found_beside_close_copies(spark):
    # 2,000 pairs of similarity 40 / 50, and one big group of close copies that once made up for those not found.
    rng = np.random.default_rng(5)
    a, b = shingles.permutations(128)

    def signed(rep, sets):
        return [(rep + i, 1, shingles.minhash(x, a, b).tobytes()) for i, x in enumerate(sets)]

    rows = []
    for g in range(2000):
        x = rng.integers(0, 1 << 63, 50, np.uint64)
        rows += signed(2 * g, [x[:45], np.concatenate([x[:40], x[45:]])])
    base = rng.integers(0, 1 << 63, 400, np.uint64)
    rows += signed(10_000, [np.delete(base, i) for i in range(300)])
    reps = spark.createDataFrame(rows, "rep long, n_shingles int, signature binary")
    found = near_join.candidate_links(reps).filter("greatest(a, b) < 4000")
    assert found.count() == 2000
    # Prefixes that are never shortened lose some: some 1 % of such pairs at 8 values, of which two tries share half.
    whole = near_join.candidate_links(reps, shortest=near_join.LONGEST).filter("greatest(a, b) < 4000")
    assert 1900 < whole.count() < 2000


def test_prefixes_are_shortened_step_by_step():
    """A pair that shares four values of a trie, one that shares six, and a run that already lies in one group."""
    width, trie = near_join.HASHES, 5
    columns = (trie * 4 + np.arange(near_join.LONGEST)) % width
    base = np.arange(width, dtype=np.uint16)
    rows = np.stack([base] * 4)
    for i, same in ((1, 8), (2, 6), (3, 4)):
        rows[i, columns[same:]] += np.uint16(500 * i)
    assert near_join.grow(rows, trie, 8).tolist() == [0, 0, 2, 3]
    assert near_join.grow(rows, trie, 6).tolist() == [0, 0, 0, 3]
    assert near_join.grow(rows, trie, 4).tolist() == [0, 0, 0, 0]
    # Only rows of different blocks are compared, and chance meetings are dropped.
    assert near_join.grow(rows, trie, 4, np.array([0, 0, 1, 1])).tolist() == [0, 0, 0, 0]
    assert near_join.grow(rows[:2], trie, 4, np.array([0, 0])).tolist() == [0, 1]
    far = rows[[0, 0]].copy()
    far[1, np.setdiff1d(np.arange(width), columns)] += 1
    assert near_join.grow(far, trie, 4).tolist() == [0, 1]
    assert near_join.shortest_prefix(0.8) == 4 and near_join.missed(0.8, 5) > near_join.MISSED


def test_blocks_of_sizes_far_apart_never_meet(spark):
    sizes = {1: 100, 2: 101, 3: 79, 4: 126, 5: 60, 6: 200, 7: 100}
    members = spark.createDataFrame([(9, i, 1, n, bytes([i])) for i, n in sizes.items()],
                                    "component long, rep long, copies long, n_shingles int, text_key binary")
    with_block = near_join.GROUP_BLOCK
    try:
        near_join.GROUP_BLOCK = 1
        cells = {}
        for r in near_join.cells_by_size(members, 0.8).collect():
            cells.setdefault((r.left, r.right), set()).add(r.rep)
    finally:
        near_join.GROUP_BLOCK = with_block
    met = {(a, b) for held in cells.values() for a in held for b in held if a < b}
    near = {(a, b) for a in sizes for b in sizes if a < b and 0.8 <= sizes[a] / sizes[b] <= 1.25}
    assert near <= met and (5, 6) not in met and (3, 6) not in met


def test_blocks_of_a_few_rows_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(near_join, "BUCKET_BLOCK", 3)
    monkeypatch.setattr(near_join, "GROUP_BLOCK", 2)
    docs = near_copies(spark)
    assert as_tuples(near_join.classes(docs), "doc_id", "class_id", "n_links") == brute(docs.collect(), 0.8)


def test_one_of_each_class_stays(spark, edge, none):
    docs = edge.unionByName(edge.filter("doc_id = 6"))
    kept = near_join.keep_one(docs)
    assert kept.columns == docs.columns
    classes = {r.class_id for r in near_join.classes(docs).collect()}
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(classes)
    assert 8 in ids and 6 not in ids and 7 not in ids  # the one with most shingles
    assert near_join.keep_one(none).count() == 0


def test_different_texts_without_words_stay(spark):
    docs = spark.createDataFrame([(1, "-----"), (2, "!!! ???"), (3, "!!!\n???"), (4, "\U0001f600"), (5, None), (6, "-----"), (7, " "),
                                  (8, "some words")], "doc_id long, text string")
    assert sorted(r.doc_id for r in near_join.keep_one(docs).collect()) == [1, 2, 4, 5, 8]


def test_components_of_a_long_chain(spark):
    chain = spark.range(1, 60).select(F.col("id").alias("a"), (F.col("id") - 1).alias("b"))
    other = spark.createDataFrame([(101, 100), (102, 100)], "a long, b long")
    got = {r.node: r.component for r in near_join.components(chain.unionByName(other)).collect()}
    assert got == {**dict.fromkeys(range(60), 0), 100: 100, 101: 100, 102: 100}


def test_minhash_estimates_jaccard():
    a, b = shingles.permutations(128)
    left = shingles.mix(np.arange(1000, dtype=np.uint64))
    right = shingles.mix(np.arange(200, 1200, dtype=np.uint64))
    same = (shingles.minhash(left, a, b) == shingles.minhash(right, a, b)).mean()
    assert abs(same - 800 / 1200) < 0.15
