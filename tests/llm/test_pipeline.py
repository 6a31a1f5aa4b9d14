"""The pipeline against a plain version of each stage."""

import re
import zlib

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from mergewright.llm import tokens, toxicity
from tests.llm.conftest import sentence


def corpus(spark):
    rng = np.random.default_rng(5)
    rows, labels = [], []
    for i in range(240):
        words = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(40)]
        if i % 4 == 0:
            words[7] = "idiot"
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    for g in range(6):
        base = sentence(300 + 11 * g, 120).split()
        for k in range(6):
            copy = list(base)
            for change in range(k // 2):
                copy[17 * k + 5 * change] = f"new{k}{change}"
            rows.append((1000 + 10 * g + k, ("  " if k % 2 else " ").join(copy)))
    rows += [(2000, None), (2001, " \n"), (2002, f'{sentence(7, 30)} token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" end'),
             (2003, f"{sentence(8, 30)} order 4785380592391139")]
    docs = spark.createDataFrame([(i, t, None, "s", len(t or "")) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int")


def one_of_each(rows, key, best):
    groups = {}
    for row in rows:
        groups.setdefault(key(row), []).append(row)
    return [min(g, key=best) for g in groups.values()]


def shingled(text):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    return {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def near_groups(rows):
    sets, group = [shingled(t) for _, t in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a == b or a and b and len(a & b) >= 0.8 * len(a | b):
                old, new = group[i], group[j]
                group = [new if x == old else x for x in group]
    return [one for one in one_of_each([(g, len(s), r) for g, s, r in zip(group, sets, rows, strict=True)],
                                       lambda x: x[0], lambda x: (-x[1], x[2][0]))]


def test_pipeline_equals_a_plain_version(spark, tmp_path):
    docs, labels = corpus(spark)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact dedup", "n-gram jaccard join", "secret scans", "packing"]

    score = toxicity.scorer(toxicity.fit(docs, labels), spark)
    rows = [(r.doc_id, r.text) for r in docs.withColumn("s", score("text")).filter(F.col("s") < 0.5).collect()]
    assert 150 < len(rows) < len(docs.collect()) - 50
    rows = one_of_each(rows, lambda r: re.sub(r"[\x20\x09-\x0D]", "", r[1] or ""), lambda r: (-len(r[1] or ""), r[0]))
    rows = [r for _, _, r in near_groups(rows)]
    secret = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"
    texts = {i: (t or "").replace(secret, "<SECRET>") for i, t in rows}
    encoder = tokens.Encoder(tokens.definition())
    ids = {i: np.append(encoder._encode_whole([t])[0], 1).astype("<u4") for i, t in texts.items()}

    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} == set(ids)
    assert sum(r.length for r in got) == sum(map(len, ids.values()))
    for r in got:
        assert zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes()) == r.ids_crc32
        assert r.doc_tokens == len(ids[r.doc_id])
