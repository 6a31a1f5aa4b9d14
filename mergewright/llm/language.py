"""Language identification by the nearest of several centroids per language.

A text becomes counts of hashed character n-grams, damped, weighted by inverse
document frequency and normalised to length 1. Per language, spherical k-means gives several centroids; a text gets
the language of the centroid with the highest cosine. A text further from its
language's centroids than nearly all of that language's learning texts is marked ``rejected``.

The model is fitted on a bounded sample of the learning rows (``PER_LANGUAGE`` rows of each language, chosen by a
hash of the id); a language is learned whatever its share. Document frequencies are counted over all learning rows. Predictions read whole
texts. Without learning rows every text is ``und``; so is a null text and one
without a letter (score 0).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mergewright.llm import common, ngrams

PER_LANGUAGE = 400
SIZES = (1, 2, 3)
BUCKETS = 4096
CENTROIDS = 4
ROUNDS = 12
REJECT_QUANTILE = 0.001
REJECT_SLACK = 0.9
UNKNOWN = "und"


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray
    owner: np.ndarray
    floor: np.ndarray

    def similarities(self, counts: np.ndarray) -> np.ndarray:
        return normalise(counts, self.idf) @ self.centroids.T


def normalise(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weighted = np.log1p(counts) * idf
    norm = np.linalg.norm(weighted, axis=1, keepdims=True)
    return (weighted / np.where(norm > 0, norm, 1)).astype(np.float32)


def count_vectors(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` and n-gram counts of each whole text (int32, little-endian)."""
    kept = docs.select(*keep, common.text_or_empty("text").alias("text"))
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in kept.schema if f.name != "text"]

    def run(batches):
        table = common.worker_cache("letters", ngrams.letter_table)
        for batch in batches:
            counts = [ngrams.bucket_counts(ngrams.letters_only(t, table), SIZES, BUCKETS).astype("<i4").tobytes()
                      for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), pa.array(counts, pa.binary())],
                                             names=[*keep, "counts"])

    return kept.mapInArrow(run, ", ".join([*fields, "counts binary"]))


def learning_rows(docs: DataFrame) -> DataFrame:
    return docs.filter("lang is not null and text is not null").filter(~common.in_test_fold("doc_id"))


def learning_sample(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """At most ``per_language`` learning rows of each language, the first by a hash of the id."""
    learn = learning_rows(docs)
    return common.bounded_sample(learn.select("doc_id", "text"), learn.select(F.col("lang").alias("label"), "doc_id"),
                                 "label", per_language)


def document_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """Learning rows, and in how many of them each bucket occurs: added up in tasks, one row a bucket of each is shuffled."""
    def run(batches):
        table = common.worker_cache("letters", ngrams.letter_table)
        n, seen = 0, np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                seen += ngrams.bucket_counts(ngrams.letters_only(text, table), SIZES, BUCKETS) > 0
                n += 1
        # The last bucket counts rows.
        yield pa.RecordBatch.from_arrays([pa.array(range(BUCKETS + 1), pa.int32()), pa.array([*seen.tolist(), n], pa.int64())],
                                         names=["bucket", "n"])

    rows = learning_rows(docs).select(common.text_or_empty("text").alias("text")).mapInArrow(run, "bucket int, n long")
    out = np.zeros(BUCKETS + 1, np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).toLocalIterator():
        out[r.bucket] = r.n
    return int(out[-1]), out[:-1]


def spherical_means(vectors: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Centroids of length 1; the start is spread out by farthest-first choice, so results repeat."""
    chosen = [int(np.argmax(vectors @ vectors.mean(axis=0)))]
    nearest = vectors @ vectors[chosen[0]]
    while len(chosen) < min(k, len(vectors)):
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, vectors @ vectors[chosen[-1]])
    centroids = vectors[chosen].copy()
    for _ in range(rounds):
        owner = np.argmax(vectors @ centroids.T, axis=1)
        for i in range(len(centroids)):
            if (owner == i).any():
                mean = vectors[owner == i].mean(axis=0)
                centroids[i] = mean / max(np.linalg.norm(mean), 1e-12)
    return centroids


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Fit on the bounded sample; its n-gram counts and the document frequencies of all learning rows reach the driver."""
    rows = count_vectors(learning_sample(docs, per_language), "label").collect()
    rows.sort(key=lambda r: (r.label, bytes(r.counts)))
    languages = sorted({r.label for r in rows})
    counts = np.array([np.frombuffer(r.counts, "<i4") for r in rows]).reshape(-1, BUCKETS)
    label = np.array([languages.index(r.label) for r in rows], int)
    n, frequencies = document_frequencies(docs)
    idf = (np.log((1 + n) / (1 + frequencies)) + 1).astype(np.float32)
    vectors = normalise(counts, idf)
    centroids, owner, floor = [], [], []
    for i in range(len(languages)):
        own = vectors[label == i]
        means = spherical_means(own, CENTROIDS)
        centroids.append(means)
        owner += [i] * len(means)
        floor.append(REJECT_SLACK * float(np.quantile((own @ means.T).max(axis=1), REJECT_QUANTILE)))
    return Model(languages, idf, np.concatenate(centroids) if centroids else np.zeros((0, BUCKETS), np.float32),
                 np.array(owner, int), np.array(floor, np.float32))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score (the winning cosine), rejected; texts are the only input."""
    held = docs.sparkSession.sparkContext.broadcast(vars(model))  # plain arrays: what is broadcast is not pickled by value
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_or_empty("text").alias("text"))

    def run(batches):
        m = Model(**held.value)
        table = common.worker_cache("letters", ngrams.letter_table)
        for batch in batches:
            for part in (p for s in common.slices(batch, "text") for p in (
                    s.slice(i, 512) for i in range(0, s.num_rows, 512))):
                points = [ngrams.letters_only(t, table) for t in part.column("text").to_pylist()]
                known = np.array([len(p) > 2 for p in points]) & bool(m.languages)
                best = np.zeros(len(points), np.float64)
                names, rejected = [UNKNOWN] * len(points), ~known
                at = np.flatnonzero(known)
                if len(at):
                    cosine = m.similarities(np.array([ngrams.bucket_counts(points[i], SIZES, BUCKETS) for i in at]))
                    win = cosine.argmax(axis=1)
                    score = cosine[np.arange(len(at)), win]
                    best[at] = np.clip(score, 0, 1)
                    rejected[at] = score < m.floor[m.owner[win]]
                    for i, w in zip(at.tolist(), m.owner[win].tolist(), strict=True):
                        names[i] = m.languages[w]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(names), pa.array(best), pa.array(rejected)],
                    names=["doc_id", "lang_pred", "score", "rejected"])

    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean")


def op4_language(spark: SparkSession, folder: str) -> DataFrame:
    """Predict the language of every document: doc_id, held_out, lang_pred, score, rejected."""
    docs = common.table(spark, folder, "documents")
    return (predict(docs, fit(docs))
            .select("doc_id", common.in_test_fold("doc_id").alias("held_out"), "lang_pred", "score", "rejected"))
