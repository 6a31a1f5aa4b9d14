"""Toxicity by gradient-boosted trees over a few dense features, with isotonic calibration.

Features of a whole text: densities and counts of lexicon words (a fixed list, and words and word
beginnings learned from labels), how many stand near a second-person word, rates
of capitals, punctuation and obfuscated words, hits among the latter once
spelled plainly, and size.

Labels are learned only from rows outside the test fold, on a bounded sample
(``PER_LABEL`` rows of either label, chosen by a hash of the id; rows are weighted back to the true shares). A third
of it is left to calibration. A null text is an empty one. If either label is missing, every score is
the share of toxic rows (0 without any label).
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mergewright.llm import boosting, common
from mergewright.sources.staging import stage

PER_LABEL = 4000
#: A learned word or beginning occurs in so many toxic rows, and so many times as often as in others.
LEAST_ROWS, LEAST_RATIO, MOST_WORDS = 3, 12.0, 4000
STEMS = (4, 5, 6)
NEAR = 5
#: Insults, and second-person words.
INSULTS = frozenset("idiot moron stupid loser scum trash worthless pathetic disgusting clown dumb imbecile "
                    "fool jerk creep filth vermin".split())
SECOND = frozenset("you your yours yourself tu te toi ton ta tes vous votre vos du dich dir dein deine ihr euch "
                   "usted ustedes vosotros vuestro ti tus".split())
#: Signs and digits that stand for letters.
PLAIN = str.maketrans({"@": "a", "4": "a", "0": "o", "3": "e", "1": "i", "!": "i", "|": "l", "$": "s", "5": "s",
                       "7": "t", "+": "t"})
WORDS = re.compile(r"[^\W\d_]+")
VEILED = re.compile(r"[^\W\d_]+[@$!|+*0134578]+[^\W\d_][\w@$!|+*]*")
PUNCTUATION = re.compile(r"[!?]")


@dataclass
class Model:
    words: dict[str, float]
    stems: dict[str, float]
    start: float
    trees: list
    at: np.ndarray
    probability: np.ndarray

    def scores(self, texts: list[str]) -> np.ndarray:
        if not self.trees:
            return np.full(len(texts), self.start)
        x = np.array([features(t, self.words, self.stems) for t in texts]).reshape(len(texts), -1)
        return boosting.calibrated(boosting.score_trees(x, self.start, self.trees), self.at, self.probability)


def features(text: str, words: dict[str, float], stems: dict[str, float]) -> list[float]:
    lower = text.lower()
    found = WORDS.findall(lower)
    n = max(len(found), 1)
    fixed = sum(map(INSULTS.__contains__, found))
    weights = [words[w] for w in found if w in words]
    begun = [w for size in STEMS for w in (x[:size] for x in found if len(x) >= size) if w in stems]
    near = 0
    if weights or fixed or begun:
        second = [i for i, w in enumerate(found) if w in SECOND]
        if second:
            hits = [i for i, w in enumerate(found) if w in words or w in INSULTS
                    or any(w[:s] in stems for s in STEMS if len(w) >= s)]
            at = np.searchsorted(second, hits)
            where = np.array([-10 ** 9, *second, 10 ** 9])
            near = int((np.minimum(np.abs(where[at] - hits), np.abs(where[at + 1] - hits)) <= NEAR).sum())
    veiled = VEILED.findall(lower)
    plain = [v.translate(PLAIN) for v in veiled]
    veiled_hits = sum(p in words or p in INSULTS for p in plain)
    size = max(len(text), 1)
    signs = len(PUNCTUATION.findall(text))
    capitals = sum(map(str.isupper, text.split()))
    return [np.log1p(n), fixed / n, np.log1p(fixed), len(weights) / n, np.log1p(len(weights)), max(weights, default=0.0),
            len(begun) / n, np.log1p(len(begun)), max((stems[b] for b in begun), default=0.0), near / n, capitals / n,
            signs / size, len(veiled) / n, np.log1p(veiled_hits)]


def tokens_of(text: str) -> tuple[set[str], set[str]]:
    """Distinct words and word beginnings of a text."""
    found = set(WORDS.findall(text.lower()))
    return found, {w[:s] for w in found for s in STEMS if len(w) >= s}


def learned_lexicon(sample: DataFrame, toxic: int, other: int) -> tuple[dict[str, float], dict[str, float]]:
    """Words and beginnings with a high ratio between toxic and other rows; counting is spread, the lexicon is bounded."""
    def count(batches):
        common.forget_worker_cache()
        totals: dict[tuple[bool, str], list[int]] = {}
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                for kind, some in enumerate(tokens_of(text)):
                    for t in some:
                        totals.setdefault((bool(kind), t), [0, 0])[label] += 1
        items = list(totals.items())
        for at in range(0, len(items), 50_000):
            part = items[at:at + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k, _ in part], pa.bool_()), pa.array([k[1] for k, _ in part], pa.string()),
                 pa.array([c[1] for _, c in part], pa.int64()), pa.array([c[0] for _, c in part], pa.int64())],
                names=["stem", "token", "toxic", "other"])

    ratio = F.log(((F.col("toxic") + 0.5) / (toxic + 1)) / ((F.col("other") + 0.5) / (other + 1)))
    rows = (sample.mapInArrow(count, "stem boolean, token string, toxic long, other long")
            .groupBy("stem", "token").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
            .filter(F.col("toxic") >= LEAST_ROWS).withColumn("weight", ratio)
            .filter(F.col("weight") >= float(np.log(LEAST_RATIO)))
            .orderBy(F.desc("toxic"), F.desc("weight"), "stem", "token").limit(MOST_WORDS).collect())
    return ({r.token: r.weight for r in rows if not r.stem}, {r.token: r.weight for r in rows if r.stem})


def fit(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> Model:
    """Fit on the bounded sample of learning rows; only their features reach the driver."""
    keys = (labels.filter("toxic is not null").filter(~common.in_test_fold("doc_id"))
            .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    totals = {r.toxic: r["count"] for r in keys.groupBy("toxic").count().collect()}
    sample = stage(common.bounded_sample(docs.select("doc_id", common.text_or_empty("text").alias("text")), keys, "toxic",
                                         per_label)
                   .withColumn("part", F.pmod(F.crc32(F.concat_ws(":", F.lit("part"), "doc_id").cast("binary")), F.lit(3))),
                   "labelled")
    fitted = sample.filter("part > 0")
    sizes = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    shares = {k: totals[k] / n for k, n in sizes.items()}
    if len(sizes) < 2:
        return Model({}, {}, float(1 in sizes), [], np.zeros(0), np.zeros(0))
    by_part = {(r.part > 0, r.toxic): r["count"] for r in sample.groupBy((F.col("part") > 0).cast("int").alias("part"),
                                                                       "toxic").count().collect()}
    words, stems = learned_lexicon(fitted, by_part.get((True, 1), 0), by_part.get((True, 0), 0))

    def measure(batches):
        common.forget_worker_cache()
        for batch in batches:
            x = [np.array(features(t, words, stems)).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), batch.column("part"),
                                              pa.array(x, pa.binary())], names=["doc_id", "toxic", "part", "x"])

    kind = f"doc_id {sample.schema['doc_id'].dataType.simpleString()}, toxic int, part bigint, x binary"
    rows = sorted(sample.mapInArrow(measure, kind).collect(), key=lambda r: (r.doc_id, bytes(r.x)))
    x = np.array([np.frombuffer(r.x) for r in rows])
    y = np.array([r.toxic for r in rows], float)
    weight = np.array([shares[r.toxic] for r in rows])
    learn = np.array([r.part > 0 for r in rows])
    if len(set(y[learn])) < 2 or len(set(y[~learn])) < 2:
        learn[:] = True
    start, trees = boosting.fit_trees(x[learn], y[learn], weight[learn] / weight[learn].mean())
    held = ~learn if (~learn).any() else learn
    at, probability = boosting.fit_isotonic(boosting.score_trees(x[held], start, trees), y[held], weight[held])
    return Model(words, stems, start, trees, at, probability)


def scorer(model: Model, spark: SparkSession):
    """A column function: text to score."""
    held = spark.sparkContext.broadcast(vars(model))

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        common.forget_worker_cache()
        m = Model(**held.value)
        return pa.array(np.concatenate([m.scores([t or "" for t in texts.slice(i, 512).to_pylist()])
                                        for i in range(0, max(len(texts), 1), 512)]), pa.float64())

    def on(text: Column | str) -> Column:
        return score(common.text_or_empty(text))

    return on


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Score all documents: doc_id, held_out, score, predicted."""
    docs = common.table(spark, folder, "documents")
    score = scorer(fit(docs, common.table(spark, folder, "labels")), spark)
    return (docs.select("doc_id", common.in_test_fold("doc_id").alias("held_out"), score("text").alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def toxicity_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that are not rejected, with all their columns."""
    score = scorer(fit(docs, common.table(spark, folder, "labels")), spark)
    return docs.withColumn("__score", score("text")).filter(F.col("__score") < 0.5).select(
        *[F.col(f"`{c}`") for c in docs.columns])
