"""Operator 7: toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents (P) and unlabelled ones (U, of which a share ``prior`` is toxic
too) train a linear classifier in numpy by the risk estimator

    prior * R_P(+) + max(0, R_U(-) - prior * R_P(-))

with the logistic loss: the second term stands for the risk on clean text, which is never
observed alone, and is kept from falling below zero, where it would reward overfitting. Labels 0 serve only to
estimate ``prior``.

A text's features are its distinct lower-cased words (runs of letters), each hashed whole and
by its first 4 to 7 letters, so that unseen forms of a toxic stem count. The counts
of the features in use, scaled to length 1, are what the classifier sees.

Fitted on a bounded sample: the ``FIT_POSITIVE`` and ``FIT_UNLABELLED`` documents of least
hash among those of at most ``FIT_CHARS`` characters that are not held out. Scoring covers all
whole texts.

Defined results: null and empty texts, and those without letters, get the score of no words;
without positive examples every score is 0; labels other than 0 and 1 and null doc_ids teach
nothing; equal texts get equal scores; an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tillcast.llm.common import held_out, table
from tillcast.session import stage

FIT_POSITIVE, FIT_UNLABELLED, FIT_CHARS = 4_000, 12_000, 100_000
HASH_BITS, PREFIXES = 20, (4, 5, 6, 7)
LEAST_SHARE, LEAST_COUNT, LIFT, SURE = 0.02, 4, 3.0, 5.0
STEPS, RATE, DECAY = 400, 0.1, 0.0
#: The contract's fold and cut.
MOD, HELD_OUT, CUT = 3, 1, 0.7
CACHED_WORDS = 500_000
WORDS = re.compile(r"[^\W\d_]+")


def word_features(word: str) -> list[int]:
    keys = [word + "$"] + [word[:n] for n in PREFIXES if len(word) >= n]
    return [zlib.crc32(k.encode()) >> (32 - HASH_BITS) for k in keys]


def distinct_words(text: str | None) -> set[str]:
    return set(WORDS.findall((text or "").lower()))


def unit(features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features and their counts, scaled to length 1: one toxic word among many
    words weighs as much as ten."""
    index, count = np.unique(features, return_counts=True)
    return index, count / max(np.sqrt((count * count).sum()), 1e-12)


@dataclass
class Linear:
    """The weights of the features in use (``index`` has their place by hash, -1 for the
    others) and a bias; ``bias`` None means no positive example."""

    index: np.ndarray
    weights: np.ndarray
    bias: float | None

    def scores(self, texts: list[str | None], cache: dict[str, list[int]]) -> np.ndarray:
        if self.bias is None:
            return np.zeros(len(texts))
        logits = np.full(len(texts), self.bias)
        for i, text in enumerate(texts):
            words = distinct_words(text)
            new = words.difference(cache)
            if len(cache) + len(new) > CACHED_WORDS:
                cache.clear()
                new = words
            for w in new:
                cache[w] = [f for f in self.index[word_features(w)].tolist() if f >= 0]
            found = [f for own in map(cache.__getitem__, words) if own for f in own]
            if found:
                at, value = unit(np.array(found))
                logits[i] += self.weights[at] @ value
        return 1 / (1 + np.exp(-np.clip(logits, -500, 500)))


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> Linear:
    """Adam steps on the non-negative risk; each example is an array of feature hashes (with
    repeats). Only features of at least ``LEAST_SHARE`` of the positives that are more frequent
    there, by ``LIFT``, than among unlabelled examples are used: the counts of the others only
    add noise to long texts."""
    index = np.full(1 << HASH_BITS, -1, dtype=np.int32)
    if not positive:
        return Linear(index, np.zeros(0), None)
    share = []
    for side in (positive, unlabelled or positive):
        seen = np.zeros(1 << HASH_BITS)
        for x in side:
            seen[np.unique(x)] += 1
        share.append(seen / len(side))
    # How many standard deviations more often positives have it than unlabelled examples do.
    above = (share[0] - share[1]) / np.sqrt(np.maximum(share[1], 1 / len(unlabelled or positive)) / len(positive))
    often = share[0] * len(positive) >= max(LEAST_SHARE * len(positive), LEAST_COUNT)
    used = np.flatnonzero(often & (share[0] >= LIFT * share[1]) & (above >= SURE))
    index[used] = np.arange(len(used))
    rows = [[unit(y[y >= 0]) for y in (index[x] for x in side)] for side in (positive, unlabelled or positive)]
    flat = [np.concatenate([f for f, _ in x]) for x in rows]
    value = [np.concatenate([v for _, v in x]) for x in rows]
    owner = [np.repeat(np.arange(len(x)), [len(f) for f, _ in x]) for x in rows]
    w, b = np.zeros(len(used)), np.log(prior / (1 - prior))
    m, v = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    for step in range(1, STEPS + 1):
        z = [b + np.bincount(o, weights=w[f] * c, minlength=len(x)) for x, f, c, o in zip(rows, flat, value, owner, strict=True)]
        toxic = [1 / (1 + np.exp(-np.clip(s, -500, 500))) for s in z]
        # Logistic losses: log(1 + e^-z) for calling it clean, log(1 + e^z) for calling it toxic.
        clean_risk = np.logaddexp(0, z[1]).mean() - prior * np.logaddexp(0, z[0]).mean()
        clean = float(clean_risk > 0)  # at zero the second term of the risk is flat
        g = [prior * (toxic[0] - 1 - clean * toxic[0]) / len(z[0]), clean * toxic[1] / len(z[1])]
        grad = np.zeros(len(used) + 1)
        for f, c, o, gi in zip(flat, value, owner, g, strict=True):
            grad[:-1] += np.bincount(f, weights=gi[o] * c, minlength=len(used))
            grad[-1] += gi.sum()
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        move = RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        w, b = w - move[:-1] - RATE * DECAY * w, b - move[-1]
    return Linear(index, w, float(b))


def examples(docs: DataFrame) -> DataFrame:
    """(toxic, features): the feature hashes of each text's distinct words, as packed 32-bit
    integers (the driver's fit holds the whole bounded sample)."""
    schema = pa.schema([("toxic", pa.int32()), ("features", pa.binary())])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [np.array([f for w in sorted(distinct_words(t.as_py())) for f in word_features(w)], dtype=np.int32).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], schema=schema)

    return docs.select("toxic", "text").mapInArrow(hashed, "toxic int, features binary")


def fit(docs: DataFrame, labels: DataFrame, prior: float | None = None) -> Linear:
    learn = ~held_out(F.col("doc_id"), MOD, HELD_OUT)
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter(learn & F.col("toxic").isin(0, 1))
    if prior is None:
        prior = known.agg(F.avg("toxic")).first()[0] or 0.0
    prior = min(max(prior, 1e-3), 0.5)
    # One text per id, so the sample's bound holds whatever repeats; long texts teach only where
    # there are not enough others.
    ids = docs.select("doc_id", F.struct(F.char_length("text").alias("n"), F.xxhash64("text").alias("mark")).alias("t"))
    ids = ids.filter(learn & F.col("doc_id").isNotNull() & F.col("t.n").isNotNull()).groupBy("doc_id").agg(F.min("t").alias("t")).select("doc_id", "t.*")
    order = [F.col("n") > FIT_CHARS, F.xxhash64("doc_id"), F.col("doc_id")]
    unlabelled = ids.orderBy(*order).limit(FIT_UNLABELLED).withColumn("toxic", F.lit(0))
    positive = (ids.join(known.filter("toxic = 1").select("doc_id").distinct(), "doc_id")
                .orderBy(*order).limit(FIT_POSITIVE).withColumn("toxic", F.lit(1)))
    chosen = stage(unlabelled.unionAll(positive), "chosen")  # at most FIT_UNLABELLED + FIT_POSITIVE rows
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("mark")).join(F.broadcast(chosen.drop("n")), ["doc_id", "mark"])
    texts = texts.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))  # repeated rows
    rows = sorted((toxic, bytes(x)) for toxic, x in examples(texts).collect())
    side = [[np.frombuffer(x, dtype=np.int32) for toxic, x in rows if toxic == k] for k in (1, 0)]
    return train(side[0], side[1], prior)


_CACHES: dict[str, dict[str, list[int]]] = {}


def score(text: Column, model: Linear) -> Column:
    name = f"{zlib.crc32(model.weights.tobytes()):x}/{model.bias}"

    @arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        if name not in _CACHES:
            _CACHES.clear()
        return pa.array(model.scores(texts.to_pylist(), _CACHES.setdefault(name, {})), pa.float64())

    return scored(text)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", held_out(F.col("doc_id"), MOD, HELD_OUT).alias("held_out"), score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= CUT).cast("int"))
