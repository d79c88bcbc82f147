"""Operator 1: quality classifier by regularised quadratic discriminant analysis.

A text becomes a short vector of transformed document statistics (``FEATURES``). Each class
has a mean and a covariance, shrunk towards the pooled covariance (``pooled``) and then
towards a multiple of the identity (``ridge``), which keeps it invertible whatever the data.
The score is the posterior of class 1 from the difference of the two Gaussian log densities;
a density is a Mahalanobis distance by the class's Cholesky factor, factored once at the
fit, and its log determinant.

The fit needs sums, products and counts over the labelled rows only: one aggregation over
all of them, no sample.

Defined results: null and empty texts have the vector of an empty text and get its score;
without rows of one class the score is the other's share (0.5 without any); labels other
than 0 and 1 and null doc_ids teach nothing; several labels of a document all count; equal
texts get equal scores; an empty table gives no rows. Other columns pass through
``filter_quality`` unchanged.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tillcast.llm.common import bounded_broadcast, byte_chunks, held_out, table

SYMBOLS = np.frombuffer(b"#*$%&|<>@^~=+{}[]\\/_", dtype=np.uint8)
STOPS = np.frombuffer(b".,;:?", dtype=np.uint8)
FEATURES = ["log_words", "word_length", "symbols_per_word", "bangs_per_word", "stops_per_word", "digit_share", "upper_share",
            "distinct_words", "distinct_pairs", "top_word", "repeated_lines", "log_line_words", "short_words", "entropy"]
POOLED, RIDGE, PRIOR_WORDS = 0.05, 0.005, 10
#: The contract's fold and cut.
MOD, HELD_OUT, CUT = 5, 0, 0.3


def statistics(texts: list[bytes]) -> np.ndarray:
    """The transformed statistics of each text: shares on the scale of their square root,
    rates and counts as logarithms."""
    out = np.zeros((len(texts), len(FEATURES)))
    for i, text in enumerate(texts):
        words = text.split()
        n = len(words)
        if not n:
            continue
        by_byte = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
        size = len(text) - by_byte[9:14].sum() - by_byte[32]
        chars = size - by_byte[0x80:0xC0].sum()
        upper, lower = by_byte[65:91].sum(), by_byte[97:123].sum()
        seen: dict[bytes, int] = {}
        for w in words:
            seen[w] = seen.get(w, 0) + 1
        lines = [line for line in text.split(b"\n") if line.strip()]
        p = by_byte[by_byte > 0] / len(text)
        m = n + PRIOR_WORDS  # a few typical words are added, so that very short texts look typical
        out[i] = (np.log1p(n), np.log((chars + 5 * PRIOR_WORDS) / m), np.log(0.05 + by_byte[SYMBOLS].sum() / m),
                  np.log(0.05 + by_byte[33] / m), np.log(0.05 + (by_byte[STOPS].sum() + 0.15 * PRIOR_WORDS) / m),
                  np.sqrt(by_byte[48:58].sum() / (size + 5 * PRIOR_WORDS)),
                  np.sqrt((upper + 0.15 * PRIOR_WORDS) / (upper + lower + 5 * PRIOR_WORDS)), np.log((len(seen) + PRIOR_WORDS) / m) / np.log1p(m),
                  np.sqrt((n - 1 - len(set(zip(words, words[1:])))) / m), np.sqrt((max(seen.values()) - 1) / m),
                  np.sqrt((len(lines) - len(set(lines))) / (len(lines) + 1)), np.log(m / len(lines)),
                  np.sqrt(sum(map((1).__eq__, map(len, words))) / m), -(p * np.log(p)).sum() / np.log1p(min(len(text), 100)))
    return out


def features(text: Column) -> Column:
    @arrow_udf("array<double>")
    def measured(texts: pa.Array) -> pa.Array:
        rows = [r for _, chunk in byte_chunks(texts) for r in statistics(chunk)]
        return pa.array(rows, pa.list_(pa.float64()))

    return measured(text)


@dataclass
class Discriminant:
    """Class means, Cholesky factors of the shrunk covariances, their log determinants, and
    the log odds of class 1; without both classes only ``share``, the score of every text."""

    means: np.ndarray | None = None
    factors: np.ndarray | None = None
    log_dets: np.ndarray | None = None
    log_odds: float = 0.0
    scale: np.ndarray | None = None
    share: float | None = None

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.share is not None:
            return np.full(len(x), self.share)
        x = x / self.scale
        log_density = []
        for mean, factor, log_det in zip(self.means, self.factors, self.log_dets, strict=True):
            z = np.linalg.solve(factor, (x - mean).T)
            log_density.append(-0.5 * (z * z).sum(axis=0) - 0.5 * log_det)
        odds = log_density[1] - log_density[0] + self.log_odds
        return 1 / (1 + np.exp(-np.clip(odds, -700, 700)))


def shrunk(n: np.ndarray, sums: np.ndarray, products: np.ndarray, pooled: float, ridge: float) -> Discriminant:
    """The discriminant from the counts, sums and sums of products of classes 0 and 1."""
    if not n.all():
        return Discriminant(share=float(n[1] / n.sum()) if n.sum() else 0.5)
    total_mean = sums.sum(axis=0) / n.sum()
    scale = np.sqrt(np.maximum(np.diagonal(products.sum(axis=0)) / n.sum() - total_mean ** 2, 1e-9))
    sums, products = sums / scale, products / np.outer(scale, scale)
    means = sums / n[:, None]
    cov = np.array([products[k] / n[k] - np.outer(means[k], means[k]) for k in (0, 1)])
    common = (n[0] * cov[0] + n[1] * cov[1]) / n.sum()
    cov = (1 - pooled) * cov + pooled * common
    d = cov.shape[1]
    cov = np.array([(1 - ridge) * c + ridge * max(np.trace(c) / d, 1e-6) * np.eye(d) for c in cov])
    factors = np.linalg.cholesky(cov)
    log_dets = 2 * np.log(np.diagonal(factors, axis1=1, axis2=2)).sum(axis=1)
    return Discriminant(means, factors, log_dets, float(np.log(n[1] / n[0])), scale)


def fit(docs: DataFrame, labels: DataFrame, pooled: float = POOLED, ridge: float = RIDGE) -> Discriminant:
    """Learns from the labelled rows that are not held out."""
    known = labels.select("doc_id", F.col("quality").alias("label")).filter("doc_id is not null and label in (0, 1)")
    known = known.filter(~held_out(F.col("doc_id"), MOD, HELD_OUT))
    rows = docs.select("doc_id", "text").join(bounded_broadcast(known, known.count()), "doc_id")
    d = len(FEATURES)
    x = rows.select("label", features(F.col("text")).alias("x")).select("label", *[F.col("x")[i].alias(f"x{i}") for i in range(d)])
    upper = [(i, j) for i in range(d) for j in range(i, d)]
    sums = x.groupBy("label").agg(F.count("*"), *[F.sum(f"x{i}") for i in range(d)],
                                  *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")) for i, j in upper]).collect()
    n, first, second = np.zeros(2), np.zeros((2, d)), np.zeros((2, d, d))
    for row in sums:  # one row per class
        k, values = int(row[0]), np.array(row[1:], dtype=float)
        n[k], first[k] = values[0], values[1:d + 1]
        for (i, j), v in zip(upper, values[d + 1:], strict=True):
            second[k, i, j] = second[k, j, i] = v
    return shrunk(n, first, second, pooled, ridge)


def score(text: Column, model: Discriminant) -> Column:
    @arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        parts = [model.scores(statistics(chunk)) for _, chunk in byte_chunks(texts)]
        return pa.array(np.concatenate(parts) if parts else [], pa.float64())

    return scored(text)


def filter_quality(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """The rows of ``docs`` whose score is at least ``cut``, with their columns."""
    model = fit(docs, labels)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), score(F.col("text"), model).alias("__score"))
    return rows.filter(F.col("__score") >= cut).select("__row.*")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", held_out(F.col("doc_id"), MOD, HELD_OUT).alias("held_out"), score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= CUT).cast("int"))
