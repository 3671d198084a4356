"""Operator 5, quality classifier: regularised quadratic discriminant analysis.

Transformed statistics of a text are taken to be Gaussian within each class.
Means and covariances come from sums over all labelled training rows, added up
by Spark; each covariance is shrunk to the pooled one and to a sphere.  A score
is the logistic of the difference of both log densities, with Mahalanobis
distances from Cholesky factors that are computed once.

Defined cases: a null text counts as empty and is scored; rows with a null
doc_id are held out; a null quality is no label; without labels of both classes
every score is the smoothed share of class 1; repeated rows are scored one by
one; columns beside (doc_id, text) and (doc_id, quality) are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.language_id import held_out
from corpusmill.llm.text import whole
from corpusmill.session import materialize

#: weight of the pooled covariance, and of the sphere in it
SHRINK_TO_POOLED, SHRINK_TO_SPHERE = 0.1, 0.05
THRESHOLD = 0.3
SYMBOL_BYTES = b"#*$%&|<>"
FEATURES = (
    "log_words", "log_word_length", "symbol_share", "capital_share", "digit_share", "mark_share",
    "variety", "repeated_lines", "log_line_words", "short_words",
)


def text_statistics(text: str) -> list[float]:
    """The features of one text; shares go through a square root, sizes through a logarithm."""
    raw = text.encode()
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.strip()]
    n, letters = max(1, len(words)), max(1, int(counts.sum() - counts[[9, 10, 11, 12, 13, 32]].sum()))
    symbols, digits = counts[list(SYMBOL_BYTES)].sum(), counts[48:58].sum()
    marks = counts[33:48].sum() + counts[58:65].sum() + counts[91:97].sum() + counts[123:127].sum() - symbols
    return [
        np.log1p(len(words)), np.log(letters / n), np.sqrt(symbols / letters), np.sqrt(counts[65:91].sum() / letters),
        np.sqrt(digits / letters), np.sqrt(marks / letters), np.log1p(len(set(words))) / np.log1p(n),
        np.sqrt(1 - len(set(lines)) / max(1, len(lines))), np.log(n / max(1, len(lines))),
        np.sqrt(sum(len(w) <= 3 for w in words) / n),
    ]


def statistics():
    """Column function: the features of a non-null text."""

    @F.pandas_udf("array<double>")
    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([text_statistics(text) for text in texts])

    return measure


@dataclass
class Discriminant:
    """Means and inverse Cholesky factors by class, or only the constant score."""

    prior: float
    means: np.ndarray | None = None
    factors: np.ndarray | None = None
    log_dets: np.ndarray | None = None

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.means is None:
            return np.full(len(x), self.prior)
        density = [
            -0.5 * (((x - m) @ f.T) ** 2).sum(axis=1) - 0.5 * d for m, f, d in zip(self.means, self.factors, self.log_dets)
        ]
        odds = density[1] - density[0] + np.log(self.prior / (1 - self.prior))
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def class_sums(rows: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Per class of rows (quality, x): number, sum and sum of products, added up by Spark."""
    k = len(FEATURES)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    x = [F.col("x")[i] for i in range(k)]
    sums = rows.groupBy("quality").agg(
        F.count("*").alias("n"),
        F.array(*[F.sum(c) for c in x]).alias("s"), F.array(*[F.sum(x[i] * x[j]) for i, j in pairs]).alias("p"),
    )
    out = {}
    for row in sums.collect():
        products = np.zeros((k, k))
        for (i, j), v in zip(pairs, row["p"]):
            products[i, j] = products[j, i] = v
        out[row["quality"]] = (row["n"], np.array(row["s"]), products)
    return out


def fit(sums: dict[int, tuple[float, np.ndarray, np.ndarray]]) -> Discriminant:
    n = [sums.get(c, (0,))[0] for c in (0, 1)]
    prior = (n[1] + 1) / (n[0] + n[1] + 2)
    if min(n) < 2:
        return Discriminant(prior)
    means = np.array([sums[c][1] / n[c] for c in (0, 1)])
    scatter = [sums[c][2] - n[c] * np.outer(means[c], means[c]) for c in (0, 1)]
    pooled = (scatter[0] + scatter[1]) / (n[0] + n[1])
    spread = np.diag(np.maximum(np.diag(pooled), 1e-8))
    target = (1 - SHRINK_TO_SPHERE) * pooled + SHRINK_TO_SPHERE * spread + 1e-8 * np.eye(len(FEATURES))
    covariances = [(1 - SHRINK_TO_POOLED) * scatter[c] / n[c] + SHRINK_TO_POOLED * target for c in (0, 1)]
    lower = [np.linalg.cholesky(c) for c in covariances]
    return Discriminant(
        prior, means, np.array([np.linalg.inv(c) for c in lower]), np.array([2 * np.log(np.diag(c)).sum() for c in lower])
    )


def score_column(model: Discriminant):
    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        return pd.Series(model.scores(np.array(x.tolist())) if len(x) else [], dtype="float64")

    return score


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows (doc_id, held_out, score, predicted), one per document; texts are read once."""
    measured = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), statistics()(whole(F.col("text"))).alias("x"))
    measured = materialize(measured, "statistics")
    known = labels.where(F.col("quality").isNotNull()).select("doc_id", "quality")
    model = fit(class_sums(measured.where(~F.col("held_out")).join(known, "doc_id").select("quality", "x")))
    scored = measured.withColumn("score", score_column(model)("x"))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
