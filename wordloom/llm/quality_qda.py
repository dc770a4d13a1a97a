"""Quality classifier: regularised quadratic discriminant over document statistics.

Counts of a text become a few ratios, transformed so that they are roughly normal. Each class
has its mean and a covariance shrunk towards the pooled one and towards a sphere. A score is
the posterior from the difference of the log densities: half the Mahalanobis distances by the
cached Cholesky factors, and the log determinants. Training is one aggregate of sums and
products, two rows whatever the number of labels.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm.tables import held_out
from wordloom.llm.text_stats import with_text_stats
from wordloom.session import staged

#: Shrinkage towards the pooled covariance and towards a sphere; a score from which on a text is good.
POOLED, SPHERE = 0.05, 0.02
PREDICT = 0.3
#: Log densities further apart than this count as this far apart.
FURTHEST = 30.0


def _ratio(a: str, b: str) -> Column:
    return F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0)).cast("double")


def features() -> dict[str, Column]:
    """Transformed statistics, over the columns of ``with_text_stats``."""
    return {
        "size": F.log1p(F.col("n_words").cast("double")),
        "word_length": F.log1p(_ratio("word_chars", "n_words")),
        "symbols": F.log1p(20 * _ratio("n_symbols", "n_words")),
        "capitals": F.sqrt(_ratio("n_upper", "word_chars")),
        "marks": F.log1p(20 * _ratio("n_marks", "n_words")),
        "repeats": F.sqrt(_ratio("n_repeat_words", "n_words")),
        "lines": F.sqrt(_ratio("n_dup_lines", "n_lines")),
        "variety": F.log1p(_ratio("n_distinct", "n_words")) + 0.1 * F.log1p(F.col("n_words").cast("double")),
    }


@dataclass(frozen=True)
class ClassDensity:
    """Log prior, mean, inverse of the Cholesky factor, and log determinant of a class."""

    log_prior: float
    mean: np.ndarray
    whiten: np.ndarray
    log_det: float

    def log_density(self, x: np.ndarray) -> np.ndarray:
        return self.log_prior - 0.5 * (((x - self.mean) @ self.whiten.T) ** 2).sum(axis=1) - 0.5 * self.log_det


@dataclass(frozen=True)
class QualityModel:
    """Densities of the bad and the good class, over features divided by ``scale``."""

    scale: np.ndarray
    classes: tuple[ClassDensity, ClassDensity]

    def score(self, x: np.ndarray) -> np.ndarray:
        """Posterior probability of good."""
        x = x / self.scale
        apart = self.classes[1].log_density(x) - self.classes[0].log_density(x)
        return 1.0 / (1.0 + np.exp(-np.clip(apart, -FURTHEST, FURTHEST)))


def fit_discriminant(sums: dict[int, tuple[float, np.ndarray, np.ndarray]], width: int) -> QualityModel:
    """The model from each class's count, sums and sums of products.

    A class without rows takes the pooled mean and covariance, so that the priors decide alone.
    """
    nothing = (0.0, np.zeros(width), np.zeros((width, width)))
    parts = [sums.get(c, nothing) for c in (0, 1)]
    total = sum(p[0] for p in parts)
    mean_all = sum(p[1] for p in parts) / max(total, 1.0)
    means = [p[1] / p[0] if p[0] else mean_all for p in parts]
    scatter = [p[2] - p[0] * np.outer(m, m) for p, m in zip(parts, means)]
    pooled = sum(scatter) / max(total, 1.0)
    scale = np.sqrt(np.maximum(np.diag(pooled), 1e-6))
    pooled = pooled / np.outer(scale, scale)
    classes = []
    for (n, _, _), m, s in zip(parts, means, scatter):
        own = s / np.outer(scale, scale) / n if n else pooled
        shrunk = (1 - POOLED) * own + POOLED * pooled
        shrunk = (1 - SPHERE) * shrunk + SPHERE * max(np.trace(shrunk) / width, 1e-3) * np.eye(width)
        factor = np.linalg.cholesky(shrunk)
        classes.append(ClassDensity(
            float(np.log((n + 1) / (total + 2))), m / scale, np.linalg.solve(factor, np.eye(width)),
            float(2 * np.log(np.diag(factor)).sum()),
        ))
    return QualityModel(scale, (classes[0], classes[1]))


def document_features(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and a column for each feature; a null text counts as empty."""
    stats = with_text_stats(docs, key, text)
    return stats.select("doc_id", *[c.alias(k) for k, c in features().items()])


def fit_quality(described: DataFrame, labels: DataFrame) -> QualityModel:
    """A model from the labels 0 and 1 that may be learned from; null labels teach nothing."""
    names = list(features())
    known = labels.where(~held_out(F.col("doc_id")) & F.col("quality").isin(0, 1)).select("doc_id", "quality")
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    rows = (
        described.join(known, "doc_id").groupBy("quality").agg(
            F.count(F.lit(1)).alias("n"), *[F.sum(a).alias(f"s_{a}") for a in names],
            *[F.sum(F.col(names[i]) * F.col(names[j])).alias(f"p_{i}_{j}") for i, j in pairs],
        ).collect()
    )
    sums = {}
    for r in rows:
        products = np.zeros((len(names), len(names)))
        for i, j in pairs:
            products[i, j] = products[j, i] = r[f"p_{i}_{j}"]
        sums[r["quality"]] = (float(r["n"]), np.array([r[f"s_{a}"] for a in names]), products)
    return fit_discriminant(sums, len(names))


def score_quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``.

    The texts are read once: their features are stored, and labels meet those. A null or empty
    text is scored by its zero counts. Repeated rows are scored alike and each stays a row; an
    empty table gives none; other columns are not read.
    """
    described = staged(document_features(docs, key, text), "features")
    model, names = fit_quality(described, labels), list(features())

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[["doc_id"]].assign(score=model.score(batch[names].to_numpy(float)))

    kind = described.schema["doc_id"].dataType.simpleString()
    scored = described.mapInPandas(score, f"doc_id {kind}, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= PREDICT).cast("int").alias("predicted"))
