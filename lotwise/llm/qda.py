"""Regularised quadratic discriminant over transformed document statistics.

Each class is a normal distribution. Its covariance is shrunk towards the pooled one and
then towards a multiple of the identity, so that few labels or constant statistics still
give a factor. Scores compare the Mahalanobis log-densities; the Cholesky factors are
computed once, when the model is fitted.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import bound_batches, extended, texts

STATISTICS = (
    "words",
    "word_length",
    "word_spread",
    "upper",
    "digits",
    "stops",
    "marks",
    "bars",
    "newlines",
    "wide",
    "distinct_words",
    "distinct_lines",
    "line_length",
    "longest_word",
    "short_words",
)


def _statistics(text: str) -> list[float]:
    """Shares are square-rooted and sizes are logarithms, which brings both near a normal shape."""
    data = text.encode()
    if not data:
        return [0.0] * len(STATISTICS)
    count = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    size = len(data)
    words = text.split()
    lengths = np.fromiter(map(len, words), float, len(words)) if words else np.zeros(1)
    lines = text.split("\n")
    letters = int(count[65:91].sum() + count[97:123].sum() + count[128:].sum())
    stops = int(count[[44, 46]].sum())
    graph = int(count[33:127].sum())
    marks = graph - letters + int(count[128:].sum()) - int(count[48:58].sum()) - stops - int(count[124])

    def share(part: float, whole: float) -> float:
        return float(np.sqrt(max(part, 0) / whole)) if whole else 0.0

    return [
        float(np.log1p(len(words))),
        float(np.log1p(lengths.mean())),
        float(np.log1p(lengths.std())),
        share(int(count[65:91].sum()), letters),
        share(int(count[48:58].sum()), size),
        share(stops, len(words)),
        share(marks, size),
        share(int(count[124]), size),
        share(int(count[10]), size),
        share(int(count[128:].sum()), size),
        share(len(set(words)), len(words)),
        share(len(set(lines)), len(lines)),
        float(np.log1p(size / len(lines))),
        float(np.log1p(lengths.max())),
        share(int((lengths <= 3).sum()), len(words)),
    ]


def statistics(docs: DataFrame, keys: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keys`` and ``x array<double>``, one number for each name in ``STATISTICS``.

    A null text counts as empty; an empty text has zeros. One row for each input row.
    """
    source = bound_batches(docs).select(*keys, F.col(text).alias("_text") if text in keys else text)
    name = source.columns[-1]
    schema = extended(source.select(*keys), "x array<double>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_statistics(value) for value in texts(batch.column(name))]
            arrays = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(rows, pa.list_(pa.float64()))], schema.names)

    return source.mapInArrow(run, schema)


@dataclass(frozen=True)
class Model:
    """Two classes: means, inverse Cholesky factors, log-determinants and the prior's log-odds."""

    means: np.ndarray
    whiten: np.ndarray
    log_dets: np.ndarray
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each row of ``x``."""
        density = []
        for k in (0, 1):
            z = (x - self.means[k]) @ self.whiten[k].T
            density.append(-0.5 * (np.einsum("ij,ij->i", z, z) + self.log_dets[k]))
        odds = np.clip(density[1] - density[0] + self.prior, -700.0, 700.0)
        return 1.0 / (1.0 + np.exp(-odds))


def _moments(labelled: DataFrame, label: str) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Count, sum and outer-product sum of ``x`` for each label, added up by Spark."""
    size = len(STATISTICS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 + size + size * size))
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, size)
            y = batch.column(label).to_numpy(zero_copy_only=False)
            for k in (0, 1):
                own = x[y == k]
                total[k] += np.concatenate([[len(own)], own.sum(0), (own.T @ own).ravel()])
        place = np.arange(total.shape[1])
        for k in (0, 1):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(place), k)), pa.array(place), pa.array(total[k])], ["k", "place", "value"]
            )

    parts = labelled.select("x", label).mapInArrow(run, "k long, place long, value double")
    sums = np.zeros((2, 1 + size + size * size))
    # 2 * (1 + d + d * d) rows, however many documents there are
    for row in parts.groupBy("k", "place").agg(F.sum("value").alias("value")).collect():
        sums[row.k, row.place] = row.value
    return {k: (sums[k, 0], sums[k, 1 : 1 + size], sums[k, 1 + size :].reshape(size, size)) for k in (0, 1)}


def fit(labelled: DataFrame, label: str, shrink: float = 0.2, ridge: float = 0.02) -> Model:
    """Fit on all rows of ``labelled`` (columns ``x`` and ``label``; labels other than 0 and 1 are left out).

    ``shrink`` moves class covariances to the pooled one, ``ridge`` to its mean variance.
    A class without rows gets the pooled moments, so that its prior alone decides.
    """
    size = len(STATISTICS)
    moments = _moments(labelled.where(F.col(label).isin(0, 1)), label)
    count = np.array([moments[k][0] for k in (0, 1)])
    whole = max(count.sum(), 1.0)
    overall = (moments[0][1] + moments[1][1]) / whole
    means = np.array([moments[k][1] / count[k] if count[k] else overall for k in (0, 1)])
    scatter = [moments[k][2] - count[k] * np.outer(means[k], means[k]) for k in (0, 1)]
    pooled = (scatter[0] + scatter[1]) / whole
    whiten, log_dets = [], []
    for k in (0, 1):
        own = scatter[k] / count[k] if count[k] else pooled
        shrunk = (1 - shrink) * own + shrink * pooled
        level = max(np.trace(pooled) / size, 1e-6)
        shrunk = (1 - ridge) * shrunk + ridge * level * np.eye(size)
        factor = np.linalg.cholesky(shrunk)
        whiten.append(np.linalg.inv(factor))
        log_dets.append(2 * np.log(np.diag(factor)).sum())
    prior = float(np.log((count[1] + 1) / (count[0] + 1)))
    return Model(means, np.array(whiten), np.array(log_dets), prior)


def score(stats: DataFrame, model: Model) -> DataFrame:
    """Replace ``x`` (and a column ``score``) by ``score double``, the probability of label 1."""
    kept = [c for c in stats.columns if c not in ("x", "score")]
    schema = extended(stats.select(*kept), "score double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)
            scores = model.score(x) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(scores)], [*kept, "score"])

    return stats.select(*kept, "x").mapInArrow(run, schema)


def predicted(score_column: Column, threshold: float = 0.5) -> Column:
    return (score_column >= threshold).cast("int")
