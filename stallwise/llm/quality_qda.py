"""Quality as the difference of two Gaussian log densities over transformed document statistics.

The class moments are sums that Spark adds up over all labelled rows. Each class covariance is shrunk
towards the pooled variances and its Cholesky factor kept; a score is the difference of the two log
densities, from Mahalanobis distances by triangular solves.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallwise.llm.arrow import free_name, with_python
from stallwise.llm.stats import FEATURES, describe, described, held_out, labelled
from stallwise.sources.scratch import materialized

SHRINKAGE = 0.2
#: Rates are taken as logarithms above this floor, so that "none" and "few" stay apart but finite.
FLOOR = 2e-3
PLAIN = ("log_words", "word_length", "line_words", "distinct_rate")


def transformed(rows: np.ndarray) -> np.ndarray:
    x = np.asarray(rows, float).reshape(-1, len(FEATURES)).copy()
    rates = [k for k, name in enumerate(FEATURES) if name not in PLAIN]
    x[:, rates] = np.log(x[:, rates] + FLOOR)
    x[:, FEATURES.index("word_length")] = np.log1p(x[:, FEATURES.index("word_length")])
    return x


@dataclass(frozen=True)
class Quadratic:
    """Means, Cholesky factors, log determinants and log prior odds of the classes 0 and 1."""

    means: np.ndarray
    factors: np.ndarray
    log_dets: np.ndarray
    prior: float

    def difference(self, rows: np.ndarray) -> np.ndarray:
        """Log density of class 1 less that of class 0, with the prior odds, per row."""
        x = transformed(rows)
        density = []
        for mean, factor, log_det in zip(self.means, self.factors, self.log_dets, strict=True):
            y = np.linalg.solve(factor, (x - mean).T)
            density.append(-0.5 * (y**2).sum(axis=0) - 0.5 * log_det)
        return density[1] - density[0] + self.prior

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Between 0 and 1, 0.5 at equal odds; rises with the difference and never saturates."""
        d = self.difference(rows)
        return np.where(d >= 0, 1 + np.abs(d), 1) / (2 + np.abs(d))


def moments(known: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Count, sum and sum of outer products of the transformed features per label.

    Tasks add up their rows first; what reaches the driver is one number per moment and label.
    """
    p = len(FEATURES)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {k: np.zeros(1 + p + p * p) for k in (0, 1)}
        for batch in batches:
            label = np.array(batch.column(0).to_pylist(), int)
            if len(label):
                x = transformed(np.array(batch.column(1).to_pylist(), float))
                for k, total in sums.items():
                    mine = x[label == k]
                    total += np.concatenate([[len(mine)], mine.sum(axis=0), (mine.T @ mine).ravel()])
        yield pa.RecordBatch.from_pydict(
            {
                "label": np.repeat([0, 1], 1 + p + p * p),
                "place": np.tile(np.arange(1 + p + p * p), 2),
                "total": np.concatenate([sums[0], sums[1]]),
            }
        )

    added = known.select("label", "features").mapInArrow(partial, "label bigint, place bigint, total double")
    out = {k: np.zeros(1 + p + p * p) for k in (0, 1)}
    for row in added.groupBy("label", "place").agg(F.sum("total").alias("total")).collect():
        out[row["label"]][row["place"]] = row["total"]
    return {k: (v[0], v[1 : 1 + p], v[1 + p :].reshape(p, p)) for k, v in out.items()}


def fitted(known: DataFrame, shrinkage: float = SHRINKAGE) -> Quadratic | None:
    """Fit to rows of (label, features); None unless both labels occur."""
    found = moments(known)
    if min(n for n, _, _ in found.values()) < 1:
        return None
    p = len(FEATURES)
    total = sum(n for n, _, _ in found.values())
    within = sum(outer - np.outer(s, s) / n for n, s, outer in found.values()) / total
    pooled = np.diag(np.maximum(np.diag(within), 1e-4))
    means, factors, log_dets = [], [], []
    for k in (0, 1):
        n, s, outer = found[k]
        own = outer / n - np.outer(s / n, s / n)
        weight = min(1.0, shrinkage + p / n)  # few rows: closer to the pooled variances
        factor = np.linalg.cholesky((1 - weight) * own + weight * pooled)
        means.append(s / n)
        factors.append(factor)
        log_dets.append(2 * np.log(np.diag(factor)).sum())
    return Quadratic(np.array(means), np.array(factors), np.array(log_dets), float(np.log(found[1][0] / found[0][0])))


def scored(model: Quadratic | None, features: np.ndarray) -> np.ndarray:
    return np.full(len(features), 0.5) if model is None else model.score(features)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of each row of ``docs``.

    Labels are read only of ids that are not held out. NULL and empty texts have all statistics 0 and
    are scored like any other; repeated rows get the same score; without labels of both classes every
    score is 0.5. Other columns, whatever their names, play no part.
    """
    d = materialized(described(docs, ["doc_id"]))
    model = fitted(labelled(d, labels))

    def make():
        return lambda rows: ((float(s),) for s in scored(model, np.array(rows, float).reshape(len(rows), -1)))

    out = with_python(d.select("doc_id", "__features"), ["__features"], "score double", make, drop=["__features"])
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def kept_by_quality(docs: DataFrame, labels: DataFrame, at_least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` scored ``at_least``, with all their columns."""
    model = fitted(labelled(described(docs, ["doc_id"]), labels))
    name = free_name(docs, "__score")

    def make():
        def each(texts):
            features = [describe(t)[1] for t in texts]
            return ((float(s),) for s in scored(model, np.array(features, float).reshape(len(features), -1)))

        return each

    return with_python(docs, ["text"], f"`{name}` double", make).filter(F.col(name) >= at_least).drop(name)
