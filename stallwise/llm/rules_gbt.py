"""Quality rules: boosted regression trees over document statistics.

The trees are grown on a bounded sample of labelled rows with second-order logistic loss over binned
features. Chosen features are monotonic: a split whose leaves would run against the wanted direction
is not taken, and children keep within the bounds that ancestors set. All trees lie in flat numpy
arrays of nodes, and a batch of rows walks down a tree together.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallwise.llm.arrow import with_python
from stallwise.llm.stats import COUNTS, FEATURES, described, labelled
from stallwise.sources.scratch import materialized

#: Most labelled rows that the trees are grown on; more are cut to those of the least id hashes.
TRAINING_ROWS = 20_000
#: The bound on hashes is set so that this many times the wanted rows are expected below it.
SLACK = 1.1
TREES, DEPTH, RATE, BINS, LEAST_HESSIAN, RIDGE = 80, 3, 0.15, 48, 4.0, 1.0
#: More of these never makes a document better.
FALLING = ("symbol_rate", "dup_line_rate", "repeat_rate", "shout_rate", "bar_rate", "echo_rate")


@dataclass(frozen=True)
class Trees:
    """Node arrays of all trees; a leaf points at itself."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    start: float

    def odds(self, rows: np.ndarray) -> np.ndarray:
        x = np.asarray(rows, float).reshape(-1, len(FEATURES))
        total = np.full(len(x), self.start)
        every = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(DEPTH):
                low = x[every, self.feature[node]] <= self.threshold[node]
                node = np.where(low, self.left[node], self.right[node])
            total += self.value[node]
        return total


def grown(x: np.ndarray, y: np.ndarray) -> Trees | None:
    """Fit to feature rows and 0/1 labels; None unless both labels occur."""
    if len(np.unique(y)) < 2:
        return None
    cuts = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in x.T]
    bins = np.stack([np.searchsorted(c, column, side="left") for c, column in zip(cuts, x.T, strict=True)], axis=1)
    direction = np.array([-1 if name in FALLING else 0 for name in FEATURES])
    nodes: list[list[float]] = []  # feature, threshold, left, right, value
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(mean / (1 - mean)))
    odds = np.full(len(y), start)

    def weight(g: float, h: float, low: float, high: float) -> float:
        return float(np.clip(-g / (h + RIDGE), low, high))

    def gain(g, h, v):
        return -(g * v + 0.5 * (h + RIDGE) * v * v)

    def split(rows: np.ndarray, g: np.ndarray, h: np.ndarray, low: float, high: float):
        best = (1e-6, None)
        all_g, all_h = g[rows].sum(), h[rows].sum()
        base = gain(all_g, all_h, weight(all_g, all_h, low, high))
        for f in range(x.shape[1]):
            if not len(cuts[f]):
                continue
            sums_g = np.cumsum(np.bincount(bins[rows, f], g[rows], len(cuts[f]) + 1))[:-1]
            sums_h = np.cumsum(np.bincount(bins[rows, f], h[rows], len(cuts[f]) + 1))[:-1]
            left = np.clip(-sums_g / (sums_h + RIDGE), low, high)
            right = np.clip(-(all_g - sums_g) / (all_h - sums_h + RIDGE), low, high)
            won = gain(sums_g, sums_h, left) + gain(all_g - sums_g, all_h - sums_h, right) - base
            fits = (sums_h >= LEAST_HESSIAN) & (all_h - sums_h >= LEAST_HESSIAN) & (direction[f] * (right - left) >= 0)
            won = np.where(fits, won, -np.inf)
            k = int(np.argmax(won))
            if won[k] > best[0]:
                best = (won[k], (f, k, left[k], right[k]))
        return best[1]

    def grow(rows: np.ndarray, g, h, depth: int, low: float, high: float) -> int:
        me = len(nodes)
        nodes.append([0, 0.0, me, me, RATE * weight(g[rows].sum(), h[rows].sum(), low, high)])
        found = split(rows, g, h, low, high) if depth < DEPTH else None
        if found:
            f, k, a, b = found
            below = bins[rows, f] <= k
            bounds = (low, high), (low, high)
            if direction[f]:
                middle = (a + b) / 2
                bounds = ((middle, high), (low, middle)) if direction[f] < 0 else ((low, middle), (middle, high))
            nodes[me][:4] = [f, cuts[f][k], grow(rows[below], g, h, depth + 1, *bounds[0]), grow(rows[~below], g, h, depth + 1, *bounds[1])]
        return me

    roots = []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-odds))
        first = len(nodes)
        roots.append(grow(np.arange(len(y)), p - y, np.maximum(p * (1 - p), 1e-6), 0, -np.inf, np.inf))
        tree = Trees(np.array([0]), *(np.array(c) for c in _columns(nodes[first:], first)), 0.0)
        odds = odds + tree.odds(x)
    return Trees(np.array(roots), *(np.array(c) for c in _columns(nodes, 0)), start)


def _columns(nodes: list[list[float]], first: int):
    f, t, left, right, v = zip(*nodes, strict=True)
    yield [int(k) for k in f]
    yield list(t)
    yield [int(k) - first for k in left]
    yield [int(k) - first for k in right]
    yield list(v)


def sampled(known: DataFrame, limit: int) -> DataFrame:
    """(label, features) of at most ``limit`` rows of the least id hashes.

    Hashes are uniform, so those beyond a bound set by the number of rows are left behind first: all tasks
    together offer little more than ``limit`` rows to the driver, however many they are.
    """
    share = SLACK * limit / max(1, known.count())
    place = F.xxhash64("doc_id")
    near = known.filter(place < int(share * 2**64) - 2**63) if share < 1 else known
    return near.orderBy(place, "doc_id", "label").limit(limit).select("label", "features")


def trained(known: DataFrame, limit: int = TRAINING_ROWS) -> Trees | None:
    """Trees from at most ``limit`` labelled rows, those of the least hashes of their ids."""
    rows = sampled(known, limit).collect()
    if not rows:
        return None
    return grown(np.array([r["features"] for r in rows], float), np.array([r["label"] for r in rows], float))


def quality_rules(docs: DataFrame, labels: DataFrame, limit: int = TRAINING_ROWS) -> DataFrame:
    """doc_id, the base counts, base_failed and kept of each row of ``docs``.

    A document fails the base rule with under 20 words or with over 30 % of its words in repeated
    windows of eight; one that does not is kept if the trees give its statistics even odds at least.
    NULL and empty texts have no words and fail. Without labels of both classes the base rule alone
    decides. Repeated rows get the same verdict; columns of other names play no part.
    """
    d = materialized(described(docs, ["doc_id"]))
    trees = trained(labelled(d, labels), limit)

    def make():
        def each(rows):
            odds = trees.odds(np.array(rows, float)) if trees and len(rows) else np.zeros(len(rows))
            return ((float(o),) for o in odds)

        return each

    out = with_python(d, ["__features"], "odds double", make, drop=["__features"])
    counts = [F.col("__counts")[k].alias(name) for k, name in enumerate(COUNTS)]
    out = out.select("doc_id", *counts, "odds")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return out.select("doc_id", *COUNTS, failed.alias("base_failed"), (~failed & (F.col("odds") >= 0)).alias("kept"), "odds")
