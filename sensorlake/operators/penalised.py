"""Two-class logistic regression at many penalties, fitted together.

The objective is that of Spark's ``LogisticRegression``: mean loss over the rows, plus L1 and L2 penalties of the
coefficients of standardised features; the intercept is free. Spark's own fit reads all rows for every try of every
point, up to thousands of times where features are alike. Here a pass reads the rows once for all points. Its tasks
sum losses, slopes and curvatures (a few hundred numbers a point), and the driver solves each point's next Newton
step exactly. Steps end when the quadratic promises no more than a thousandth of the estimator's ``tol``.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Partial sums that the driver takes at once; those of more tasks are added by other tasks first.
MOST_SUMS = 64
# Settings that the steps know. A caller with others takes Spark's own fit.
SETTINGS = {"featuresCol", "labelCol", "predictionCol", "probabilityCol", "rawPredictionCol",
            "maxIter", "tol", "regParam", "elasticNetParam"}


def applies(estimator, grid: Sequence[dict]) -> bool:
    """Whether all points of the grid can be fitted here."""
    given = {p.name for p in estimator.params if estimator.isSet(p)} | {p.name for point in grid for p in point}
    return isinstance(estimator, LogisticRegression) and given <= SETTINGS


def _summed(rows: DataFrame, part: Callable, shape: tuple[int, ...], tasks: int) -> np.ndarray:
    """Sum over all rows (``x array<double>, y double``) of what ``part`` makes of a batch's matrix and labels."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            if batch.num_rows:
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                total += part(x, batch.column(1).to_numpy(zero_copy_only=False))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            for sums in batch.column(0).to_pylist():
                total += np.frombuffer(sums).reshape(shape)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    sums = rows.mapInArrow(added, "sums binary")
    if tasks > MOST_SUMS:
        sums = sums.repartition(MOST_SUMS).mapInArrow(merged, "sums binary")
    return sum((np.frombuffer(r.sums).reshape(shape) for r in sums.collect()), np.zeros(shape))


def _sums_at(rows: DataFrame, at: np.ndarray, mean: np.ndarray, inverse: np.ndarray, tasks: int) -> np.ndarray:
    """Per row of ``at`` (coefficients of standardised features, intercept last): loss, slope, upper curvature."""
    width = at.shape[1]
    upper = np.triu_indices(width)

    def part(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        z = np.ones((len(x), width))
        z[:, :-1] = (x - mean) * inverse
        margins = z @ at.T
        out = []
        for margin in margins.T:
            p = 0.5 + 0.5 * np.tanh(margin / 2)
            curve = z.T @ (z * (p * (1 - p))[:, None])
            out.append(np.concatenate([[(np.logaddexp(0, margin) - y * margin).sum()], (p - y) @ z, curve[upper]]))
        return np.array(out)

    return _summed(rows, part, (len(at), 1 + width + len(upper[0])), tasks)


def least(h: np.ndarray, b: np.ndarray, weights: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The z with the least ``z'hz / 2 - b'z + sum(weights * |z|)``, from ``start``; ``h`` is positive definite.

    An active-set search with exact solves: entries leave where they would change their sign, and
    the entry with the steepest slope beyond its weight comes in, until none is left.
    """
    z, sign, free = start.copy(), np.sign(start), weights == 0
    active, barred = free | (z != 0), np.zeros(len(z), bool)
    for _ in range(50 * len(z)):        # rounding could make it go round
        a = np.flatnonzero(active)
        goal = np.zeros_like(z)
        goal[a] = np.linalg.solve(h[np.ix_(a, a)], b[a] - weights[a] * sign[a])
        crossing = np.flatnonzero(active & ~free & (goal * sign <= 0))
        if len(crossing):
            shares = z[crossing] / (z[crossing] - goal[crossing] + (z[crossing] == goal[crossing]))
            first = crossing[shares.argmin()]
            barred[first] = z[first] == 0           # came in and would leave at once: a rounding error
            z = z + shares.min() * (goal - z)
            z[first], sign[first], active[first] = 0.0, 0.0, False
            continue
        z = goal
        slope = h @ z - b
        over = np.where(active | barred, -np.inf, np.abs(slope) - weights * (1 + 1e-9) - 1e-15)
        new = over.argmax()
        if over[new] <= 0:
            break
        active[new], sign[new] = True, -np.sign(slope[new])
    return z


class _Descent:
    """One point's way down: a damped Newton step for each pass."""

    def __init__(self, start: np.ndarray, estimator: LogisticRegression):
        strength, share = estimator.getRegParam(), estimator.getElasticNetParam()
        self.l1, self.l2 = np.full(len(start), strength * share), np.full(len(start), strength * (1 - share))
        self.l1[-1] = self.l2[-1] = 0.0                     # the intercept
        self.left, self.tol = estimator.getMaxIter(), estimator.getTol()
        self.at, self.value, self.trial = start, math.inf, start

    def step(self, loss: float, slope: np.ndarray, curve: np.ndarray) -> bool:
        """Take in the means at ``trial`` and set the next one; False at the end, which is ``at``."""
        value = loss + self.l1 @ np.abs(self.trial) + self.l2 @ self.trial ** 2 / 2
        if self.value == math.inf or value <= self.value + 1e-4 * self.size * self.gain + 1e-13 * abs(self.value):
            ended = self.value < math.inf and -self.gain <= 1e-3 * self.tol * abs(value)
            self.at, self.value = self.trial, value
            if ended or self.left == 0:
                return False
            self.left -= 1
            slope = slope + self.l2 * self.at
            # For exact solves where features are the same. More damping crawls along nearly constant features.
            h = curve + np.diag(self.l2 + 1e-13 * (np.trace(curve) / len(curve) + 1e-3))
            to = least(h, h @ self.at - slope, self.l1, self.at)
            self.move, self.size = to - self.at, 1.0
            self.gain = slope @ self.move + self.l1 @ (np.abs(to) - np.abs(self.at))
        else:
            self.size /= 2
        if not (self.gain < 0 and self.size > 1e-9):
            return False
        self.trial = self.at + self.size * self.move
        return True


def fit_points(rows: DataFrame, estimator: LogisticRegression, grid: Sequence[dict]) -> list[tuple[np.ndarray, float]]:
    """Coefficients and intercept at each point of ``grid``, from persisted rows ``x array<double>, y double`` (0 or 1)."""
    seen = rows.agg(Summarizer.metrics("mean", "std").summary(array_to_vector("x")).alias("s"),
                    F.count(F.lit(1)).alias("n"), F.sum("y").alias("ones")).first()
    mean, std = seen.s.mean.toArray(), seen.s.std.toArray()
    if not np.isfinite(std).all():
        raise ValueError("a feature is not finite")
    if seen.ones in (0, seen.n):      # as in Spark: one class only, nothing to learn
        return [(np.zeros(len(mean)), math.inf if seen.ones else -math.inf)] * len(grid)
    inverse = np.divide(1.0, std, out=np.zeros_like(std), where=std > 0)   # constant features have no coefficient
    # From zero: another fold's points with large coefficients start far out, where steps crawl.
    start = np.append(np.zeros(len(mean)), math.log(seen.ones / (seen.n - seen.ones)))
    ways = [_Descent(start, estimator.copy(point)) for point in grid]
    tasks, width = rows.rdd.getNumPartitions(), len(start)
    upper, going = np.triu_indices(width), ways
    while going:
        sums = _sums_at(rows, np.array([w.trial for w in going]), mean, inverse, tasks) / seen.n
        on = []
        for way, total in zip(going, sums):
            curve = np.zeros((width, width))
            curve[upper] = curve.T[upper] = total[1 + width:]
            if way.step(total[0], total[1:1 + width], curve):
                on.append(way)
        going = on
    found = [w.at[:-1] * inverse for w in ways]
    return [(f, float(w.at[-1] - f @ mean)) for f, w in zip(found, ways)]


def f1_scores(rows: DataFrame, points: Sequence[tuple[np.ndarray, float]]) -> list[float]:
    """F1 of class 1 at each point over rows ``x array<double>, y double``; 0 where no row is or is taken for a 1."""
    coefficients, intercepts = np.array([f for f, _ in points]), np.array([b for _, b in points])

    def part(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        taken = x @ coefficients.T + intercepts > 0
        true = (y == 1)[:, None]
        return np.array([(taken & true).sum(0), taken.sum(0), np.broadcast_to(true, taken.shape).sum(0)], dtype=float)

    hits, taken, ones = _summed(rows, part, (3, len(points)), 1)
    return [float(2 * h / (t + o)) if t + o else 0.0 for h, t, o in zip(hits, taken, ones)]


def model_of(spark: SparkSession, estimator: LogisticRegression, point: tuple[np.ndarray, float]) -> LogisticRegressionModel:
    """Spark's own model with these numbers: it predicts and is saved like one that the estimator fitted."""
    sc = spark.sparkContext
    made = sc._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(
        estimator.uid, _py2java(sc, Vectors.dense(point[0])), point[1])
    return estimator._copyValues(LogisticRegressionModel(made))
