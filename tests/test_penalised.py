"""Joint logistic fits against Spark's own, and the registered search."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors

from sensorlake.catalog import QUERIES
from sensorlake.operators import penalised
from sensorlake.plans import training
from sensorlake.spec import NUMERIC_CHANNELS
from tests.conftest import FIRE, NORMAL


def numbers(spark, x, y, parts=3):
    rows = [(list(map(float, r)), float(v)) for r, v in zip(x, y)]
    return spark.createDataFrame(rows, "x array<double>, y double").repartition(parts).persist()


def objective(x, y, point, strength, share):
    """Spark's: mean loss, and penalties of the coefficients times their features' deviations."""
    margin = x @ point[0] + point[1]
    scaled = point[0] * x.std(axis=0, ddof=1)
    return (np.mean(np.logaddexp(0, margin) - y * margin) + strength * share * np.abs(scaled).sum()
            + strength * (1 - share) / 2 * (scaled ** 2).sum())


@pytest.fixture(scope="module")
def sample():
    """Unscaled features, two of them copies of one, one nearly a copy, and one constant."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 4)) * [1, 20, 0.1, 3] + [5, -40, 0, 1000]
    x = np.column_stack([x, 8 * x[:, 0], x[:, 0] / 6, x[:, 1] + rng.normal(size=300) * 1e-3, np.full(300, 7.0)])
    odds = 1.5 * (x[:, 0] - 5) - 0.05 * (x[:, 1] + 40) + 10 * x[:, 2]
    return x, (rng.random(300) < 1 / (1 + np.exp(-odds))).astype(float)


def test_points_are_as_good_as_sparks_own(spark, sample):
    x, y = sample
    rows = numbers(spark, x, y)
    linear = LogisticRegression(maxIter=1000)
    grid = [{linear.elasticNetParam: a, linear.regParam: r} for a in (1.0, 0.5, 0.0) for r in (0.05, 0.001)]
    vectors = rows.select(array_to_vector("x").alias("features"), rows.y.alias("label")).persist()
    points = penalised.fit_points(rows, linear, grid)
    for point, at in zip(points, grid):
        share, strength = at[linear.elasticNetParam], at[linear.regParam]
        own = linear.copy({**at, linear.tol: 1e-9}).fit(vectors)
        ours, theirs = (objective(x, y, p, strength, share) for p in (point, (own.coefficients.toArray(), own.intercept)))
        assert ours <= theirs + 1e-9 and ours == pytest.approx(theirs, rel=1e-5)
        assert 1 / (1 + np.exp(-(x @ point[0] + point[1]))) == pytest.approx(
            np.array([own.predictProbability(r)[1] for r in map(vector, x)]), abs=2e-3)
        assert point[0][-1] == 0.0        # the constant
    kept = [np.count_nonzero(f) for f, _ in points]
    assert kept[0] < 7 and kept[0] <= kept[1]


def vector(values):
    return Vectors.dense(values)


def test_l1_step_is_exact():
    """Against coordinate descent run for very long."""
    rng = np.random.default_rng(5)
    for k in (1, 3, 8):
        for _ in range(20):
            a = rng.normal(size=(k + 3, k))
            h, b, weights = a.T @ a + 1e-3 * np.eye(k), rng.normal(size=k) * 3, rng.random(k) * 2
            weights[-1] = 0.0
            z = np.zeros(k)
            for _ in range(3000):
                for j in range(k):
                    r = b[j] - h[j] @ z + h[j, j] * z[j]
                    z[j] = np.sign(r) * max(abs(r) - weights[j], 0) / h[j, j]
            for start in (np.zeros(k), rng.normal(size=k)):
                assert penalised.least(h, b, weights, start) == pytest.approx(z, abs=1e-6)


def test_partial_sums_of_many_tasks_are_added_by_tasks(spark, sample, monkeypatch):
    x, y = sample
    rows, linear = numbers(spark, x, y, 12), LogisticRegression(maxIter=1000, regParam=0.01)
    (one, b), = penalised.fit_points(rows, linear, [{}])
    monkeypatch.setattr(penalised, "MOST_SUMS", 5)
    (other, c), = penalised.fit_points(rows, linear, [{}])
    assert other == pytest.approx(one, rel=1e-6, abs=1e-9) and c == pytest.approx(b, rel=1e-6)


def test_nearly_constant_feature_takes_few_passes(spark, monkeypatch):
    """A ratio that all but a few rows share, at a weak penalty: large coefficients far from the start."""
    rng = np.random.default_rng(9)
    value = np.where(np.arange(600) % 200 == 7, 0.0, rng.random(600) * 200)
    x = np.column_stack([value, 8 * value, value / 6 / (value / 4 + 1e-5), rng.normal(size=600)])
    rows = numbers(spark, x, (value > 100) & (rng.random(600) < 0.3))
    linear, passes, sums_at = LogisticRegression(maxIter=1000, regParam=1e-8, elasticNetParam=1.0), [], penalised._sums_at
    monkeypatch.setattr(penalised, "_sums_at", lambda *a: passes.append(1) or sums_at(*a))
    penalised.fit_points(rows, linear, [{}])
    assert len(passes) < 60


def test_one_class_only(spark):
    linear = LogisticRegression()
    for label, sign in ((0, -1), (1, 1)):
        rows = numbers(spark, [[1.0, 2.0], [3.0, 4.0]], [label, label])
        points = penalised.fit_points(rows, linear, [{}, {linear.regParam: 0.1}])
        assert [b for _, b in points] == [sign * math.inf] * 2 and not any(f.any() for f, _ in points)
        assert penalised.f1_scores(rows, points) == [float(label)] * 2
    model = penalised.model_of(spark, linear, points[0])
    assert model.intercept == math.inf and model.predict(vector([1.0, 2.0])) == 1.0


def test_f1_counts(spark):
    rows = numbers(spark, [[-1.0], [1.0], [2.0], [3.0]], [1, 0, 1, 1])
    points = [(np.array([1.0]), 0.0), (np.array([1.0]), -2.5), (np.array([0.0]), -1.0)]
    assert penalised.f1_scores(rows, points) == pytest.approx([2 / 3, 0.5, 0.0])


def test_other_settings_take_sparks_own_fit():
    linear = LogisticRegression()
    assert penalised.applies(linear, training.logistic_grid(linear, 10))
    assert penalised.applies(training.logistic(), [{}])
    assert not penalised.applies(LogisticRegression(fitIntercept=False), [{}])
    assert not penalised.applies(linear, [{linear.threshold: 0.2}])
    assert not penalised.applies(training.forest(), [{}])


def test_search_is_the_generic_search(spark, make_readings, monkeypatch, tmp_path):
    """The same scores and predictions as with Spark's fits, one by one; the result can be saved."""
    rng = np.random.default_rng(11)
    rows = []
    for i in range(160):
        base = FIRE if i % 4 == 0 else NORMAL
        noisy = [float(v + rng.normal(0, abs(v) * 0.8)) for v in base[:12]]
        rows.append((*[None if i % 13 == j else v for j, v in enumerate(noisy)], base[12], int(base[13])))
    df = make_readings(rows)
    linear = training.logistic(tol=1e-8)
    grid = training.logistic_grid(linear, 160, (0.1, 1.0))
    ours = training.search(df, linear, grid, folds=2)
    monkeypatch.setattr(penalised, "applies", lambda *_: False)
    plain = training.search(df, linear, grid, folds=2)
    assert ours.scores == pytest.approx(plain.scores, abs=1e-9)
    first, second = (r.bestModel.transform(df).orderBy("event_id").collect() for r in (ours, plain))
    assert [r.prediction for r in first] == [r.prediction for r in second]
    assert [r.probability[1] for r in first] == pytest.approx([r.probability[1] for r in second], abs=5e-3)
    training.save_model(ours.bestModel, str(tmp_path / "m"), "logistic", spark)
    again = training.load_model(str(tmp_path / "m"), spark)[0].transform(df).orderBy("event_id").collect()
    assert [r.probability for r in again] == [r.probability for r in first]


def test_registered_search_is_whole(spark, tmp_path, monkeypatch):
    """n06: both penalties at four strengths, five folds, up to 1000 steps, the whole training side."""
    start = dt.datetime(2024, 1, 1)
    rows = [(i, start + dt.timedelta(minutes=i), i % 7, "error" if i % 3 == 0 else "view", float(i * 37 % 240), f'{{"k": {i % 90}}}')
            for i in range(400)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
                          ).write.parquet(f"{tmp_path}/events.parquet")
    calls, fits, search, fit_points = [], [], training.search, penalised.fit_points

    def seen(df, estimator, grid, *args, **more):
        calls.append((estimator, grid, search(df, estimator, grid, *args, **more), df.count()))
        return calls[-1][2]

    monkeypatch.setattr(training, "search", seen)
    monkeypatch.setattr(penalised, "fit_points", lambda rows, e, grid: fits.append((rows.count(), len(grid))) or fit_points(rows, e, grid))
    out = QUERIES["n06_logistic_search"](spark, str(tmp_path)).collect()
    (linear, grid, found, n), = calls
    assert linear.getMaxIter() == 1000 and len(out) == 1
    strengths = {(p[linear.elasticNetParam], round(1 / (p[linear.regParam] * n), 6)) for p in grid}
    assert strengths == {(a, s) for a in (1.0, 0.0) for s in (0.1, 1.0, 10.0, 100.0)}
    assert len(found.scores) == 8 and n > 300
    # Each fold learns from all other rows, at last all rows are learnt from.
    assert [p for _, p in fits] == [8] * 5 + [1] and fits[-1][0] == n and sum(r for r, _ in fits[:5]) == 4 * n
    assert set(NUMERIC_CHANNELS) <= set(training.feature_names())
    assert found.bestModel.stages[-1].numFeatures == len(training.feature_names())
