import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorlake.operators.clean import impute, two_valued
from sensorlake.operators.quantiles import quantile_table


@pytest.mark.parametrize("buckets", [2, 7, 512])
def test_exact_whatever_the_buckets(spark, buckets):
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(10, 3, 5000), 3)
    y = np.where(rng.random(5000) < 0.4, 7.0, rng.integers(0, 50, 5000).astype(float))   # one heavy value
    df = spark.createDataFrame([(float(a), None if i % 9 == 0 else float(b)) for i, (a, b) in enumerate(zip(x, y))],
                               "`a.b` double, y double")
    kept = np.array([b for i, b in enumerate(y) if i % 9])
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {(r.channel, r.prob): r.value for r in quantile_table(
        df, ["a.b", "y"], probs, buckets=buckets).collect()}
    for p in probs:
        assert got[("a.b", p)] == pytest.approx(np.quantile(x, p))
        assert got[("y", p)] == pytest.approx(np.quantile(kept, p))


def test_odd_values(spark):
    rows = [(float("nan"), 1e308, 5e-324, None), (1.0, -1e308, 0.0, None), (float("inf"), 0.0, -5e-324, None), (3.0, 2.0, 1.0, None)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    got = {(r.channel, r.prob): r.value for r in quantile_table(df, ["a", "b", "c", "d"], [0.0, 0.5, 1.0]).collect()}
    assert [got["a", p] for p in (0.0, 0.5, 1.0)] == [1.0, 2.0, 3.0]
    assert [got["b", p] for p in (0.0, 0.5, 1.0)] == [-1e308, 1.0, 1e308]
    assert [got["c", p] for p in (0.0, 1.0)] == [-5e-324, 1.0]
    assert {got["d", p] for p in (0.0, 0.5, 1.0)} == {None}


def test_a_far_value_does_not_spoil_the_rest(spark):
    df = spark.range(2000).selectExpr("CASE WHEN id = 7 THEN 1e15 ELSE id / 7.0D END AS x")
    want = np.quantile([1e15 if i == 7 else i / 7.0 for i in range(2000)], [0.25, 0.5])
    assert [r.value for r in quantile_table(df, ["x"], [0.25, 0.5]).collect()] == pytest.approx(list(want))


def test_fill_policies(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (9.0,), (None,)], "`Temperature[C]` double")
    filled = lambda policy: impute(df, ["Temperature[C]"], policy).where(
        F.col("`Temperature[C]`").isin(2.0, 4.0, 0.0, 20.0)).count()
    last = lambda policy: sorted(r[0] for r in impute(df, ["Temperature[C]"], policy).collect())
    assert last("median") == [1.0, 2.0, 2.0, 9.0]
    assert last("mean") == [1.0, 2.0, 4.0, 9.0]
    assert last("zero") == [0.0, 1.0, 2.0, 9.0]
    assert last("defaults") == [1.0, 2.0, 9.0, 20.0]
    assert filled("mean") == 2


def test_two_valued(spark):
    df = spark.createDataFrame([(1, 5, 0), (0, 6, 0), (1, 7, 0), (None, 5, 0)], "a int, b int, k int")
    got = {r.channel: r.two_valued for r in two_valued(df, ["a", "b", "k"]).collect()}
    assert got == {"a": True, "b": False, "k": False}
