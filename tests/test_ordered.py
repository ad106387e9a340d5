"""The sliced window operators equal plain windows, whatever the slice width and skew."""

import datetime as dt
import random
from dataclasses import replace

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sensorlake.operators.ordered import islands, range_sums, rows_window, running, slice_seconds_for
from sensorlake.operators.rolling import health_warnings, rolling_mean, rolling_rates
from sensorlake.spec import DEFAULT_SPEC

BASE = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


@pytest.fixture(scope="module")
def skewed(spark):
    """900 rows; one key holds most of them, several rows share a time, some keys are sparse."""
    rnd = random.Random(7)
    rows = []
    for i in range(900):
        key = "hot" if i % 10 < 7 else f"k{i % 3}"
        at = BASE + dt.timedelta(seconds=rnd.randrange(0, 4000) // 3 * 3)
        rows.append((i, key, at, float(rnd.randrange(0, 50)), rnd.random() < 0.7))
    return spark.createDataFrame(rows, "id long, key string, ts timestamp, v double, on boolean").cache()


def same(a, b, keys):
    left = sorted(map(tuple, a.select(*keys).collect()), key=repr)
    right = sorted(map(tuple, b.select(*keys).collect()), key=repr)
    assert len(left) == len(right)
    for x, y in zip(left, right):
        assert x == pytest.approx(y) if all(isinstance(z, (int, float)) for z in (*x, *y)) else x == y


@pytest.mark.parametrize("width", [None, 0.5, 30, 600, 100000])
def test_rows_window(skewed, width):
    def exprs(w):
        return {"s": F.sum("v").over(w.rowsBetween(-9, 0)), "p": F.lag("id", 2).over(w),
                "q": F.lead("id", 1).over(w)}

    got = rows_window(skewed, ["key"], ["ts", "id"], exprs, before=9, after=1, slice_seconds=width)
    plain = skewed.withColumns(exprs(Window.partitionBy("key").orderBy("ts", "id")))
    same(got, plain, ["id", "s", "p", "q"])


@pytest.mark.parametrize("seconds", [0, 1, 59, 120, 100000])
def test_range_sums(skewed, seconds):
    got = range_sums(skewed, ["key"], "ts", seconds, {"s": F.col("v"), "t": F.when(F.col("on"), F.col("id"))})
    w = Window.partitionBy("key").orderBy(F.unix_seconds("ts")).rangeBetween(-seconds, 0)
    assert got.columns == [*skewed.columns, "s", "t"]
    same(got, skewed.withColumns({"s": F.sum("v").over(w), "t": F.coalesce(F.sum(F.when(F.col("on"), F.col("id"))).over(w), F.lit(0))}),
         ["id", "key", "v", "s", "t"])


def test_range_sums_without_times_and_keys(spark):
    rows = [(1, None, 1.0), (2, None, 2.0), (3, BASE, 4.0), (4, BASE + dt.timedelta(seconds=9), None),
            (5, dt.datetime(1969, 12, 31, 23, 59, 58, tzinfo=dt.timezone.utc), 8.0),
            (6, dt.datetime(1970, 1, 1, 0, 0, 1, tzinfo=dt.timezone.utc), 16.0)]
    df = spark.createDataFrame(rows, "id long, ts timestamp, v double")
    got = {r.id: r.s for r in range_sums(df, [], "ts", 10, {"s": F.col("v")}).collect()}
    assert got == {1: 3.0, 2: 3.0, 3: 4.0, 4: 4.0, 5: 8.0, 6: 24.0}
    assert range_sums(df.limit(0), [], "ts", 10, {"s": F.col("v")}).collect() == []


def test_a_large_value_leaves_later_frames_exact(spark):
    """Nothing is subtracted: frames without the value are the sums of their own rows."""
    rows = [(i, "a", BASE + dt.timedelta(seconds=i), 1e17 if i == 5 else 0.1 * i) for i in range(200)]
    df = spark.createDataFrame(rows, "event_id long, key string, timestamp timestamp, v double")
    got = {r.event_id: r.s for r in range_sums(df, ["key"], "timestamp", 3, {"s": F.col("v")}).collect()}
    mean = {r.event_id: r.m for r in rolling_mean(df, ["key"], {"m": "v"}, size=4).collect()}
    for i in range(9, 200):
        own = [0.1 * j for j in range(i - 3, i + 1)]
        assert got[i] == pytest.approx(sum(own), rel=1e-15) and mean[i] == pytest.approx(sum(own) / 4, rel=1e-15)


@pytest.mark.parametrize("size", [1, 2, 7, 1000])
def test_plain_and_sliced_means_are_equal_to_the_bit(skewed, size):
    rows = skewed.withColumnsRenamed({"id": "event_id", "ts": "timestamp"}).withColumn("v", F.col("v") / 7)
    got = [{r.event_id: r.m for r in rolling_mean(rows, ["key"], {"m": "v"}, size=size, spec=spec).collect()}
           for spec in (DEFAULT_SPEC, replace(DEFAULT_SPEC, slice_seconds=90.0), replace(DEFAULT_SPEC, slice_seconds=1e6))]
    w = Window.partitionBy("key").orderBy("timestamp", "event_id").rowsBetween(1 - size, 0)
    want = {r.event_id: r.m for r in rows.withColumn("m", F.avg("v").over(w)).collect()}
    assert got[0] == got[1] == got[2] and got[0] == pytest.approx(want)


@pytest.mark.parametrize("quality", [0.8, 0.1, 0.7, 1.0, 1 / 3])
def test_equal_scores_have_just_that_mean(spark, quality):
    """Healthy data raise no alarm, whatever the number of rows in a frame."""
    rows = [("a", BASE + dt.timedelta(seconds=i), False, False, quality, 5.0) for i in range(300)]
    log = spark.createDataFrame(rows, "key string, timestamp timestamp, failed boolean, anomaly boolean, quality double, processing_ms double")
    rates = rolling_rates(log, ["key"], seconds=120)
    assert {round(r.quality, 12) for r in rates.collect()} == {round(quality, 12)}
    if quality in (0.8, 1.0):
        assert health_warnings(rates, "key").where("warning = 'LOW_QUALITY'").count() == 0


@pytest.mark.parametrize("width", [None, 90])
@pytest.mark.parametrize("keys", [["key"], []])
def test_running(skewed, keys, width):
    got = running(skewed, keys, ["ts", "id"], {"s": F.col("v"), "n": F.lit(1)}, slice_seconds=width)
    w = Window.partitionBy(*keys).orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, 0)
    same(got, skewed.withColumns({"s": F.sum("v").over(w), "n": F.count("v").over(w)}), ["id", "s", "n"])


@pytest.mark.parametrize("width", [None, 1, 45, 100000])
def test_islands(skewed, width):
    got = islands(skewed, ["key"], ["ts", "id"], F.col("on"), slice_seconds=width)
    expected, rows = [], sorted(skewed.collect(), key=lambda r: (r.key, r.ts, r.id))
    start = None
    for i, r in enumerate(rows):
        nxt = rows[i + 1] if i + 1 < len(rows) and rows[i + 1].key == r.key else None
        if r.on:
            start = start or r.ts
            if nxt is None or not nxt.on:
                expected.append((r.key, start, r.ts))
                start = None
    assert sorted(map(tuple, got.collect())) == sorted(expected)


def test_slice_width_follows_the_busiest_key(skewed):
    wide = slice_seconds_for(skewed, ["key"], "ts", rows_per_slice=1000)
    narrow = slice_seconds_for(skewed, ["key"], "ts", rows_per_slice=10)
    assert wide is None and 0 < narrow < 3600
    busiest = skewed.where("key = 'hot'").groupBy(F.date_trunc("hour", "ts")).count().agg(F.max("count")).first()[0]
    assert narrow == pytest.approx(3600 * 10 / busiest)


def test_one_instant_and_missing_times(spark):
    rows = [(i, "a", None if i % 5 == 0 else BASE, float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, key string, ts timestamp, v double")
    exprs = lambda w: {"s": F.sum("v").over(w.rowsBetween(-3, 0))}
    got = rows_window(df, ["key"], ["ts", "id"], exprs, before=3, slice_seconds=10)
    same(got, df.withColumns(exprs(Window.partitionBy("key").orderBy("ts", "id"))), ["id", "s"])


def test_border_rows_reach_the_last_level(skewed):
    """Narrow slices: borders of borders are windowed again."""
    exprs = lambda w: {"s": F.sum("v").over(w.rowsBetween(-4, 0)), "q": F.lead("id").over(w)}
    got = rows_window(skewed, ["key"], ["ts", "id"], exprs, before=4, after=1, slice_seconds=5, levels=3)
    plain = skewed.withColumns(exprs(Window.partitionBy("key").orderBy("ts", "id")))
    same(got, plain, ["id", "s", "q"])


def test_busy_key_is_spread_over_tasks(skewed):
    """No window partition of the sliced plan is the whole hot key."""
    width = slice_seconds_for(skewed, ["key"], "ts", rows_per_slice=50)
    hot = skewed.where("key = 'hot'")
    per_slice = hot.groupBy(F.floor(F.unix_micros("ts") / (width * 1e6))).count().agg(F.max("count")).first()[0]
    assert per_slice < hot.count() / 4


def test_sliding_sums_of_one_key_are_spread_over_tasks(spark):
    """Rows that lie by key already, after a plain window, are dealt again by key and block."""
    df = spark.range(20_000).select(F.col("id").alias("event_id"), F.timestamp_seconds("id").alias("timestamp"),
                                    F.lit("one").alias("place"), F.col("id").cast("double").alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = rolling_mean(df, ["place"], {"m": "v"}, size=50)
        tasks = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(tasks) == 4 and max(r["count"] for r in tasks) < 10_000
