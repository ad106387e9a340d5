from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorlake.operators import alerts, quality, rolling, windows
from sensorlake.plans.detect import detect_all, messages
from sensorlake.spec import DEFAULT_SPEC, READING_SCHEMA, REQUIRED_CHANNELS, WindowLimits
from tests.conftest import FIRE, NORMAL, OUTLIER


def changed(row, **by_position):
    out = list(row)
    for name, v in by_position.items():
        out[{"t": 0, "h": 1, "tvoc": 2, "eco2": 3, "pm1": 7, "pm25": 8, "alarm": 13}[name]] = v
    return tuple(out)


def test_window_alert_messages(spark):
    df = spark.createDataFrame(
        [(1, 85.0, 1500.0, 80.0, 2), (2, 55.0, 10.0, 40.0, 0), (3, -11.0, 2500.0, 1.0, 0), (4, 0.0, None, None, 0),
         (5, 80.0, 1000.0, 35.0, 0)],
        "id int, avg_temperature double, avg_tvoc double, avg_pm25 double, fire_alarm_count long")
    got = {(r.id, r.sensor): r for r in alerts.explode_alerts(df, alerts.window_alerts(WindowLimits()), "id").collect()}
    assert {k: v.severity for k, v in got.items()} == {
        (1, "TEMPERATURE"): "CRITICAL", (1, "TVOC"): "HIGH", (1, "PM2.5"): "CRITICAL", (1, "FIRE_ALARM"): "CRITICAL",
        (2, "TEMPERATURE"): "HIGH", (2, "PM2.5"): "HIGH", (3, "TEMPERATURE"): "LOW", (3, "TVOC"): "CRITICAL",
        (5, "TEMPERATURE"): "HIGH"}
    assert got[(1, "TEMPERATURE")].message == "Critical temperature: 85.00°C"
    assert got[(1, "TVOC")].message == "High TVOC level: 1500.00 ppb"
    assert got[(1, "FIRE_ALARM")].message == "Fire alarm triggered: 2 alarms"


def test_reading_alerts_count_missing_as_zero(make_readings):
    df = make_readings([NORMAL, FIRE, changed(NORMAL, h=None), OUTLIER])
    got = {}
    for r in alerts.explode_alerts(df, alerts.reading_alerts(), "event_id").collect():
        got.setdefault(r.event_id, set()).add((r.sensor, r.severity))
    assert 0 not in got
    assert got[1] == {("Temperature[C]", "HIGH"), ("TVOC[ppb]", "HIGH"), ("eCO2[ppm]", "HIGH"), ("PM2.5", "HIGH"),
                      ("Fire Alarm", "CRITICAL")}
    assert got[2] == {("Humidity[%]", "LOW")}
    counted = {r.event_id: r.n for r in df.select(
        "event_id", alerts.alert_count(alerts.reading_alerts()).alias("n")).collect()}
    assert counted == {i: len(got.get(i, ())) for i in range(4)}


@pytest.mark.parametrize("t, severity, threshold", [
    (-21.0, "CRITICAL", -20.0), (-20.0, "HIGH", 0.0), (-1.0, "HIGH", 0.0), (0.0, None, None), (40.0, None, None),
    (41.0, "MEDIUM", 40.0), (50.5, "HIGH", 50.0), (71.0, "CRITICAL", 70.0)])
def test_ladder_order(make_readings, t, severity, threshold):
    df = make_readings([changed(NORMAL, t=t)])
    found = [r for r in alerts.explode_alerts(df, alerts.ladder_alerts(), "event_id").collect()
             if r.sensor == "Temperature[C]"]
    assert [(r.severity, r.threshold) for r in found] == ([(severity, threshold)] if severity else [])
    if severity == "MEDIUM":
        assert found[0].message == "Elevated Temperature[C]: 41.0"


def test_fire_pattern(make_readings):
    two = changed(NORMAL, t=46.0, tvoc=900.0)
    df = make_readings([NORMAL, FIRE, two, changed(FIRE, t=None)])
    got = [(r.event_id, r.sensor, r.severity, r.value) for r in alerts.explode_alerts(
        df, alerts.pattern_alerts(), "event_id").orderBy("event_id", "sensor").collect()]
    assert got == [(1, "Fire Alarm", "CRITICAL", 1.0), (1, "Fire Pattern", "CRITICAL", 4.0),
                   (2, "Fire Pattern", "HIGH", 2.0)]


@pytest.mark.parametrize("spec", [DEFAULT_SPEC, replace(DEFAULT_SPEC, slice_seconds=900)])
def test_rolling_scores_against_numpy(make_readings, spec):
    rng = np.random.default_rng(5)
    temps = [float(x) for x in rng.normal(20, 1, 260)]
    temps[200] = 60.0
    rows = [changed(NORMAL, t=None if i % 11 == 0 else t) for i, t in enumerate(temps)]
    df = make_readings(rows, devices=("sensor_0", "sensor_1"), step=60)
    got = {r.event_id: r for r in rolling.rolling_scores(df, ["Temperature[C]"], size=50, spec=spec).collect()}
    for device in (0, 1):
        seen = []
        for i in range(device, 260, 2):
            if rows[i][0] is None:
                assert i not in got
                continue
            seen = [*seen, rows[i][0]][-50:]
            assert got[i].n == len(seen)
            assert got[i]["mean"] == pytest.approx(np.mean(seen))
            assert got[i]["std"] == pytest.approx(np.std(seen))
            if len(seen) < 30:
                assert got[i].z is None
            else:
                assert got[i].z == pytest.approx(abs(seen[-1] - np.mean(seen)) / np.std(seen))
    assert got[200].z > 4
    kinds = {r.alert_type for r in detect_all(df).collect()}
    assert kinds == {"THRESHOLD", "STATISTICAL"}
    assert messages(df).where("message LIKE '%Z-score%'").count() >= 1


def test_device_windows(make_readings):
    rows = [changed(NORMAL, t=float(20 + i)) for i in range(10)]
    got = {r.device_id: r for r in windows.device_windows(
        make_readings(rows, devices=("s0", "s1", "s2"), step=60), "1 hour").collect()}
    assert {d: r.readings for d, r in got.items()} == {"s0": 4, "s1": 3, "s2": 3}
    assert (got["s0"].max_temperature, got["s0"].min_temperature, got["s0"].avg_temperature) == (29.0, 20.0, 24.5)


def test_exact_window_quantiles(spark):
    """Beyond 10,000 values of a window the sketches' quantiles are near values only."""
    n = 60_001
    df = spark.range(n).select(
        F.timestamp_seconds(F.lit(1_704_067_200)).alias("timestamp"), F.lit("s").alias("device_id"), F.lit("lab").alias("location"),
        *[F.lit(None).cast("double").alias(x) for x in windows_channels()],
        F.when(F.col("id") % 20 > 0, (F.col("id") * 7919 % n).cast("double")).alias("Temperature[C]"),
        (F.col("id") * 104_729 % n).cast("double").alias("TVOC[ppb]"), F.lit(0).alias("Fire Alarm"))
    sketched = windows.window_analytics(df, "1 hour", "30 minutes")
    got = windows.with_exact_quantiles(sketched, df, "1 hour", "30 minutes")
    assert got.columns == sketched.columns
    present = sorted(i * 7919 % n for i in range(n) if i % 20)
    rows = got.collect()
    assert len(rows) == 2
    for r in rows:
        assert r.temp_median == present[-(-len(present) // 2) - 1]
        assert r.tvoc_95th_percentile == -(-n * 95 // 100) - 1
    none = windows.with_exact_quantiles(sketched, df.where("false"), "1 hour", "30 minutes").first()
    assert none.temp_median is None and none.record_count == n


def windows_channels():
    return [f.name for f in READING_SCHEMA.fields
            if f.name not in ("Temperature[C]", "TVOC[ppb]", "Fire Alarm", "timestamp", "device_id", "location")]


def test_window_quality(spark):
    df = spark.createDataFrame([(5, 0.05, 101.0, -60.0), (50, 3.0, 30.0, 20.0), (200, 0.0, 30.0, 20.0)],
                               "record_count long, temp_stddev double, max_temperature double, min_temperature double")
    rows = quality.with_window_quality(df).orderBy("record_count").collect()
    assert [(r.quality_score, r.data_completeness, r.quality_warning) for r in rows] == [
        (15.0, 5.0, True), (100.0, 50.0, False), (100.0, 100.0, False)]
    assert len(rows[0].quality_issues) == 4 and rows[1].quality_issues == []


def test_reading_quality(make_readings):
    score, issues = quality.reading_quality()
    df = make_readings([NORMAL, changed(NORMAL, t=None, h=None), OUTLIER])
    rows = df.select(score.alias("s"), issues.alias("i")).collect()
    assert [r.s for r in rows] == [100.0, 80.0, 55.0]
    assert rows[1].i == ["Missing values: Temperature[C], Humidity[%]"]
    assert rows[2].i == ["Extreme high temperature", "Negative humidity", "Negative TVOC reading"]


def test_overall_score(make_readings):
    df = make_readings([NORMAL, NORMAL, OUTLIER, changed(NORMAL, t=None)])
    row = quality.overall_score(df, REQUIRED_CHANNELS).first()
    assert row.duplicates == 1 and row.range_score == 80.0 and row.type_score == 100.0
    complete = (13 * 100 + 75) / 14
    assert row.overall_score == pytest.approx(round((complete + 100 + 80 + 75) / 4, 2))


def test_sustained_needs_its_time(make_readings):
    hot = [changed(NORMAL, t=31.0)] * 6 + [NORMAL] + [changed(NORMAL, t=31.0)] * 5
    df = make_readings(hot, step=60)
    got = rolling.sustained_rules(df, ["device_id"], ["HighTemperature"]).collect()
    assert [(r.alert, r.duration_seconds) for r in got] == [("HighTemperature", 300)]


def test_rolling_rates_and_empty(spark, make_readings):
    log = make_readings([NORMAL] * 100).select(
        "device_id", "timestamp", (F.col("event_id") % 20 == 0).alias("failed"), F.lit(False).alias("anomaly"),
        F.lit(1.0).alias("quality"), F.lit(5.0).alias("processing_ms"))
    last = rolling.rolling_rates(log, ["device_id"]).orderBy(F.col("at").desc()).first()
    assert last.error_rate == pytest.approx(0.05) and last.error_ratio == pytest.approx(5 / 95)
    assert rolling.rolling_rates(log.limit(0), ["device_id"]).count() == 0


def test_odd_numbers_raise_no_alarm(make_readings):
    """NaN and infinities are missing, and only an alarm of 1 is an alarm."""
    nan, inf = float("nan"), float("inf")
    rows = [(nan, *NORMAL[1:]), (inf, -inf, nan, *NORMAL[3:]), (*NORMAL[:13], 2), (*NORMAL[:13], 1)]
    df = make_readings(rows)
    basic = alerts.explode_alerts(df, alerts.reading_alerts(), "event_id").collect()
    assert [(r.event_id, r.sensor, r.severity) for r in basic if r.sensor != "Humidity[%]"] == [(3, "Fire Alarm", "CRITICAL")]
    assert [r.event_id for r in basic if r.sensor == "Humidity[%]"] == [1]   # missing counts as 0 there
    for checks in (alerts.ladder_alerts(), alerts.pattern_alerts()):
        found = alerts.explode_alerts(df, checks, "event_id").collect()
        assert {r.event_id for r in found} <= {3}


def test_positive_prediction_without_confidence(spark):
    df = spark.createDataFrame([(1, None), (1, 0.9), (0, 0.9)], "prediction int, confidence double")
    got = alerts.explode_alerts(df, alerts.prediction_alerts()).collect()
    assert sorted(r.value for r in got) == [0.5, 0.9] and {r.severity for r in got} == {"HIGH"}
