import json

import pytest
from pyspark.sql import functions as F

from sensorlake.functions.columns import double_or, int_or, to_double
from sensorlake.operators import clean, validate
from sensorlake.spec import DEFAULTS, REQUIRED_CHANNELS, c
from tests.conftest import FIRE, NORMAL, OUTLIER


def payload(row, **changes):
    return {**dict(zip(REQUIRED_CHANNELS, row)), **changes}


def check(spark, *objects):
    df = spark.createDataFrame([(i, o if isinstance(o, str) else json.dumps(o)) for i, o in enumerate(objects)],
                               "i int, value string")
    return {r.i: r for r in validate.validate(validate.decode(df)).collect()}


def test_valid_and_missing(spark):
    got = check(spark, payload(NORMAL), {"Temperature[C]": 25.5}, payload(FIRE))
    assert got[0].is_valid and got[2].is_valid and got[0].errors == []
    assert got[1].errors[0].startswith("Missing required fields")


def test_range_violations(spark):
    errors = check(spark, payload(OUTLIER))[0].errors
    assert len(errors) >= 4
    joined = " ".join(errors)
    for word in ("Temperature", "Humidity", "Pressure", "Negative"):
        assert word in joined


def test_bad_types(spark):
    errors = check(spark, payload(NORMAL, **{"Temperature[C]": "invalid", "eCO2[ppm]": "not_a_number",
                                             "Fire Alarm": "invalid_alarm"}))[0].errors
    assert len(errors) == 3
    assert sum("Invalid numeric" in e for e in errors) == 2
    assert any("Fire Alarm" in e for e in errors)


def test_null_alarm_is_an_error_and_null_number_is_not(spark):
    errors = check(spark, payload(NORMAL, **{"Fire Alarm": None, "TVOC[ppb]": None}))[0].errors
    assert len(errors) == 1 and "Fire Alarm" in errors[0]


def test_text_alarm_and_corrupt(spark):
    got = check(spark, payload(NORMAL, **{"Fire Alarm": "1"}), '{"Temperature[C]": 2', "")
    assert got[0].is_valid
    assert got[1].errors == ["Corrupt record"]
    assert not got[2].is_valid


def sanitized(spark, obj):
    df = spark.createDataFrame([(json.dumps(obj),)], "value string")
    row = validate.sanitize(validate.decode(df), text=True).first()
    return {n: row[n] for n in REQUIRED_CHANNELS}


def test_sanitise_missing(spark):
    got = sanitized(spark, {"Temperature[C]": 25.5, "Humidity[%]": None})
    assert got["Temperature[C]"] == 25.5
    assert {n: v for n, v in got.items() if n != "Temperature[C]"} == {
        n: v for n, v in DEFAULTS.items() if n != "Temperature[C]"}


def test_sanitise_outliers(spark):
    got = sanitized(spark, payload(NORMAL, **{"Temperature[C]": 200, "Humidity[%]": -50, "Pressure[hPa]": 2000}))
    assert (got["Temperature[C]"], got["Humidity[%]"], got["Pressure[hPa]"], got["TVOC[ppb]"]) == (
        20.0, 50.0, 1013.25, NORMAL[2])


def test_sanitise_text(spark):
    got = sanitized(spark, payload(NORMAL, **{"Temperature[C]": "25.5", "CNT": "12.9", "Fire Alarm": "1"}))
    assert (got["Temperature[C]"], got["CNT"], got["Fire Alarm"]) == (25.5, 12, 1)


@pytest.mark.parametrize("text, number", [
    ("25.5", 25.5), ("NaN", None), ("-Infinity", None), ("inf", None), ("1e999", None), ("-3", -3.0), ("1e3", 1000.0), ("1.5d", None), ("2f", None), ("1.5d ", None),
    ("abc", None), ("", None), (None, None)])
def test_to_double(spark, text, number):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(to_double(F.col("t"))).first()[0] == number


def test_safe_casts(spark):
    row = spark.createDataFrame([("x", "7.9")], "a string, b string").select(
        double_or(F.col("a"), 1.5), int_or(F.col("b")), int_or(F.col("a"), 4)).first()
    assert tuple(row) == (1.5, 7, 4)


def test_declared_and_soft_rules(make_readings):
    df = make_readings([NORMAL, OUTLIER])
    found = validate.declared_violations(df, "event_id").collect()
    assert {r.event_id for r in found} == {1}
    assert {r.channel for r in found} >= {"Temperature[C]", "Humidity[%]", "eCO2[ppm]", "Pressure[hPa]"}
    assert {r.channel for r in validate.soft_warnings(df, "event_id").collect()} == {
        "Temperature[C]", "Humidity[%]", "Pressure[hPa]"}


def test_clean_chain(make_readings):
    rows = [NORMAL, (None, *NORMAL[1:]), OUTLIER, (30.0, *NORMAL[1:])]
    got = clean.clean(make_readings(rows))
    assert got.count() == 3
    assert {r["Temperature[C]"] for r in got.collect()} == {NORMAL[0], 30.0}
    assert got.select("day_of_week").distinct().collect()[0][0] == 0     # a Monday


def test_find_target(spark, make_readings):
    assert clean.find_target(make_readings([NORMAL])) == "Fire Alarm"
    df = spark.createDataFrame([(1, 0), (2, 1), (3, 0)], "a int, b int")
    assert clean.find_target(df) == "b"
    with pytest.raises(ValueError):
        clean.find_target(df.select("a"))


def test_typed_errors_match_flag(make_readings):
    df = make_readings([NORMAL, OUTLIER, FIRE])
    rows = df.select(F.size(validate.reading_errors()).alias("n"), validate.reading_failed().alias("f"),
                     c("Fire Alarm")).collect()
    assert [(r.n > 0) == r.f for r in rows] == [True] * 3
