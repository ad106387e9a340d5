"""Queries: numbers that are none, frames that fill, and timelines cut into slices.

The readings here pass through JSON, where some values are ``NaN`` or infinite and some
alarms are 2; the results must be those of missing values. The rolling queries group by
location, whose timelines are longer than any frame, once whole and once in slices.
"""

from __future__ import annotations

import re
from dataclasses import replace

from pyspark.sql import functions as F

from sensorlake.catalog import detection as det
from sensorlake.catalog import sequences as seq
from sensorlake.catalog.base import SPEC, long_cte, query, readings, rounded, tidy
from sensorlake.operators import alerts, rolling, validate, windows
from sensorlake.spec import ALARM, ECO2, PM25, REQUIRED_CHANNELS, TEMPERATURE, TVOC, c

BY_LOCATION = replace(SPEC, device="location")
SLICED = replace(BY_LOCATION, slice_seconds=40_000.0)

_GAPS = """g AS (SELECT * REPLACE (
  CASE WHEN id % 13 = 1 THEN NULL ELSE t END AS t, CASE WHEN id % 17 = 2 THEN NULL ELSE tvoc END AS tvoc,
  CASE WHEN id % 7 = 3 THEN NULL ELSE pm25 END AS pm25, CASE WHEN id % 29 = 4 THEN NULL ELSE eco2 END AS eco2,
  CASE WHEN id % 19 = 3 THEN 2 ELSE alarm END AS alarm) FROM r)"""


def _gappy(sql: str) -> str:
    """A query of the readings as one of the readings with gaps."""
    return re.sub(r"\bFROM r\b", "FROM g", sql)


def _decoded(spark, d):
    rid = F.col("event_id")
    text = {n: c(n).cast("string") for n in REQUIRED_CHANNELS}
    for name, every, at, odd in ((TEMPERATURE, 13, 1, "NaN"), (TVOC, 17, 2, "Infinity"), (PM25, 7, 3, "-inf"),
                                 (ECO2, 29, 4, "1e999"), (ALARM, 19, 3, "2")):
        text[name] = F.when(rid % every == at, odd).otherwise(text[name])
    body = F.to_json(F.struct(*[e.alias(n) for n, e in text.items()],
                              c("timestamp"), c("device_id"), c("location")))
    return validate.flatten(validate.decode(readings(spark, d).select(rid, body.alias("value"))), "event_id")


@query("m03_faulty_numbers", det._M3, f"{_GAPS},\n{_gappy(det._ROW_VALUES)}")
def m03(spark, d):
    found = alerts.explode_alerts(_decoded(spark, d), alerts.reading_alerts(), "event_id")
    return det.said(found)


@query("m04_faulty_numbers", _gappy(det._M4), _GAPS)
def m04(spark, d):
    found = alerts.explode_alerts(_decoded(spark, d), alerts.ladder_alerts(), "event_id")
    return det.said(found)


@query("m05_faulty_numbers", det._M5, f"{_GAPS},\n{_gappy(det._PATTERN)}")
def m05(spark, d):
    found = alerts.explode_alerts(_decoded(spark, d), alerts.pattern_alerts(), "event_id")
    return det.said(found)


@query("e01_faulty_numbers",
       "SELECT (sec // 86400) * 86400 AS window_start, " + rounded("avg(t)", "avg_temperature") + ", "
       + rounded("avg(tvoc)", "avg_tvoc") + ", " + rounded("max(pm25)", "max_pm25") + ", "
       + rounded("stddev_samp(t)", "temp_stddev") + ", count(*) AS record_count FROM g GROUP BY 1", _GAPS)
def e01(spark, d):
    found = windows.window_analytics(_decoded(spark, d), "1 day", "1 day", spec=SPEC)
    return tidy(windows.with_bounds(found).select(
        "window_start", "avg_temperature", "avg_tvoc", "max_pm25", "temp_stddev", "record_count"))


def _means_sql(rows: int, table: str) -> str:
    return (f"SELECT id AS event_id, {rounded('avg(pm25) OVER w', 'mean_pm25')}, {rounded('avg(t) OVER w', 'mean_t')} "
            f"FROM {table} WINDOW w AS (PARTITION BY location ORDER BY ts, id ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)")


def _means(df, size, spec):
    out = rolling.rolling_mean(df, ["location"], {"mean_pm25": PM25, "mean_t": TEMPERATURE}, size=size, spec=spec)
    return tidy(out.select("event_id", "mean_pm25", "mean_t"))


@query("h04_faulty_numbers", _means_sql(50, "g"), _GAPS)
def h04_faulty(spark, d):
    # NaN stays in the table here: the operator itself takes it as missing.
    broken = readings(spark, d).withColumns({
        TEMPERATURE: F.when(F.col("event_id") % 13 == 1, F.lit(float("nan"))).otherwise(c(TEMPERATURE)),
        PM25: F.when(F.col("event_id") % 7 == 3, F.lit(float("-inf"))).otherwise(c(PM25))})
    return _means(broken, 50, BY_LOCATION)


@query("h04_sliced", _means_sql(50, "r"))
def h04_sliced(spark, d):
    return _means(readings(spark, d), 50, SLICED)


_ROLL = det._ROLL.replace("device_id", "location")
_SCORES = (f"SELECT id AS event_id, channel, {rounded('mean', 'mean')}, {rounded('std', 'std')}, n "
           "FROM zs WHERE n = 100")


def _scores(spark, d, spec):
    scores = rolling.rolling_scores(readings(spark, d), spec=spec)
    return tidy(scores.where("n = 100").select("event_id", "channel", "mean", "std", "n"))


@query("h01_full_frames", _SCORES, _ROLL)
def h01_full(spark, d):
    return _scores(spark, d, BY_LOCATION)


@query("h01_sliced", _SCORES, _ROLL)
def h01_sliced(spark, d):
    return _scores(spark, d, SLICED)


@query("h02_full_frames",
       "SELECT id AS event_id, " + rounded("quantile_cont(v, 0.9) OVER (PARTITION BY location ORDER BY ts, id "
                                           "ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)", "percentile") + " FROM long",
       long_cte([TVOC]).replace("device_id", "location"))
def h02_full(spark, d):
    out = rolling.rolling_percentile(readings(spark, d), TVOC, 0.9, spec=SLICED)
    return tidy(out.select("event_id", "percentile"))


_SIX, _FIVE = str(seq.SIX_HOURS), "300"


@query("h03_five_minutes",
       "SELECT location, sec AS at, " + ", ".join(rounded(n, n, 6) for n in (
           "rate", "error_rate", "anomaly_rate", "quality")) + ", " + rounded("seconds", "processing_seconds", 6)
       + " FROM rates",
       seq._RATES.replace(_SIX, _FIVE))
def h03_five(spark, d):
    out = rolling.rolling_rates(seq._log(spark, d), ["location"], seconds=300, spec=SPEC)
    return tidy(out.select("location", "at", "rate", "error_rate", "anomaly_rate", "quality", "processing_seconds"), 6)


@query("h06_sliced",
       "SELECT id AS event_id, " + rounded("sum(delta) OVER (PARTITION BY location ORDER BY sec RANGE BETWEEN 300 "
                                           "PRECEDING AND CURRENT ROW) / 300.0e0", "rate", 6) + " FROM delta",
       """cnt AS (SELECT id, ts, sec, location, id % 500 AS x,
  lag(id % 500) OVER (PARTITION BY location ORDER BY ts, id) AS before FROM r),
delta AS (SELECT *, CASE WHEN before IS NULL THEN 0 WHEN x < before THEN x ELSE x - before END AS delta FROM cnt)""")
def h06_sliced(spark, d):
    df = readings(spark, d).select("event_id", "timestamp", "location", (F.col("event_id") % 500).alias("counter"))
    return tidy(rolling.counter_rate(df, ["location"], "counter", seconds=300, spec=SLICED).select("event_id", "rate"), 6)


