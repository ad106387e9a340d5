"""Queries: windows, alerts and quality of readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.catalog.base import (SHORT, SPEC, hops, long_cte, query, readings, rounded, tidy,
                                     unioned)
from sensorlake.operators import alerts, quality, rolling, windows
from sensorlake.operators.scoring import rule_scores
from sensorlake.plans.detect import detect_all
from sensorlake.spec import DOUBLE_CHANNELS, LADDERS, QUALITY_CHANNELS, REQUIRED_CHANNELS, c

DAY, SLIDE = 86400, 21600

_WINDOW_AGG = f"""win AS (
  SELECT ws AS window_start, we AS window_end,
    avg(t) AS avg_temperature, avg(h) AS avg_humidity, avg(tvoc) AS avg_tvoc, avg(eco2) AS avg_eco2,
    avg(pm25) AS avg_pm25, avg(pm1) AS avg_pm10, avg(pressure) AS avg_pressure, avg(h2) AS avg_h2,
    avg(ethanol) AS avg_ethanol, max(t) AS max_temperature, min(t) AS min_temperature,
    max(h) AS max_humidity, min(h) AS min_humidity, max(tvoc) AS max_tvoc, max(pm25) AS max_pm25,
    stddev_samp(t) AS temp_stddev, stddev_samp(h) AS humidity_stddev, stddev_samp(tvoc) AS tvoc_stddev,
    var_samp(t) AS temp_variance, quantile_disc(t, 0.5) AS temp_median,
    quantile_disc(tvoc, 0.95) AS tvoc_95th_percentile,
    count(*) AS record_count, count(CASE WHEN alarm = 1 THEN 1 END) AS fire_alarm_count,
    cast(sum(CASE WHEN alarm = 1 THEN 1 ELSE 0 END) AS bigint) AS total_fire_alarms,
    count(CASE WHEN t IS NULL THEN 1 END) AS null_temperature_count,
    count(CASE WHEN tvoc IS NULL THEN 1 END) AS null_tvoc_count
  FROM hops GROUP BY ws, we)"""
_WINDOW_CTES = hops(DAY, SLIDE) + ",\n" + _WINDOW_AGG
_DOUBLES = ("avg_temperature avg_humidity avg_tvoc avg_eco2 avg_pm25 avg_pm10 avg_pressure avg_h2 "
            "avg_ethanol max_temperature min_temperature max_humidity min_humidity max_tvoc max_pm25 "
            "temp_stddev humidity_stddev tvoc_stddev temp_variance temp_median "
            "tvoc_95th_percentile").split()
_COUNTS = ("record_count fire_alarm_count total_fire_alarms null_temperature_count "
           "null_tvoc_count").split()


def _windows(spark, d) -> DataFrame:
    return windows.window_analytics(readings(spark, d), "1 day", "6 hours", spec=SPEC)


@query("e01_window_analytics",
       "SELECT window_start, window_end, " + ", ".join(rounded(n, n) for n in _DOUBLES) + ", "
       + ", ".join(_COUNTS) + " FROM win", _WINDOW_CTES)
def e01(spark, d):
    exact = windows.with_exact_quantiles(_windows(spark, d), readings(spark, d), "1 day", "6 hours", spec=SPEC)
    return tidy(windows.with_bounds(exact.drop("unique_devices", "unique_locations")))


@query("e01_window_members",
       "SELECT ws AS window_start, we AS window_end, device_id, location, count(*) AS readings "
       "FROM hops GROUP BY ALL", hops(DAY, SLIDE))
def e01_members(spark, d):
    return tidy(windows.with_bounds(windows.window_members(readings(spark, d), "1 day", "6 hours")))


@query("e02_unique_devices",
       "SELECT ws AS window_start, we AS window_end, count(DISTINCT device_id) AS unique_devices "
       "FROM hops GROUP BY ALL", hops(DAY, SLIDE))
def e02(spark, d):
    return tidy(windows.with_bounds(windows.unique_devices(readings(spark, d), "1 day", "6 hours")))


@query("e03_device_windows",
       f"SELECT (sec // {DAY}) * {DAY} AS window_start, (sec // {DAY}) * {DAY} + {DAY} AS window_end, "
       f"device_id, count(*) AS readings, {rounded('avg(t)', 'avg_temperature')}, "
       f"{rounded('max(t)', 'max_temperature')}, {rounded('min(t)', 'min_temperature')} "
       "FROM r GROUP BY 1, 2, 3")
def e03(spark, d):
    return tidy(windows.with_bounds(windows.device_windows(readings(spark, d), "1 day")))


@query("e28_gauge_means",
       "SELECT (sec // 21600) * 21600 AS window_start, (sec // 21600) * 21600 + 21600 AS window_end, "
       + ", ".join(rounded(f"avg({s})", n) for s, n in (
           ("t", "temperature_avg"), ("h", "humidity_avg"), ("tvoc", "tvoc_avg"),
           ("eco2", "eco2_avg"), ("pressure", "pressure_avg"), ("pm25", "pm_avg")))
       + " FROM r GROUP BY 1, 2")
def e28(spark, d):
    return tidy(windows.with_bounds(windows.gauge_means(readings(spark, d), "6 hours")))


_M1 = """
SELECT window_start, window_end, sensor, severity, round(value + 3e-08, 4) + 0.0e0 AS value, threshold FROM (
  SELECT window_start, window_end, 'TEMPERATURE' AS sensor,
    CASE WHEN avg_temperature > 80 THEN 'CRITICAL' WHEN avg_temperature > 50 THEN 'HIGH' ELSE 'LOW' END AS severity,
    avg_temperature AS value,
    CASE WHEN avg_temperature > 80 THEN 80.0e0 WHEN avg_temperature > 50 THEN 50.0e0 ELSE -10.0e0 END AS threshold
  FROM {w} WHERE avg_temperature <> 0 AND (avg_temperature > 50 OR avg_temperature < -10)
  UNION ALL
  SELECT window_start, window_end, 'TVOC', CASE WHEN avg_tvoc > 2000 THEN 'CRITICAL' ELSE 'HIGH' END, avg_tvoc,
    CASE WHEN avg_tvoc > 2000 THEN 2000.0e0 ELSE 1000.0e0 END FROM {w} WHERE avg_tvoc > 1000
  UNION ALL
  SELECT window_start, window_end, 'PM2.5', CASE WHEN avg_pm25 > 75 THEN 'CRITICAL' ELSE 'HIGH' END, avg_pm25,
    CASE WHEN avg_pm25 > 75 THEN 75.0e0 ELSE 35.0e0 END FROM {w} WHERE avg_pm25 > 35
  UNION ALL
  SELECT window_start, window_end, 'FIRE_ALARM', 'CRITICAL', cast(fire_alarm_count AS double), 0.0e0
  FROM {w} WHERE fire_alarm_count > 0)"""


# Ten-minute windows hold few readings, so that their averages reach the limits.
_SHORT_WIN = """win10 AS (
  SELECT (sec // 600) * 600 AS window_start, (sec // 600) * 600 + 600 AS window_end,
    avg(t) AS avg_temperature, avg(tvoc) AS avg_tvoc, avg(pm25) AS avg_pm25,
    count(CASE WHEN alarm = 1 THEN 1 END) AS fire_alarm_count
  FROM r GROUP BY 1, 2)"""


def _short_windows(spark, d):
    return windows.window_analytics(readings(spark, d), "10 minutes", "10 minutes", spec=SPEC)


@query("m01_window_alerts", _M1.format(w="win10"), _SHORT_WIN)
def m01(spark, d):
    found = alerts.explode_alerts(_short_windows(spark, d), alerts.window_alerts(), "window")
    return tidy(windows.with_bounds(found.drop("message", "alert_type")))


@query("m02_alert_history",
       "SELECT window_start, window_end, window_end AS raised_at, sensor, severity, value, threshold "
       f"FROM ({_M1.format(w='win')})", _WINDOW_CTES)
def m02(spark, d):
    history = alerts.alert_history(_windows(spark, d), SPEC)
    return tidy(windows.with_bounds(
        history.withColumnRenamed("timestamp", "raised_at").drop("message", "alert_type")))


_ROW_VALUES = ("rv AS (SELECT id, coalesce(t, 0) AS t, coalesce(h, 0) AS h, coalesce(tvoc, 0) AS tvoc, "
               "coalesce(eco2, 0) AS eco2, coalesce(pm25, 0) AS pm25, alarm FROM r)")
_M3_PARTS = [
    ("t > 50", "Temperature[C]", "HIGH", "t", "50", "High temperature: #°C"),
    ("t < -10", "Temperature[C]", "LOW", "t", "-10", "Low temperature: #°C"),
    ("h > 90", "Humidity[%]", "HIGH", "h", "90", "High humidity: #%"),
    ("h < 10", "Humidity[%]", "LOW", "h", "10", "Low humidity: #%"),
    ("tvoc > 1000", "TVOC[ppb]", "HIGH", "tvoc", "1000", "High TVOC: # ppb"),
    ("eco2 > 1000", "eCO2[ppm]", "HIGH", "eco2", "1000", "High eCO2: # ppm"),
    ("pm25 > 35", "PM2.5", "HIGH", "pm25", "35", "High PM2.5: # μg/m³"),
    ("alarm = 1", "Fire Alarm", "CRITICAL", "cast(alarm AS double)", "1", "FIRE ALARM ACTIVATED!"),
]
_M3 = unioned([
    f"SELECT id AS event_id, '{sensor}' AS sensor, {rounded(v, 'value')}, "
    f"cast({limit} AS double) AS threshold, '{severity}' AS severity, '{said}' AS said FROM rv WHERE {cond}"
    for cond, sensor, severity, v, limit, said in _M3_PARTS])


def said(found: DataFrame) -> DataFrame:
    """Alerts with their message, in which # stands for the value: the engines print doubles differently."""
    own = F.concat(F.lit(": "), F.col("value").cast("string"))
    return tidy(found.withColumn("said", F.replace("message", own, F.lit(": #"))).drop("message", "alert_type"))


@query("m03_reading_alerts", _M3, _ROW_VALUES)
def m03(spark, d):
    return said(alerts.explode_alerts(readings(spark, d), alerts.reading_alerts(), "event_id"))


_LADDER_WORDS = {("CRITICAL", "<"): "Critically low", ("CRITICAL", ">"): "Critically high", ("HIGH", "<"): "Low",
                 ("HIGH", ">"): "High", ("MEDIUM", ">"): "Elevated"}


def _ladder_parts() -> list[str]:
    parts = []
    for lad in LADDERS:
        v = SHORT[lad.channel]
        whens = []
        for limit, side, severity in ((lad.low_critical, "<", "CRITICAL"), (lad.high_critical, ">", "CRITICAL"),
                                      (lad.low_high, "<", "HIGH"), (lad.high_high, ">", "HIGH"),
                                      (lad.high_medium, ">", "MEDIUM")):
            if limit is not None:
                whens.append((f"{v} {side} {limit}", severity, limit, _LADDER_WORDS[severity, side]))
        sev = " ".join(f"WHEN {w} THEN '{s}'" for w, s, _, _ in whens)
        thr = " ".join(f"WHEN {w} THEN {x}e0" for w, _, x, _ in whens)
        text = " ".join(f"WHEN {w} THEN '{word} {lad.channel}: #'" for w, _, _, word in whens)
        parts.append(f"SELECT id AS event_id, '{lad.channel}' AS sensor, {rounded(v, 'value')}, "
                     f"CASE {thr} END AS threshold, CASE {sev} END AS severity, CASE {text} END AS said FROM r "
                     f"WHERE CASE {sev} END IS NOT NULL")
    return parts


_M4 = unioned(_ladder_parts())


@query("m04_severity_ladder", _M4)
def m04(spark, d):
    return said(alerts.explode_alerts(readings(spark, d), alerts.ladder_alerts(), "event_id"))


_PATTERN = """pat AS (
  SELECT id, alarm, cast(t > 45 AS int) + cast(tvoc > 800 AS int) + cast(eco2 > 800 AS int)
    + cast(pm25 > 30 AS int) AS hits
  FROM r WHERE t IS NOT NULL AND tvoc IS NOT NULL AND eco2 IS NOT NULL AND pm25 IS NOT NULL
    AND alarm IS NOT NULL)"""
_M5 = """
SELECT id AS event_id, 'Fire Alarm' AS sensor, 1.0e0 AS value, 1.0e0 AS threshold, 'CRITICAL' AS severity,
  'FIRE ALARM ACTIVATED!' AS said FROM pat WHERE alarm = 1
UNION ALL
SELECT id, 'Fire Pattern', cast(hits AS double), CASE WHEN hits >= 3 THEN 3.0e0 ELSE 2.0e0 END,
  CASE WHEN hits >= 3 THEN 'CRITICAL' ELSE 'HIGH' END,
  CASE WHEN hits >= 3 THEN 'Fire pattern detected: ' ELSE 'Potential fire risk: ' END || hits || '/4 indicators active'
FROM pat WHERE hits >= 2"""


@query("m05_fire_pattern", _M5, _PATTERN)
def m05(spark, d):
    return said(alerts.explode_alerts(readings(spark, d), alerts.pattern_alerts(), "event_id"))


_ROLL = long_cte(list(DOUBLE_CHANNELS)) + """,
roll AS (
  SELECT *, avg(v) OVER w AS mean, stddev_pop(v) OVER w AS std, count(*) OVER w AS n FROM long
  WINDOW w AS (PARTITION BY device_id, channel ORDER BY ts, id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)),
zs AS (SELECT *, CASE WHEN n >= 30 AND std > 0 THEN abs(v - mean) / std END AS z FROM roll)"""


@query("h01_rolling_zscore",
       f"SELECT id AS event_id, channel, {rounded('v', 'value')}, {rounded('mean', 'mean')}, "
       f"{rounded('std', 'std')}, n, {rounded('z', 'z')}, CASE WHEN z > 4 THEN 'HIGH' ELSE 'MEDIUM' END "
       "AS severity FROM zs WHERE z > 3", _ROLL)
def h01(spark, d):
    scores = rolling.rolling_scores(readings(spark, d), spec=SPEC)
    return tidy(scores.where("z > 3").select(
        "event_id", "channel", "value", "mean", "std", "n", "z",
        F.when(F.col("z") > 4, "HIGH").otherwise("MEDIUM").alias("severity")))


_M6 = unioned([
    f"SELECT event_id, sensor, value, threshold, severity, 'THRESHOLD' AS alert_type FROM ({_M4})",
    f"SELECT event_id, sensor, value, threshold, severity, 'PATTERN' AS alert_type FROM ({_M5})",
    f"SELECT id AS event_id, channel AS sensor, {rounded('v', 'value')}, 3.0e0 AS threshold, "
    "CASE WHEN z > 4 THEN 'HIGH' ELSE 'MEDIUM' END AS severity, 'STATISTICAL' AS alert_type "
    "FROM zs WHERE z > 3"])


@query("m06_all_alerts", _M6, _PATTERN + ",\n" + _ROLL)
def m06(spark, d):
    return tidy(detect_all(readings(spark, d), SPEC).drop("message"))


_L2 = unioned([
    f"SELECT event_id, sensor, value, threshold, severity, said, 'BASIC' AS alert_type FROM ({_M3})",
    "SELECT id AS event_id, 'ML' AS sensor, 0.8e0 AS value, 0.5e0 AS threshold, 'HIGH' AS severity, "
    "'Fire predicted with confidence 0.80' AS said, 'ML_FIRE_PREDICTION' AS alert_type FROM r WHERE t > 60"])


@query("l02_combined_alerts", _L2, _ROW_VALUES)
def l02(spark, d):
    scored = rule_scores(readings(spark, d))
    both = [*alerts.reading_alerts(), *alerts.prediction_alerts()]
    found = alerts.explode_alerts(scored, both, "event_id")
    return said(found.withColumn("kind", F.col("alert_type"))).withColumnRenamed("kind", "alert_type")


_WQ = """SELECT window_start, window_end, record_count,
  greatest(0.0e0, 100.0e0 - CASE WHEN record_count < 10 THEN 20 ELSE 0 END
    - CASE WHEN temp_stddev <> 0 AND temp_stddev < 0.1 THEN 15 ELSE 0 END
    - CASE WHEN max_temperature > 100 THEN 25 ELSE 0 END
    - CASE WHEN min_temperature < -50 THEN 25 ELSE 0 END) AS quality_score,
  cast(CASE WHEN record_count < 10 THEN 1 ELSE 0 END
    + CASE WHEN temp_stddev <> 0 AND temp_stddev < 0.1 THEN 1 ELSE 0 END
    + CASE WHEN max_temperature > 100 THEN 1 ELSE 0 END
    + CASE WHEN min_temperature < -50 THEN 1 ELSE 0 END AS bigint) AS issues,
  least(100.0e0, cast(record_count AS double)) AS data_completeness FROM win"""


@query("m07_window_quality", _WQ, _WINDOW_CTES)
def m07(spark, d):
    out = quality.with_window_quality(_windows(spark, d))
    return tidy(windows.with_bounds(out.select(
        "window", "record_count", "quality_score", F.size("quality_issues").alias("issues"),
        "data_completeness")))


_MISSING = " + ".join(f"CASE WHEN {SHORT[n]} IS NULL THEN 1 ELSE 0 END" for n in REQUIRED_CHANNELS)
_RQ = f"""SELECT id AS event_id, greatest(0.0e0, 100.0e0 - 10 * ({_MISSING})
    - CASE WHEN t > 100 OR t < -50 THEN 20 ELSE 0 END - CASE WHEN h > 100 OR h < 0 THEN 15 ELSE 0 END
    - CASE WHEN tvoc < 0 THEN 10 ELSE 0 END) AS quality_score,
  cast(CASE WHEN ({_MISSING}) > 0 THEN 1 ELSE 0 END + CASE WHEN t > 100 OR t < -50 THEN 1 ELSE 0 END
    + CASE WHEN h > 100 OR h < 0 THEN 1 ELSE 0 END + CASE WHEN tvoc < 0 THEN 1 ELSE 0 END AS bigint) AS issues
FROM r"""


@query("m08_reading_quality", f"SELECT * FROM ({_RQ}) WHERE quality_score < 100")
def m08(spark, d):
    score, issues = quality.reading_quality()
    return tidy(readings(spark, d).select("event_id", score.alias("quality_score"),
                                          F.size(issues).alias("issues"))
                .where("quality_score < 100"))


@query("m09_message_quality",
       f"SELECT r.id AS event_id, CASE WHEN a.event_id IS NULL THEN 1.0e0 ELSE 0.8e0 END AS quality "
       f"FROM r LEFT JOIN (SELECT DISTINCT event_id FROM ({_M3})) a ON a.event_id = r.id", _ROW_VALUES)
def m09(spark, d):
    return readings(spark, d).select(
        "event_id", quality.message_quality(alerts.alert_count(alerts.reading_alerts())).alias("quality"))


@query("m10_prediction_alerts",
       "SELECT id AS event_id, 'ML_FIRE_PREDICTION' AS alert_type, 0.8e0 AS confidence, "
       f"{rounded('t', 'temperature')} FROM r WHERE t > 60")
def m10(spark, d):
    found = alerts.explode_alerts(rule_scores(readings(spark, d)), alerts.prediction_alerts(),
                                  "event_id", "Temperature[C]")
    return tidy(found.select("event_id", "alert_type", F.col("value").alias("confidence"),
                             c("Temperature[C]").alias("temperature")))


_QCOLS = list(REQUIRED_CHANNELS)


@query("e06_completeness", unioned([
    f"SELECT '{n}' AS channel, round(100 * count({SHORT[n]}) / count(*), 2) AS completeness FROM r"
    for n in _QCOLS]))
def e06(spark, d):
    return tidy(quality.completeness(readings(spark, d), _QCOLS))


@query("e07_type_issues", unioned([
    f"SELECT '{n}' AS channel, count({SHORT[n]}) AS present, cast(0 AS bigint) AS not_numeric, "
    "false AS issue FROM r" for n in QUALITY_CHANNELS]
    + ["SELECT 'o_orderpriority' AS channel, count(o_orderpriority) AS present, "
       "count(CASE WHEN o_orderpriority IS NOT NULL AND try_cast(o_orderpriority AS double) IS NULL "
       "THEN 1 END) AS not_numeric, true AS issue FROM orders"]))
def e07(spark, d):
    text = spark.read.parquet(f"{d}/orders.parquet")
    return tidy(quality.type_issues(readings(spark, d)).unionByName(
        quality.type_issues(text, ["o_orderpriority"])))


@query("e08_range_outliers",
       "SELECT count(CASE WHEN t < -50 OR t > 100 THEN 1 END) AS temperature_outliers, "
       "count(CASE WHEN h < 0 OR h > 100 THEN 1 END) AS humidity_outliers FROM r")
def e08(spark, d):
    return tidy(quality.range_outliers(readings(spark, d)))


_ORDER_COPY = ["l_orderkey", "l_linenumber"]


@query("e09_duplicates",
       "SELECT (SELECT cast(sum(n - 1) AS bigint) FROM (SELECT count(*) AS n FROM lineitem "
       "GROUP BY l_orderkey, l_linenumber)) AS line_duplicates, "
       "(SELECT cast(sum(n - 1) AS bigint) FROM (SELECT count(*) AS n FROM r GROUP BY ts, device_id, "
       f"location, {', '.join(SHORT.values())})) AS reading_duplicates")
def e09(spark, d):
    lines = quality.duplicate_count(spark.read.parquet(f"{d}/lineitem.parquet"), _ORDER_COPY)
    same = quality.duplicate_count(readings(spark, d), ["timestamp", "device_id", "location", *_QCOLS])
    return tidy(lines.withColumnRenamed("duplicates", "line_duplicates").crossJoin(
        F.broadcast(same.withColumnRenamed("duplicates", "reading_duplicates"))))   # one row each


def _fence_sql(table: str, pairs: list[tuple[str, str]]) -> str:
    parts = []
    for name, col in pairs:
        parts.append(
            f"SELECT '{name}' AS channel, {rounded('q1', 'q1')}, {rounded('q3', 'q3')}, "
            f"{rounded('q1 - 1.5e0 * (q3 - q1)', 'lower')}, {rounded('q3 + 1.5e0 * (q3 - q1)', 'upper')}, "
            f"(SELECT count(*) FROM {table} WHERE {col} < q1 - 1.5e0 * (q3 - q1) "
            f"OR {col} > q3 + 1.5e0 * (q3 - q1)) AS outliers "
            f"FROM (SELECT quantile_cont({col}, 0.25) AS q1, quantile_cont({col}, 0.75) AS q3 FROM {table})")
    return unioned(parts)


@query("e10_iqr_outliers", _fence_sql("r", [(n, SHORT[n]) for n in QUALITY_CHANNELS]))
def e10(spark, d):
    return tidy(quality.fence_outliers(readings(spark, d)))


_LINE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("e10_iqr_outliers_lineitem", _fence_sql("lineitem", [(n, n) for n in _LINE_COLS]))
def e10_lines(spark, d):
    # Few buckets, so that every rank takes several rounds.
    return tidy(quality.fence_outliers(spark.read.parquet(f"{d}/lineitem.parquet"), _LINE_COLS, buckets=8))


_SCORE = f"""score AS (
  SELECT round((complete + 100.0e0 + range_score + duplicate_score) / 4, 2) AS overall_score, *
  FROM (SELECT ({' + '.join(f'round(100 * count({SHORT[n]}) / count(*), 2)' for n in _QCOLS)}) / {len(_QCOLS)} AS complete,
      100.0e0 - 10 * (CASE WHEN count(CASE WHEN t < -50 OR t > 100 THEN 1 END) > 0 THEN 1 ELSE 0 END
        + CASE WHEN count(CASE WHEN h < 0 OR h > 100 THEN 1 END) > 0 THEN 1 ELSE 0 END) AS range_score
    FROM r),
    (SELECT 100 - 100.0e0 * sum(n - 1) / sum(n) AS duplicate_score, cast(sum(n - 1) AS bigint) AS duplicates
     FROM (SELECT count(*) AS n FROM r GROUP BY {', '.join(SHORT.values())})))"""


@query("e11_overall_score",
       f"SELECT {rounded('complete', 'completeness_score')}, 100.0e0 AS type_score, range_score, "
       f"{rounded('duplicate_score', 'duplicate_score')}, duplicates, overall_score FROM score", _SCORE)
def e11(spark, d):
    return tidy(quality.overall_score(readings(spark, d), _QCOLS).drop("n", "type_issues"))


_RECENT = """rec AS (SELECT * FROM r ORDER BY ts DESC, id DESC LIMIT 1000),
rl AS (
  SELECT 'Temperature[C]' AS channel, -10 AS lo, 60 AS hi, t AS v FROM rec
  UNION ALL SELECT 'Humidity[%]', 0, 100, h FROM rec
  UNION ALL SELECT 'TVOC[ppb]', 0, 5000, tvoc FROM rec
  UNION ALL SELECT 'PM2.5', 0, 500, pm25 FROM rec),
rs AS (SELECT channel, avg(v) AS m, stddev_samp(v) AS s FROM rl GROUP BY channel),
ra AS (
  SELECT channel, count(*) AS "rows", count(CASE WHEN v < lo OR v > hi THEN 1 END) AS range_anomalies,
    count(CASE WHEN abs(v - m) / s > 3 THEN 1 END) AS statistical_anomalies
  FROM rl JOIN rs USING (channel) GROUP BY channel)"""


@query("e12_recent_anomalies",
       'SELECT channel, "rows", range_anomalies, statistical_anomalies, '
       "range_anomalies + statistical_anomalies AS total_anomalies FROM ra", _RECENT)
def e12(spark, d):
    return tidy(quality.recent_anomalies(readings(spark, d)))


@query("e12_recent_anomaly_rate",
       "SELECT cast(sum(range_anomalies + statistical_anomalies) AS bigint) AS total_anomalies, "
       'round(100 * sum(range_anomalies + statistical_anomalies) / sum("rows"), 2) AS anomaly_rate FROM ra',
       _RECENT)
def e12_rate(spark, d):
    return tidy(quality.recent_anomaly_rate(quality.recent_anomalies(readings(spark, d))))


_FINDINGS = f"""
SELECT kind, finding, CAST(NULL AS varchar) AS channel, {rounded('value', 'value')} FROM (
  SELECT 'CRITICAL' AS kind, 'quality score below 70' AS finding, overall_score AS value, overall_score < 70 AS hit FROM score
  UNION ALL SELECT 'WARNING', 'anomaly rate above 10', rate, rate > 10 FROM rr
  UNION ALL SELECT 'RECOMMENDATION', 'investigate data sources', overall_score, overall_score < 80 FROM score
  UNION ALL SELECT 'RECOMMENDATION', 'review ingestion for duplicates', duplicates, duplicates > 100 FROM score
  UNION ALL SELECT 'RECOMMENDATION', 'check sensor calibration', rate, rate > 5 FROM rr) WHERE hit
UNION ALL
SELECT 'WARNING', 'completeness below 90', channel, completeness FROM (
  {unioned([f"SELECT '{n}' AS channel, round(100 * count({SHORT[n]}) / count(*), 2) AS completeness FROM narrow" for n in _QCOLS])})
WHERE completeness < 90"""


@query("m11_quality_findings", _FINDINGS, _SCORE + ",\n" + _RECENT + """,
rr AS (SELECT round(100 * sum(range_anomalies + statistical_anomalies) / sum("rows"), 2) AS rate FROM ra),
narrow AS (SELECT * FROM r)""")
def m11(spark, d):
    df = readings(spark, d)
    rate = quality.recent_anomaly_rate(quality.recent_anomalies(df))
    return tidy(quality.quality_findings(quality.overall_score(df, _QCOLS), rate, quality.completeness(df, _QCOLS)))
