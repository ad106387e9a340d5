"""Queries: rolling windows, counters, sustained conditions and processing metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorlake.catalog.base import SHORT, SPEC, long_cte, query, readings, rounded, tidy, unioned
from sensorlake.functions.columns import rows_from
from sensorlake.operators import patterns, rolling, scoring, validate, windows
from sensorlake.plans.processing import processing_log
from sensorlake.spec import RULES, TVOC, c

SIX_HOURS = 21600

_ALERTS = " + ".join(f"cast({cond} AS int)" for cond in (
    "coalesce(t, 0) > 50 OR coalesce(t, 0) < -10", "coalesce(h, 0) > 90 OR coalesce(h, 0) < 10",
    "tvoc > 1000", "eco2 > 1000", "pm25 > 35", "alarm = 1"))
_FAILED = " OR ".join(
    f"coalesce({SHORT[r.channel]} < {r.lo}" + (f" OR {SHORT[r.channel]} > {r.hi}" if r.hi is not None else "")
    + ", false)" for r in RULES)
_LOG = f"""plog AS (
  SELECT *, CASE WHEN alerts = 0 THEN 1.0e0 ELSE 0.8e0 END AS quality FROM (
    SELECT id, ts, sec, device_id, location, {_FAILED} AS failed, value AS ms, {_ALERTS} AS alerts FROM r))"""
_RATES = _LOG + f""",
secs AS (
  SELECT location, sec, count(CASE WHEN NOT failed THEN 1 END) AS p, count(CASE WHEN failed THEN 1 END) AS f,
    count(CASE WHEN NOT failed AND alerts > 0 THEN 1 END) AS a,
    sum(CASE WHEN NOT failed THEN quality END) AS q, sum(CASE WHEN NOT failed THEN ms END) AS ms
  FROM plog GROUP BY location, sec),
win AS (
  SELECT location, sec, sum(p) OVER w AS p, sum(f) OVER w AS f, sum(a) OVER w AS a, sum(q) OVER w AS q,
    sum(ms) OVER w AS ms FROM secs
  WINDOW w AS (PARTITION BY location ORDER BY sec RANGE BETWEEN {SIX_HOURS} PRECEDING AND CURRENT ROW)),
rates AS (
  SELECT location, sec, p / {SIX_HOURS}.0e0 AS rate, CASE WHEN p + f = 0 THEN 0 ELSE f / (p + f) END AS error_rate,
    CASE WHEN p = 0 THEN 0 ELSE f / p END AS error_ratio, CASE WHEN p = 0 THEN 0 ELSE a / p END AS anomaly_rate,
    CASE WHEN p = 0 THEN 0 ELSE q / p END AS quality, CASE WHEN p = 0 THEN 0 ELSE ms / p / 1000 END AS seconds
  FROM win)"""


def _log(spark, d):
    return processing_log(readings(spark, d), c("NC2.5") / 2)


def _rates(spark, d):
    return rolling.rolling_rates(_log(spark, d), ["location"], seconds=SIX_HOURS, spec=SPEC)


@query("h02_rolling_percentile",
       f"SELECT id AS event_id, {rounded('v', 'value')}, "
       + rounded("quantile_cont(v, 0.9) OVER (PARTITION BY device_id ORDER BY ts, id "
                 "ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)", "percentile") + " FROM long",
       long_cte([TVOC]))
def h02(spark, d):
    out = rolling.rolling_percentile(readings(spark, d), TVOC, 0.9, spec=SPEC)
    return tidy(out.select("event_id", "value", "percentile"))


@query("h03_rolling_rates",
       "SELECT location, sec AS at, " + ", ".join(
           rounded(n, n, 6) for n in ("rate", "error_rate", "anomaly_rate", "quality")) + " FROM rates", _RATES)
def h03(spark, d):
    return tidy(_rates(spark, d).drop("error_ratio", "processing_seconds"), 6)


@query("e29_rate_ratios",
       "SELECT location, sec AS at, " + rounded("error_ratio", "error_ratio", 6) + ", "
       + rounded("anomaly_rate", "anomaly_rate", 6) + ", " + rounded("seconds", "processing_seconds", 6)
       + " FROM rates", _RATES)
def e29(spark, d):
    return tidy(_rates(spark, d).select("location", "at", "error_ratio", "anomaly_rate",
                                        "processing_seconds"), 6)


@query("h04_rolling_means",
       f"SELECT id AS event_id, " + ", ".join(
           rounded(f"avg({v}) OVER w", n) for v, n in (("ms", "mean_ms"), ("quality", "mean_quality")))
       + " FROM plog WINDOW w AS (PARTITION BY location ORDER BY ts, id ROWS BETWEEN 999 PRECEDING AND CURRENT ROW)",
       _LOG)
def h04(spark, d):
    out = rolling.rolling_mean(_log(spark, d), ["location"],
                               {"mean_ms": "processing_ms", "mean_quality": "quality"}, spec=SPEC)
    return tidy(out.select("event_id", "mean_ms", "mean_quality"))


@query("h05_batch_numbers",
       "SELECT id AS event_id, rn AS row_index, rn // 1000 AS batch_index, rn % 1000 AS index_in_batch FROM "
       "(SELECT id, row_number() OVER (ORDER BY ts, id) - 1 AS rn FROM r)")
def h05(spark, d):
    out = rolling.numbered(readings(spark, d).select("event_id", "timestamp"), spec=SPEC)
    return tidy(out.drop("timestamp"))


@query("h06_counter_rate",
       "SELECT id AS event_id, location, " + rounded(f"sum(delta) OVER (PARTITION BY location ORDER BY sec "
       f"RANGE BETWEEN {SIX_HOURS} PRECEDING AND CURRENT ROW) / {SIX_HOURS}.0e0", "rate", 6) + " FROM delta",
       """cnt AS (SELECT id, ts, sec, location, id % 500 AS x,
  lag(id % 500) OVER (PARTITION BY location ORDER BY ts, id) AS before FROM r),
delta AS (SELECT *, CASE WHEN before IS NULL THEN 0 WHEN x < before THEN x ELSE x - before END AS delta FROM cnt)""")
def h06(spark, d):
    df = readings(spark, d).select("event_id", "timestamp", "location",
                                   (F.col("event_id") % 500).alias("counter"))
    out = rolling.counter_rate(df, ["location"], "counter", seconds=SIX_HOURS, spec=SPEC)
    return tidy(out.select("event_id", "location", "rate"), 6)


@query("h07_running_means",
       "SELECT id AS event_id, location, count(*) OVER w AS running_count, " + rounded("avg(ms) OVER w", "mean_ms")
       + ", " + rounded("avg(quality) OVER w", "mean_quality")
       + " FROM plog WINDOW w AS (PARTITION BY location ORDER BY ts, id)", _LOG)
def h07(spark, d):
    out = rolling.running_means(_log(spark, d), ["location"],
                                {"mean_ms": "processing_ms", "mean_quality": "quality"}, spec=SPEC)
    return tidy(out.select("event_id", "location", "running_count", "mean_ms", "mean_quality"))


def _islands(table: str, key: str, flag: str, seconds: int, order: str, name: str) -> str:
    return (f"SELECT {key}, min(sec) AS start_time, max(sec) AS end_time, '{name}' AS alert, "
            f"max(sec) - min(sec) AS duration_seconds FROM ("
            f"SELECT *, sum(change) OVER (PARTITION BY {key} ORDER BY {order}) AS island FROM ("
            f"SELECT *, CASE WHEN {flag} = lag({flag}) OVER (PARTITION BY {key} ORDER BY {order}) THEN 0 ELSE 1 END AS change "
            f"FROM {table})) WHERE {flag} GROUP BY {key}, island HAVING max(sec) - min(sec) >= {seconds}")


@query("h08_sustained_alert", _islands("flagged", "location", "hit", 3600, "ts, id", "TVOC above 200"),
       "flagged AS (SELECT *, coalesce(tvoc > 200, false) AS hit FROM r)")
def h08(spark, d):
    rule = {"TVOC above 200": (c(TVOC) > 200, 3600)}
    return tidy(rolling.sustained(readings(spark, d), ["location"], ["timestamp", "event_id"], rule, SPEC))


_RULE_HITS = {"HighTemperature": "t > 30", "HighTVOC": "tvoc > 1000", "HighCO2": "eco2 > 1000",
              "HighPM25": "pm25 > 35"}


@query("h08_sustained_rules",
       unioned([_islands(f"(SELECT *, coalesce({cond}, false) AS hit FROM r)", "location", "hit", 300, "ts, id", name)
                for name, cond in _RULE_HITS.items()]))
def h08_rules(spark, d):
    return tidy(rolling.sustained_rules(readings(spark, d), ["location"], spec=SPEC))


@query("h08_sustained_rates",
       unioned([_islands(f"(SELECT *, {cond} AS hit FROM rates)", "location", "hit", 300, "sec", name)
                for name, cond in (("HighErrorRate", "error_ratio > 0.05"), ("LowProcessingRate", "rate < 1"),
                                   ("PoorDataQuality", "quality < 0.8"), ("HighAnomalyRate", "anomaly_rate > 0.1"),
                                   ("ProcessingDelay", "seconds > 1"))]), _RATES)
def h08_rates(spark, d):
    names = ["HighErrorRate", "LowProcessingRate", "PoorDataQuality", "HighAnomalyRate", "ProcessingDelay"]
    return tidy(rolling.sustained_rate_rules(_rates(spark, d), ["location"], names, SPEC))


_GAUGES = ["Temperature[C]", "Humidity[%]", "TVOC[ppb]", "eCO2[ppm]", "Pressure[hPa]", "PM1.0", "PM2.5"]


@query("h09_latest_values",
       f"SELECT device_id, channel, {rounded('arg_max(v, sec * 1000000000 + id)', 'value')} FROM long GROUP BY 1, 2",
       long_cte(_GAUGES))
def h09(spark, d):
    return tidy(rolling.latest_values(readings(spark, d), _GAUGES).where("value IS NOT NULL"))


@query("m14_health_warnings", unioned([
    f"SELECT location, sec AS at, '{name}' AS warning, {rounded(v, 'value', 6)} FROM rates WHERE {cond}"
    for name, v, cond in (("HIGH_ERROR_RATE", "error_rate", "error_rate > 0.05"),
                          ("LOW_QUALITY", "quality", "quality < 0.8"), ("LOW_RATE", "rate", "rate < 1"))]), _RATES)
def m14(spark, d):
    return tidy(rolling.health_warnings(_rates(spark, d), "location", "at"), 6)


@query("e27_interval_metrics",
       "SELECT (sec // 86400) * 86400 AS window_start, (sec // 86400) * 86400 + 86400 AS window_end, "
       "count(CASE WHEN NOT failed THEN 1 END) AS processed, count(CASE WHEN failed THEN 1 END) AS failed, "
       + rounded("100.0e0 * count(CASE WHEN NOT failed THEN 1 END) / count(*)", "success_rate") + ", "
       + rounded("count(*) / 86400.0e0", "throughput") + ", "
       + rounded("avg(CASE WHEN NOT failed THEN ms END)", "mean_ms") + ", "
       + rounded("avg(CASE WHEN NOT failed THEN quality END)", "mean_quality")
       + ", count(CASE WHEN NOT failed AND alerts > 0 THEN 1 END) AS anomalies, "
         "cast(sum(CASE WHEN NOT failed THEN alerts ELSE 0 END) AS bigint) AS alerts FROM plog GROUP BY 1, 2", _LOG)
def e27(spark, d):
    return tidy(windows.with_bounds(scoring.interval_metrics(_log(spark, d), "1 day", 86400.0)))


_EDGES = scoring.TIME_BUCKETS


@query("e30_time_histogram", unioned(
    [f"SELECT location, '{e}' AS le, count(CASE WHEN ms / 1000 <= {e}e0 THEN 1 END) AS count, "
     f"{rounded('sum(ms / 1000)', 'total_seconds')} FROM plog GROUP BY location" for e in _EDGES]
    + [f"SELECT location, '+Inf', count(ms), {rounded('sum(ms / 1000)', 'total_seconds')} FROM plog GROUP BY location"]),
    _LOG)
def e30(spark, d):
    return tidy(scoring.time_histogram(_log(spark, d), "location", "processing_ms"))


@query("e31_labelled_counts", unioned([
    "SELECT 'alarm' AS kind, location AS label, count(*) AS n FROM r WHERE alarm = 1 GROUP BY 2",
    "SELECT 'prediction', CASE WHEN t > 60 THEN 'Fire Detected' ELSE 'No Fire' END, count(*) FROM r GROUP BY 2",
    *[f"SELECT 'failure', '{SHORT[r.channel]}', count(*) FROM r WHERE {SHORT[r.channel]} < {r.lo}"
      + (f" OR {SHORT[r.channel]} > {r.hi}" if r.hi is not None else "") + " HAVING count(*) > 0"
      for r in RULES]]))
def e31(spark, d):
    df = readings(spark, d)
    alarms = scoring.labelled_counts(df.where(c("Fire Alarm") == 1).select(
        F.lit("alarm").alias("kind"), F.col("location").alias("label")), "kind", "label")
    predicted = scoring.labelled_counts(scoring.rule_scores(df).select(
        F.lit("prediction").alias("kind"), F.col("prediction_label").alias("label")), "kind", "label")
    failing = [F.when(validate.out_of_range(r, c(r.channel)), F.struct(
        F.lit(SHORT[r.channel]).alias("label"), F.lit("failure").alias("kind"))) for r in RULES]
    failures = scoring.labelled_counts(rows_from(df, [], failing), "kind", "label")
    return alarms.unionByName(predicted).unionByName(failures)


@query("k01_newest_rows",
       "SELECT id AS event_id, sec AS ts, device_id FROM r ORDER BY r.ts DESC, id DESC LIMIT 1000")
def k01(spark, d):
    return tidy(patterns.newest(readings(spark, d), 1000).select(
        "event_id", F.col("timestamp").alias("ts"), "device_id"))


@query("k06_first_alerts",
       "SELECT id AS event_id, " + rounded("t", "value") + " FROM r WHERE t > 50 ORDER BY id LIMIT 10")
def k06(spark, d):
    hot = readings(spark, d).where(c("Temperature[C]") > 50)
    return tidy(patterns.first_rows(hot, 10, "event_id").select("event_id", c("Temperature[C]").alias("value")))


_PLAN = """plan AS (
  SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice, rn > 5 AS surplus,
    o_orderdate < DATE '1995-06-01' AS expired FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders))"""


def _retention(spark, d):
    return patterns.retention_plan(spark.read.parquet(f"{d}/orders.parquet"), "o_custkey", "o_orderdate",
                                   "o_orderkey", "o_totalprice", "1995-07-01")


@query("k07_retention_plan",
       "SELECT o_custkey, o_orderkey, cast(floor(epoch(o_orderdate)) AS bigint) AS o_orderdate, "
       + rounded("o_totalprice", "o_totalprice") + ", surplus, expired FROM plan WHERE surplus OR expired", _PLAN)
def k07(spark, d):
    return tidy(_retention(spark, d))


@query("k07_retention_summary",
       "SELECT o_custkey, count(CASE WHEN surplus THEN 1 END) AS surplus_items, "
       "count(CASE WHEN expired THEN 1 END) AS expired_items, " + rounded("sum(o_totalprice)", "freed", 2)
       + " FROM plan WHERE surplus OR expired GROUP BY o_custkey", _PLAN)
def k07_summary(spark, d):
    return tidy(patterns.retention_summary(_retention(spark, d), "o_custkey", "o_totalprice"), 2)
