"""Queries: profiles, patterns, features, predictions and their evaluation."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from sensorlake.catalog.base import SHORT, query, readings, rounded, tidy, unioned
from sensorlake.operators import evaluation, patterns, profile, quality, scoring, validate, windows
from sensorlake.operators.alerts import alert_count, reading_alerts
from sensorlake.plans import features
from sensorlake.plans.processing import processing_log
from sensorlake.spec import (ALARM, HUMIDITY, NUMERIC_CHANNELS, PM1, REQUIRED_CHANNELS,
                             TEMPERATURE, TVOC, c)

_ALL = list(REQUIRED_CHANNELS)

_PREDICTIONS = """preds AS (
  SELECT *, cast(score > 0.5e0 AS int) AS prediction, greatest(score, 1 - score) AS confidence FROM (
    SELECT *, round(coalesce(least(0.99e0, greatest(0.01e0, t / 100)), 0.01e0) + 1e-9, 2) AS score FROM r)),
p AS (
  SELECT *, CASE WHEN prediction <> 1 THEN 'NONE' WHEN confidence > 0.9e0 THEN 'CRITICAL'
    WHEN confidence > 0.7e0 THEN 'HIGH' ELSE 'MEDIUM' END AS alert_level FROM preds)"""
_N = rounded


def _predictions(spark, d):
    return scoring.linear_scores(readings(spark, d))


# Profiles and patterns.

@query("e04_daily_aggregate", unioned([
    f"SELECT strftime(ts, '%Y-%m-%d') AS ds, '{n}_{stat}' AS name, {_N(f'{f}({SHORT[n]})', 'value')} FROM r GROUP BY 1"
    for n in _ALL for stat, f in (("mean", "avg"), ("max", "max"), ("min", "min"))]))
def e04(spark, d):
    return tidy(profile.daily_aggregate(readings(spark, d), _ALL))


def _profile_sql(table: str, pairs) -> list[str]:
    return [f"SELECT '{n}' AS channel, count({s}) AS n, {_N(f'min({s})', 'min')}, {_N(f'max({s})', 'max')}, "
            f"{_N(f'avg({s})', 'mean')}, {_N(f'stddev_samp({s})', 'std')} FROM {table}" for n, s in pairs]


_LINE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


@query("e05_numeric_profile", unioned(
    _profile_sql("r", [(n, SHORT[n]) for n in NUMERIC_CHANNELS])
    + _profile_sql("lineitem", [(n, n) for n in _LINE_COLS])))
def e05(spark, d):
    lines = spark.read.parquet(f"{d}/lineitem.parquet")
    return tidy(profile.numeric_profile(readings(spark, d), NUMERIC_CHANNELS).unionByName(
        profile.numeric_profile(lines, _LINE_COLS)))


@query("e05_category_values", unioned([
    f"SELECT '{n}' AS channel, cast({s} AS varchar) AS value, count(*) AS n FROM r GROUP BY 2"
    for n, s in (("Fire Alarm", "alarm"), ("location", "location"), ("device_id", "device_id"))]))
def e05_categories(spark, d):
    return tidy(profile.category_values(readings(spark, d), [ALARM, "location", "device_id"]))


def _rate_sql(part: str, expr: str) -> str:
    return (f"SELECT cast({expr} AS bigint) AS {part}, count(*) AS readings, {_N('avg(alarm)', 'alarm_rate')} "
            "FROM r GROUP BY 1")


@query("e13_alarm_rate_by_hour", _rate_sql("hour", "hour(ts)"))
def e13_hour(spark, d):
    return tidy(patterns.alarm_rate_by(patterns.alarm_calendar(readings(spark, d)), "hour"))


@query("e13_alarm_rate_by_weekday", _rate_sql("weekday", "isodow(ts) - 1"))
def e13_weekday(spark, d):
    return tidy(patterns.alarm_rate_by(patterns.alarm_calendar(readings(spark, d)), "weekday"))


@query("k04_peaks",
       "SELECT (SELECT h FROM (SELECT cast(hour(ts) AS bigint) AS h, avg(alarm) AS a FROM r GROUP BY 1) ORDER BY a DESC, h LIMIT 1) AS peak_hour, "
       "(SELECT w FROM (SELECT cast(isodow(ts) - 1 AS bigint) AS w, avg(alarm) AS a FROM r GROUP BY 1) ORDER BY a DESC, w LIMIT 1) AS peak_weekday")
def k04(spark, d):
    calendar = patterns.alarm_calendar(readings(spark, d))
    both = [patterns.peak(patterns.alarm_rate_by(calendar, p), p).select(f"peak_{p}") for p in ("hour", "weekday")]
    return tidy(both[0].crossJoin(F.broadcast(both[1])))   # one row each


@query("e14_correlation", unioned([
    f"SELECT '{a}' AS x, '{b}' AS y, {_N(f'corr({SHORT[a]}, {SHORT[b]})', 'r')} FROM r"
    for a, b in combinations(_ALL, 2)]))
def e14(spark, d):
    return tidy(patterns.correlations(readings(spark, d), _ALL))


@query("k03_top_indicators",
       f"SELECT channel, {_N('strength', 'strength')} FROM ({unioned([f'''SELECT '{n}' AS channel, abs(corr({SHORT[n]}, alarm)) AS strength FROM r''' for n in NUMERIC_CHANNELS])}) "
       "ORDER BY round(strength, 9) DESC, channel LIMIT 5")
def k03(spark, d):
    return tidy(patterns.top_indicators(readings(spark, d), NUMERIC_CHANNELS, ALARM, 5))


_DESCRIBED = [TEMPERATURE, HUMIDITY, TVOC]


@query("e15_describe", unioned([
    f"SELECT '{n}' AS channel, count({s}) AS count, {_N(f'avg({s})', 'mean')}, {_N(f'stddev_samp({s})', 'std')}, "
    f"{_N(f'min({s})', 'min')}, {_N(f'quantile_cont({s}, 0.25)', 'p25')}, {_N(f'quantile_cont({s}, 0.5)', 'p50')}, "
    f"{_N(f'quantile_cont({s}, 0.75)', 'p75')}, {_N(f'max({s})', 'max')} FROM r"
    for n, s in ((n, SHORT[n]) for n in _DESCRIBED)]))
def e15(spark, d):
    return tidy(profile.describe(readings(spark, d), _DESCRIBED))


@query("l01_stacked_statistics", unioned([
    f"SELECT '{n}' AS name, '{stat}' AS statistic, {_N(f'{f}({SHORT[n]})', 'value')} FROM r"
    for n in _DESCRIBED for stat, f in (("mean", "avg"), ("max", "max"), ("min", "min"))]))
def l01(spark, d):
    wide = profile.numeric_profile(readings(spark, d), _DESCRIBED)
    return tidy(wide.unpivot(["channel"], ["mean", "max", "min"], "statistic", "value")
                .withColumnRenamed("channel", "name"))


# Features.

_FEATURES = {
    "temp_squared": "t * t", "temp_log": "ln(1 + (t + 50))", "humidity_squared": "h * h",
    "humidity_log": "ln(1 + h)", "tvoc_eco2_ratio": "tvoc / (eco2 + 1e-5)",
    "pm_ratio": "pm1 / (pm25 + 1e-5)", "pm_sum": "pm1 + pm25", "pressure_deviation": "abs(pressure - 1013.25e0)",
    "temp_humidity_interaction": "t * h", "heat_index": "t + 0.5e0 * h",
    "gas_sensor_ratio": "h2 / (ethanol + 1e-5)", "gas_sensor_sum": "h2 + ethanol",
}


@query("n01_engineered_features",
       "SELECT id AS event_id, " + ", ".join(
           _N(f"CASE WHEN t + 51 > 0 THEN {e} END" if n == "temp_log" else e, n) for n, e in _FEATURES.items())
       + " FROM r")
def n01(spark, d):
    return tidy(features.add_features(readings(spark, d)).select("event_id", *_FEATURES))


_NORM_COLS = list(NUMERIC_CHANNELS)
_SQUARES = " + ".join(f"{e} * {e}" for e in [*[SHORT[n] for n in _NORM_COLS], "(t * h)", "(pm1 + pm25)"])


@query("n02_normalised_features",
       "SELECT id AS event_id, " + ", ".join(_N(f"{e} / sqrt({_SQUARES})", n, 6) for n, e in (
           ("t", "t"), ("pressure", "pressure"), ("product", "t * h"), ("pm_sum", "(pm1 + pm25)")))
       + " FROM (SELECT * REPLACE (cast(cnt AS double) AS cnt) FROM r)")
def n02(spark, d):
    out = features.batch_features(readings(spark, d), _NORM_COLS)
    return tidy(out.select("event_id", c(TEMPERATURE).alias("t"), c("Pressure[hPa]").alias("pressure"),
                           c("Temp_Humidity_Product").alias("product"), c("PM_sum").alias("pm_sum")), 6)


@query("n11_weak_labels",
       "SELECT id AS event_id, cast(coalesce((t > 35 AND h < 30 AND s > 0.2e0) OR (t > 40 AND s > 0.15e0) OR s > 0.3e0 "
       "OR (tvoc > 200 AND s > 0.1e0), false) AS bigint) AS label FROM (SELECT *, pm1 / 100 AS s FROM r)")
def n11(spark, d):
    label = scoring.weak_labels(c(TEMPERATURE), c(HUMIDITY), c(PM1) / 100, c(TVOC))
    return tidy(readings(spark, d).select("event_id", label.alias("label")))


# Scores.

@query("n12_rule_scores",
       "SELECT id AS event_id, CASE WHEN t > 60 THEN 0.8e0 ELSE 0.2e0 END AS score, "
       "cast(coalesce(t > 60, false) AS bigint) AS prediction, 0.8e0 AS confidence FROM r")
def n12(spark, d):
    return tidy(scoring.rule_scores(readings(spark, d)).select("event_id", "score", "prediction", "confidence"))


@query("c20_label_text",
       "SELECT id AS event_id, CASE WHEN prediction = 1 THEN 'Fire Detected' ELSE 'No Fire' END AS prediction_label "
       "FROM p", _PREDICTIONS)
def c20(spark, d):
    return _predictions(spark, d).select("event_id", "prediction_label")


@query("c21_alert_level",
       f"SELECT id AS event_id, cast(prediction AS bigint) AS prediction, {_N('score', 'score')}, {_N('confidence', 'confidence')}, alert_level FROM p",
       _PREDICTIONS)
def c21(spark, d):
    return tidy(_predictions(spark, d).select("event_id", "prediction", "score", "confidence", "alert_level"))


@query("d01_attach_predictions",
       f"SELECT id AS event_id, device_id, cast(alarm AS bigint) AS alarm, cast(prediction AS bigint) AS prediction, {_N('score', 'score')} FROM p", _PREDICTIONS)
def d01(spark, d):
    df = readings(spark, d).select("event_id", "device_id", c(ALARM).alias("alarm"))
    separate = _predictions(spark, d).select("event_id", "prediction", "score")
    return tidy(scoring.attach(df, separate, "event_id"))


@query("d02_unlabelled_documents",
       "SELECT doc_id, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def d02(spark, d):
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang")
    return scoring.unlabelled(docs, spark.read.parquet(f"{d}/labels.parquet").select("doc_id"), "doc_id")


_D3 = [TEMPERATURE, TVOC]


@query("d03_statistics_per_row",
       "SELECT id AS event_id, " + ", ".join(
           _N(f"({SHORT[n]} - (SELECT avg({SHORT[n]}) FROM r)) / (SELECT stddev_samp({SHORT[n]}) FROM r)", f"z_{SHORT[n]}")
           for n in _D3) + " FROM r")
def d03(spark, d):
    df = readings(spark, d)
    stats = df.agg(*[e for n in _D3 for e in (F.avg(c(n)).alias(f"m_{SHORT[n]}"),
                                              F.stddev_samp(c(n)).alias(f"s_{SHORT[n]}"))])
    joined = df.crossJoin(F.broadcast(stats))   # one row
    return tidy(joined.select("event_id", *[
        ((c(n) - F.col(f"m_{SHORT[n]}")) / F.col(f"s_{SHORT[n]}")).alias(f"z_{SHORT[n]}") for n in _D3]))


@query("d04_scores_by_rounded_key",
       "SELECT id AS event_id, cast(coalesce(round(t, 2) > 60, false) AS bigint) AS prediction, "
       "CASE WHEN round(t, 2) > 60 THEN 0.8e0 ELSE 0.2e0 END AS score FROM r")
def d04(spark, d):
    df = readings(spark, d).select("event_id", c(TEMPERATURE), c(HUMIDITY))
    out = scoring.score_by_key(df, [TEMPERATURE, HUMIDITY], scoring.rule_scores)
    return tidy(out.select("event_id", "prediction", "score"))


_BAD = ("t < -50 OR t > 100 OR h < 0 OR h > 100 OR tvoc < 0")


@query("n13_score_or_error",
       f"SELECT id AS event_id, coalesce({_BAD}, false) AS failed, CASE WHEN coalesce({_BAD}, false) THEN NULL ELSE "
       "prediction END AS prediction FROM p", _PREDICTIONS)
def n13(spark, d):
    out = scoring.score_or_error(_predictions(spark, d), validate.reading_errors())
    return out.select("event_id", F.col("error").isNotNull().alias("failed"), "prediction")


# Evaluation.

@query("e16_prediction_summary",
       f"SELECT count(*) AS total, count(*) FILTER (NOT bad) AS successful, count(*) FILTER (bad) AS failed, "
       "count(*) FILTER (NOT bad AND prediction = 1) AS fire, count(*) FILTER (NOT bad AND prediction = 0) AS no_fire, "
       + _N("cast(count(*) FILTER (NOT bad AND prediction = 1) AS double) / count(*) FILTER (NOT bad)", "fire_rate")
       + ", count(*) FILTER (NOT bad AND prediction = 1) AS ml_alerts, cast(sum(alerts) AS bigint) AS threshold_alerts, "
         "count(*) FILTER (q < 80) AS quality_issues, "
       + ", ".join(_N(f"{f}(confidence) FILTER (NOT bad)", f"confidence_{n}") for n, f in (
           ("mean", "avg"), ("std", "stddev_pop"), ("min", "min"), ("max", "max")))
       + f" FROM (SELECT *, coalesce({_BAD}, false) AS bad, "
         "cast(coalesce(t, 0) > 50 OR coalesce(t, 0) < -10 AS int) + cast(coalesce(h, 0) > 90 OR coalesce(h, 0) < 10 AS int) "
         "+ cast(tvoc > 1000 AS int) + cast(eco2 > 1000 AS int) + cast(pm25 > 35 AS int) + cast(alarm = 1 AS int) AS alerts, "
         "100 - 10 * (cast(t IS NULL AS int) + cast(h IS NULL AS int)) - CASE WHEN t > 100 OR t < -50 THEN 20 ELSE 0 END "
         "- CASE WHEN h > 100 OR h < 0 THEN 15 ELSE 0 END - CASE WHEN tvoc < 0 THEN 10 ELSE 0 END AS q FROM p)",
       _PREDICTIONS)
def e16(spark, d):
    score, _ = quality.reading_quality()
    judged = _predictions(spark, d).withColumns({
        "threshold_alerts": alert_count(reading_alerts()), "quality_score": score})
    return tidy(scoring.prediction_summary(
        scoring.score_or_error(judged, validate.reading_errors())))


@query("e17_prediction_monitor",
       "SELECT (sec // 86400) * 86400 AS window_start, (sec // 86400) * 86400 + 86400 AS window_end, count(*) AS total, "
       + _N("count(*) / 1440.0e0", "per_minute") + ", count(*) FILTER (prediction = 1) AS fire, "
       "count(*) FILTER (prediction = 0) AS no_fire, " + _N("avg(prediction)", "fire_rate") + ", "
       + ", ".join(f"count(*) FILTER (alert_level = '{x}') AS {x.lower()}" for x in ("NONE", "MEDIUM", "HIGH", "CRITICAL"))
       + ", " + ", ".join(_N(f"{f}(confidence)", f"confidence_{n}") for n, f in (("mean", "avg"), ("min", "min"), ("max", "max")))
       + " FROM p GROUP BY 1, 2", _PREDICTIONS)
def e17(spark, d):
    out = scoring.prediction_monitor(_predictions(spark, d), "1 day", 1440.0)
    levels = [F.col("alert_distribution")[x].alias(x.lower()) for x in ("NONE", "MEDIUM", "HIGH", "CRITICAL")]
    return tidy(windows.with_bounds(out.select("*", *levels).drop("alert_distribution")))


@query("e17_window_samples",
       "SELECT window_start, sample, event_id FROM (SELECT (sec // 86400) * 86400 AS window_start, id AS event_id, "
       "row_number() OVER (PARTITION BY sec // 86400 ORDER BY ts, id) AS sample FROM p) WHERE sample <= 5", _PREDICTIONS)
def e17_samples(spark, d):
    out = scoring.window_samples(_predictions(spark, d), "1 day", 5)
    return tidy(out.select(F.col("window.start").alias("window_start"), "sample", "event_id"))


@query("e18_prediction_counters",
       "SELECT count(*) AS total, count(*) FILTER (prediction = 1) AS fire, count(*) FILTER (prediction = 0) AS no_fire, "
       + _N("100.0e0 * count(*) FILTER (prediction = 1) / count(*)", "fire_percent") + ", "
       + _N("avg(score)", "mean_fire_confidence") + ", " + _N("avg(value)", "mean_processing_ms") + " FROM p", _PREDICTIONS)
def e18(spark, d):
    timed = _predictions(spark, d).withColumn("processing_ms", c("NC2.5") / 2)
    return tidy(scoring.prediction_counters(timed))


@query("e19_scoring_counters",
       "SELECT location, count(*) AS total, count(*) FILTER (prediction = 1) AS fire, " + _N("avg(prediction)", "fire_rate")
       + " FROM p GROUP BY location", _PREDICTIONS)
def e19(spark, d):
    return tidy(_predictions(spark, d).groupBy("location").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("prediction") == 1).alias("fire"),
        F.avg("prediction").alias("fire_rate")))


@query("e20_drift_report",
       "SELECT total, " + ", ".join(_N(n, n) for n in ("fire_rate_percent", "mean_confidence", "high_share", "medium_share", "low_share"))
       + ", cast(fire_rate_percent > 15 OR fire_rate_percent < 0.5e0 AS bigint) + cast(mean_confidence < 0.6e0 AS bigint) "
         "+ cast(low_share > 0.2e0 AS bigint) AS indicators FROM (SELECT count(*) AS total, 100.0e0 * avg(prediction) AS fire_rate_percent, "
         "avg(confidence) AS mean_confidence, avg(cast(confidence > 0.8e0 AS int)) AS high_share, "
         "avg(cast(confidence BETWEEN 0.5e0 AND 0.8e0 AS int)) AS medium_share, avg(cast(confidence < 0.5e0 AS int)) AS low_share FROM p)",
       _PREDICTIONS)
def e20(spark, d):
    out = scoring.drift_report(_predictions(spark, d))
    return tidy(out.withColumn("indicators", F.size("indicators")))


_CURVE = _PREDICTIONS + """,
pts AS (SELECT score AS threshold, count(*) FILTER (alarm = 1) AS pos, count(*) FILTER (alarm = 0) AS neg FROM p GROUP BY score),
curve AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS np, sum(neg) OVER () AS nn FROM pts
  WINDOW w AS (ORDER BY threshold DESC)),
ranked AS (SELECT sum(pos * (nn - fp + neg / 2.0e0)) / max(np * nn) AS auc,
  sum(pos * (cast(tp AS double) / (tp + fp))) / max(np) AS average_precision FROM curve)"""
_BINARY = """
SELECT {acc}, {pre}, {rec}, {f1}, total, positives, predicted{more} FROM (
  SELECT count(*) AS total, count(*) FILTER ({y} = 1) AS positives, count(*) FILTER ({p} = 1) AS predicted,
    count(*) FILTER ({y} = 1 AND {p} = 1) AS hits, count(*) FILTER ({y} = {p}) AS right_ FROM {table}){join}"""


def _binary_sql(table: str, y: str, p: str, more: str = "", join: str = "") -> str:
    return _BINARY.format(
        table=table, y=y, p=p, more=more, join=join,
        acc=_N("cast(right_ AS double) / total", "accuracy"),
        pre=_N("CASE WHEN predicted = 0 THEN 0 ELSE cast(hits AS double) / predicted END", "precision"),
        rec=_N("CASE WHEN positives = 0 THEN 0 ELSE cast(hits AS double) / positives END", "recall"),
        f1=_N("CASE WHEN predicted + positives = 0 THEN 0 ELSE 2.0e0 * hits / (predicted + positives) END", "f1"))


@query("e21_binary_metrics", _binary_sql("p", "alarm", "prediction", ", " + _N("auc", "auc") + ", "
                                         + _N("average_precision", "average_precision"), ", ranked"), _CURVE)
def e21(spark, d):
    return tidy(evaluation.binary_metrics(_predictions(spark, d), ALARM))


@query("e21_binary_metrics_labels", _binary_sql("labels", "quality", "toxic"))
def e21_labels(spark, d):
    labels = spark.read.parquet(f"{d}/labels.parquet")
    return tidy(evaluation.binary_metrics(labels, "quality", "toxic", None))


_CLASSES = """cls AS (
  SELECT class, CASE WHEN predicted = 0 THEN 0 ELSE cast(hits AS double) / predicted END AS precision,
    CASE WHEN support = 0 THEN 0 ELSE cast(hits AS double) / support END AS recall,
    CASE WHEN predicted + support = 0 THEN 0 ELSE 2.0e0 * hits / (predicted + support) END AS f1, support, hits
  FROM (SELECT class, count(*) FILTER (alarm = class) AS support, count(*) FILTER (prediction = class) AS predicted,
      count(*) FILTER (alarm = class AND prediction = class) AS hits FROM p, (VALUES (0), (1)) v(class) GROUP BY class))"""


@query("e22_class_report", "SELECT cast(class AS bigint) AS class, " + ", ".join(_N(n, n) for n in ("precision", "recall", "f1"))
       + ", support, hits FROM cls", _PREDICTIONS + ",\n" + _CLASSES)
def e22(spark, d):
    return tidy(evaluation.class_report(_predictions(spark, d), ALARM))


@query("e22_averaged_metrics",
       "SELECT " + _N("sum(hits) / sum(support)", "accuracy") + ", "
       + ", ".join(_N(f"sum({n} * support) / sum(support)", f"{n}_weighted") for n in ("precision", "recall", "f1"))
       + ", " + ", ".join(_N(f"avg({n})", f"{n}_macro") for n in ("precision", "recall", "f1"))
       + ", cast(sum(support) AS bigint) AS support FROM cls", _PREDICTIONS + ",\n" + _CLASSES)
def e22_averages(spark, d):
    return tidy(evaluation.averaged_metrics(evaluation.class_report(_predictions(spark, d), ALARM)))


@query("e22_confusion",
       "SELECT cast(alarm AS bigint) AS label, cast(prediction AS bigint) AS prediction, count(*) AS n FROM p GROUP BY 1, 2", _PREDICTIONS)
def e22_confusion(spark, d):
    return tidy(evaluation.confusion(_predictions(spark, d), ALARM))


@query("e23_roc_curve", "SELECT " + _N("threshold", "threshold") + ", " + _N("fp / nn", "fpr") + ", "
       + _N("tp / np", "tpr") + " FROM curve", _CURVE)
def e23_roc(spark, d):
    return tidy(evaluation.roc_curve(evaluation.score_curve(_predictions(spark, d), ALARM)))


@query("e23_precision_recall_curve", "SELECT " + _N("threshold", "threshold") + ", " + _N("tp / (tp + fp)", "precision")
       + ", " + _N("tp / np", "recall") + " FROM curve", _CURVE)
def e23_pr(spark, d):
    return tidy(evaluation.precision_recall_curve(evaluation.score_curve(_predictions(spark, d), ALARM)))


@query("e24_class_distribution", "SELECT cast(alarm AS bigint) AS label, count(*) AS n FROM r GROUP BY 1")
def e24(spark, d):
    return tidy(evaluation.class_distribution(readings(spark, d), ALARM))


# Reports built from the above.

@query("e26_performance_report",
       "SELECT " + _N("round(CASE WHEN total > 0 THEN 25 ELSE 0 END + 100 * acc * 0.4e0 + greatest(0, 25 - ms / 1000 * 10) "
                      "+ greatest(0, 10 - drift * 2), 2)", "performance_score")
       + ", cast(drift AS bigint) AS drift_count FROM (SELECT count(*) AS total, avg(cast(alarm = prediction AS int)) AS acc, "
         "avg(value) AS ms, cast(100 * avg(prediction) > 15 OR 100 * avg(prediction) < 0.5e0 AS int) "
         "+ cast(avg(confidence) < 0.6e0 AS int) + cast(avg(cast(confidence < 0.5e0 AS int)) > 0.2e0 AS int) AS drift FROM p)",
       _PREDICTIONS)
def e26(spark, d):
    scored = _predictions(spark, d)
    drift = scoring.drift_report(scored).select(F.size("indicators").alias("drift_count"))
    accuracy = evaluation.binary_metrics(scored, ALARM, score=None)
    time = processing_log(readings(spark, d), c("NC2.5") / 2).agg(
        (F.avg("processing_ms") / 1000).alias("response_seconds"))
    row = accuracy.crossJoin(F.broadcast(drift)).crossJoin(F.broadcast(time))   # one row each
    metrics = row.select((F.col("total") > 0).alias("healthy"), (100 * F.col("accuracy")).alias("accuracy"),
                         "response_seconds", "drift_count")
    return tidy(scoring.performance_report(metrics).select("performance_score", "drift_count"))


# A group is healthy if under a twentieth of its readings cannot be scored.
_M12_GROUPS = _PREDICTIONS + f""",
health AS (
  SELECT device_id, location, 100.0e0 * avg(cast(alarm = prediction AS int)) AS acc, avg(value) / 10 AS secs,
    avg(cast(coalesce({_BAD}, false) AS int)) < 0.05e0 AS healthy,
    cast(100.0e0 * avg(prediction) > 15 AS int) + cast(100.0e0 * avg(prediction) < 0.5e0 AS int)
      + cast(avg(confidence) < 0.6e0 AS int) + cast(avg(cast(confidence < 0.5e0 AS int)) > 0.2e0 AS int) AS drift
  FROM p GROUP BY device_id, location),
judged AS (
  SELECT *, round(CASE WHEN healthy THEN 25 ELSE 0 END + acc * 0.4e0 + greatest(0, 25 - secs * 10) + greatest(0, 10 - drift * 2), 2)
    AS score FROM health)"""


@query("m12_performance_alerts", unioned([
    f"SELECT device_id, location, '{text}' AS alert FROM judged WHERE {hit}" for text, hit in (
        ("CRITICAL: performance degraded", "score < 50"), ("CRITICAL: scoring not available", "NOT healthy"),
        ("CRITICAL: accuracy below 70%", "acc < 70"), ("WARNING: response time above 5 s", "secs > 5"),
        ("WARNING: several drift indicators", "drift > 3"))]), _M12_GROUPS)
def m12(spark, d):
    """All alerts of every device and place: accuracy, times, drift and the share that cannot be scored."""
    judged = _predictions(spark, d).withColumns({
        "failed": validate.reading_failed(), "seconds": c("NC2.5") / 2 / 10})
    metrics = scoring.performance_metrics(judged, "device_id", "location", seconds="seconds")
    found = scoring.performance_report(metrics)
    return found.select("device_id", "location", F.explode("alerts").alias("alert"))


@query("n10_promotion_gate",
       "SELECT model, location, " + _N("accuracy", "accuracy") + ", " + _N("f1", "f1") + " FROM (SELECT model, location, avg(cast(alarm = prediction AS int)) AS accuracy, "
       "CASE WHEN sum(alarm) + sum(prediction) = 0 THEN 0 ELSE 2.0e0 * count(*) FILTER (alarm = 1 AND prediction = 1) / (sum(alarm) + sum(prediction)) END AS f1 "
       "FROM (SELECT 'linear' AS model, location, alarm, prediction FROM p UNION ALL SELECT 'echo', location, alarm, "
       "CASE WHEN id % 9 = 0 THEN 0 ELSE alarm END FROM p) GROUP BY model, location) WHERE accuracy >= 0.8e0 AND f1 >= 0.75e0", _PREDICTIONS)
def n10(spark, d):
    """Two models at the gate: one that misses most alarms, one that repeats eight of nine."""
    y, p = c(ALARM) == 1, F.col("prediction") == 1
    linear = _predictions(spark, d).select("event_id", "location", c(ALARM), "prediction")
    echo = linear.withColumn("prediction", F.when(F.col("event_id") % 9 == 0, 0).otherwise(c(ALARM)))
    both = linear.withColumn("model", F.lit("linear")).unionByName(echo.withColumn("model", F.lit("echo")))
    measured = both.groupBy("model", "location").agg(
        F.avg((c(ALARM) == F.col("prediction")).cast("int")).alias("accuracy"),
        F.coalesce(F.try_divide(2.0 * F.count_if(y & p), F.count_if(y) + F.count_if(p)), F.lit(0.0)).alias("f1"))
    return tidy(evaluation.promote(measured))


@query("k08_best_model",
       "SELECT model, " + _N("f1", "f1") + " FROM (SELECT 'linear' AS model, 2.0e0 * count(*) FILTER (alarm = 1 AND prediction = 1) "
       "/ (sum(alarm) + sum(prediction)) AS f1 FROM p UNION ALL SELECT 'rule', 2.0e0 * count(*) FILTER (alarm = 1 AND t > 60) "
       "/ (sum(alarm) + count(*) FILTER (t > 60)) FROM p) ORDER BY f1 DESC, model LIMIT 1", _PREDICTIONS)
def k08(spark, d):
    scored = {"linear": _predictions(spark, d), "rule": scoring.rule_scores(readings(spark, d))}
    results = [evaluation.binary_metrics(df, ALARM, score=None).select(F.lit(n).alias("model"), "f1")
               for n, df in scored.items()]
    return tidy(evaluation.best_model(results[0].unionByName(results[1])))


_RATES = """rates AS (
  SELECT part, key, sum(alarm) / count(*)::double AS rate FROM (
    SELECT 'peak_hour' AS part, hour(ts) AS key, alarm FROM r
    UNION ALL SELECT 'peak_weekday', isodow(ts) - 1, alarm FROM r) GROUP BY part, key)"""
_STRENGTHS = unioned([f"SELECT '{n}' AS channel, abs(corr({SHORT[n]}, alarm)) AS strength FROM r"
                      for n in NUMERIC_CHANNELS])


def _fact(topic: str, value: str, source: str, attention: str = "false", bound: str = "NULL",
          subject: str = "NULL") -> str:
    return (f"SELECT '{topic}' AS topic, cast({subject} AS varchar) AS subject, {_N(value, 'value')}, "
            f"cast({bound} AS double) AS bound, {attention} AS attention FROM {source}")


@query("m13_insights", "SELECT * FROM (" + unioned([
    *[_fact(p, "key", f"(SELECT key FROM rates WHERE part = '{p}' ORDER BY rate DESC, key LIMIT 1)")
      for p in ("peak_hour", "peak_weekday")],
    _fact("mean_temperature", "avg(t)", "r"),
    _fact("max_temperature", "max(t)", "r", "max(t) > 80", "80"),
    _fact("fire_rate", "avg(prediction)", "p"),
    _fact("accuracy", "avg(cast(alarm = prediction AS int))", "p", "avg(cast(alarm = prediction AS int)) < 0.85e0", "0.85"),
    _fact("indicator", "strength", f"(SELECT * FROM ({_STRENGTHS}) ORDER BY round(strength, 9) DESC, channel LIMIT 1)",
          subject="channel")]) + ")", f"{_PREDICTIONS},\n{_RATES}")
def m13(spark, d):
    df = readings(spark, d)
    calendar = patterns.alarm_calendar(df)
    hour = patterns.peak(patterns.alarm_rate_by(calendar, "hour"), "hour").select("peak_hour")
    day = patterns.peak(patterns.alarm_rate_by(calendar, "weekday"), "weekday").select("peak_weekday")
    lead = patterns.top_indicators(df, NUMERIC_CHANNELS, ALARM, 1).withColumnRenamed("channel", "indicator")
    temps = df.agg(F.avg(c(TEMPERATURE)).alias("mean_temperature"), F.max(c(TEMPERATURE)).alias("max_temperature"))
    scored = _predictions(spark, d)
    rate = scoring.prediction_summary(scored).select("fire_rate")
    accuracy = evaluation.binary_metrics(scored, ALARM, score=None).select("accuracy")
    row = hour
    for other in (day, lead, temps, rate, accuracy):
        row = row.crossJoin(F.broadcast(other))   # one row each
    return tidy(patterns.insights(row))
