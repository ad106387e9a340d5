"""Queries: streams replayed over the event files, and model training."""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.catalog.base import ORACLES, SPEC, hops, long_cte, query, readings, rounded, tidy
from sensorlake.catalog.detection import _M1, _WINDOW_AGG
from sensorlake.catalog.intake import _FAULTS, _N_ERRORS
from sensorlake.catalog.sequences import _LOG
from sensorlake.operators import scoring, windows
from sensorlake.plans import historical, training
from sensorlake.plans.processing import processing_log
from sensorlake.session import scratch_dir
from sensorlake.sources.kafka import as_messages, file_stream
from sensorlake.sources.payloads import payloads
from sensorlake.sources.readings import project_readings
from sensorlake.spec import DOUBLE_CHANNELS, c
from sensorlake.streaming import pipeline
from sensorlake.streaming.current import alert_transitions, latest, open_alerts
from sensorlake.streaming.monitor import PREDICTION_SCHEMA, monitor_report, monitor_samples, parse_predictions, start_monitor
from sensorlake.streaming.progress import ProgressLog, progress_table, progress_totals
from sensorlake.streaming.replay import closable, parted_stream, replay
from sensorlake.streaming.stateful import rolling_scores_stream


def _stream(spark: SparkSession, d: str) -> DataFrame:
    """Readings streamed from the event files."""
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    return project_readings(file_stream(spark, f"{d}/events*.parquet", schema, "parquet"))


def _parted(spark: SparkSession, d: str, name: str, parts: int = 4) -> DataFrame:
    """Readings streamed in several micro-batches, from event files written in order of time.

    The parts hold events, which are a stored table; the stream itself projects the readings.
    """
    events = spark.read.parquet(f"{d}/events.parquet")
    return project_readings(parted_stream(events, scratch_dir(spark, name), parts, replace(SPEC, event_time="ts"),
                                          stored=True))


def _messages(spark: SparkSession, d: str) -> DataFrame:
    """JSON messages streamed from the event files, with broker columns."""
    rows = payloads(_stream(spark, d))
    return rows.select("event_id", "value", F.lit("readings").alias("topic"),
                       (F.col("event_id") % 4).cast("int").alias("partition"),
                       F.col("event_id").alias("offset"), "timestamp")


def _finish(spark: SparkSession, df: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Run a stream to the end of its input into a table below the checkpoint folder.

    In complete mode every epoch holds the whole result, so the last one is read.
    """
    out, state = scratch_dir(spark, name), scratch_dir(spark, f"{name}-state")
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", state).trigger(availableNow=True)
    if mode == "append":
        writer.format("parquet").option("path", out).start().awaitTermination()
        return spark.read.schema(df.schema).parquet(out)
    writer.foreachBatch(pipeline.write_epoch(out, lambda batch: {"rows": batch})).start().awaitTermination()
    table = spark.read.parquet(f"{out}/rows")
    last = table.agg(F.max("epoch").alias("_last"))
    return table.join(F.broadcast(last), F.col("epoch") == F.col("_last")).drop("epoch", "_last")   # one row


def _config(spark: SparkSession, name: str) -> pipeline.StreamConfig:
    return pipeline.StreamConfig(output_path=scratch_dir(spark, name), available_now=True,
                                 checkpoint_path=scratch_dir(spark, f"{name}-state"),
                                 window="1 day", slide="6 hours", watermark="1 day", spec=SPEC)


@query("j01_streamed_windows")
def j01(spark, d):
    """Windows of a stream in bounded state; their quantiles are settled on the stream's archive."""
    config = _config(spark, "j01")
    rows = _parted(spark, d, "j01-parts")
    pipeline.drain([pipeline.start_analytics(pipeline.analytics(rows, config), config, "update"),
                    pipeline.start_archive(rows, config)])
    kept = latest(spark.read.parquet(f"{config.output_path}/analytics/windows")).drop(
        "epoch", "unique_devices", "unique_locations", "quality_score", "quality_issues", "data_completeness", "quality_warning")
    placed = kept.withColumn("window", F.struct(F.col("window_start").alias("start"), F.col("window_end").alias("end")))
    archive = spark.read.parquet(f"{config.output_path}/archive")
    return tidy(windows.with_exact_quantiles(placed, archive, config.window, config.slide, spec=SPEC).drop("window"))


# The stream must give what the batch query gives.
ORACLES["j01_streamed_windows"] = ORACLES["e01_window_analytics"]


@query("j03_streamed_archive",
       "SELECT strftime(ts, '%Y-%m-%d') AS ds, count(*) AS n, " + rounded("avg(t)", "mean_t")
       + f" FROM faults WHERE ({_N_ERRORS}) = 0 GROUP BY 1", _FAULTS)
def j03(spark, d):
    config = _config(spark, "j03")
    good, _ = pipeline.parse(_messages(spark, d))
    pipeline.drain([pipeline.start_archive(good, config)])
    kept = spark.read.parquet(f"{config.output_path}/archive")
    return tidy(kept.groupBy(F.date_format("ds", "yyyy-MM-dd").alias("ds")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(c("Temperature[C]")).alias("mean_t")))


@query("j05_streamed_alerts")
def j05(spark, d):
    config = replace(_config(spark, "j05"), window="10 minutes", slide="10 minutes", archive=False)
    windows_now = pipeline.analytics(_parted(spark, d, "j05-parts"), config)
    pipeline.drain([pipeline.start_analytics(windows_now, config, "update")])
    table = lambda name: spark.read.parquet(f"{config.output_path}/analytics/{name}")
    return tidy(open_alerts(table("windows"), table("alerts")).groupBy("sensor", "severity")
                .agg(F.count(F.lit(1)).alias("n")))


ORACLES["j05_streamed_alerts"] = (
    f"SELECT sensor, severity, count(*) AS n FROM ({ORACLES['m01_window_alerts']}) GROUP BY 1, 2")


@query("j05_alert_transitions", f"SELECT window_start, window_end, sensor, severity FROM ({_M1.format(w='win')})",
       hops(86400, 86400) + ",\n" + _WINDOW_AGG)
def j05_transitions(spark, d):
    """The levels that the last transition of each window and sensor leads to."""
    config = replace(_config(spark, "j05t"), window="1 day", slide="1 day", archive=False)
    windows_now = pipeline.analytics(_parted(spark, d, "j05t-parts", 7), config)
    pipeline.drain([pipeline.start_analytics(windows_now, config, "update")])
    table = lambda name: spark.read.parquet(f"{config.output_path}/analytics/{name}")
    moves = alert_transitions(table("windows"), table("alerts"))
    last = latest(moves, ("window_start", "window_end", "sensor")).where("severity IS NOT NULL")
    return tidy(last.select("window_start", "window_end", "sensor", "severity"))


@query("j06_streamed_zscores",
       f"SELECT id AS event_id, channel, {rounded('mean', 'mean')}, {rounded('std', 'std')}, n, {rounded('z', 'z')} "
       "FROM (SELECT *, abs(v - mean) / std AS z FROM roll WHERE n >= 30 AND std > 0) "
       "WHERE z > 3",
       long_cte(list(DOUBLE_CHANNELS)) + """,
roll AS (
  SELECT *, avg(v) OVER w AS mean, stddev_pop(v) OVER w AS std, count(*) OVER w AS n FROM long
  WINDOW w AS (PARTITION BY device_id, channel ORDER BY ts, id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW))""")
def j06(spark, d):
    folder, out, state = (scratch_dir(spark, f"j06-{x}") for x in ("closing", "rows", "state"))
    scores = rolling_scores_stream(closable(_stream(spark, d), folder, SPEC), "1 hour", spec=SPEC)
    writer = scores.writeStream.option("checkpointLocation", state).option("path", out).trigger(availableNow=True)
    replay(spark, folder, lambda: writer.format("parquet").start(), SPEC)
    done = spark.read.schema(scores.schema).parquet(out)
    return tidy(done.where("z > 3").select(F.col("row_id").alias("event_id"), "channel", "mean", "std", "n", "z"))


@query("j07_streamed_intervals",
       "SELECT (sec // 86400) * 86400 AS window_start, (sec // 86400) * 86400 + 86400 AS window_end, "
       "count(CASE WHEN NOT failed THEN 1 END) AS processed, count(CASE WHEN failed THEN 1 END) AS failed, "
       "count(CASE WHEN alerts > 0 THEN 1 END) AS anomalies, cast(sum(alerts) AS bigint) AS alerts, "
       + rounded("avg(quality)", "quality") + ", " + rounded("avg(ms)", "mean_ms") + " FROM plog GROUP BY 1, 2", _LOG)
def j07(spark, d):
    """Interval counters in append mode: the closed replay releases the last interval, too."""
    folder = scratch_dir(spark, "j07-closing")
    log = processing_log(closable(_stream(spark, d), folder, SPEC), c("NC2.5") / 2)
    counted = pipeline.interval_counters(log, "1 day", "1 day")
    out, state = scratch_dir(spark, "j07"), scratch_dir(spark, "j07-state")
    writer = counted.writeStream.option("checkpointLocation", state).option("path", out).trigger(availableNow=True)
    replay(spark, folder, lambda: writer.format("parquet").start(), SPEC)
    return tidy(windows.with_bounds(spark.read.schema(counted.schema).parquet(out)))


@query("j07_progress_totals", "SELECT 12 AS batches, count(*) AS input_rows, 0 AS late_rows FROM r")
def j07_progress(spark, d):
    """Totals of a stream's progress reports, written by a listener as they come."""
    path, out, state = (scratch_dir(spark, f"j07-{x}") for x in ("progress", "rows", "progress-state"))
    with ProgressLog(spark, path) as log:
        query = (_parted(spark, d, "j07-parts", 12).select("event_id").writeStream.format("parquet").option("path", out)
                 .option("checkpointLocation", state).trigger(availableNow=True).start())
        query.awaitTermination()
        log.wait([query])
    return tidy(progress_totals(progress_table(spark, path)).select("batches", "input_rows", "late_rows"))


def _monitored(spark: SparkSession, d: str) -> pipeline.StreamConfig:
    """A monitor that has read all predictions as messages, in several micro-batches."""
    config = _config(spark, "e17")
    scored = scoring.linear_scores(readings(spark, d)).withColumn("message_id", F.col("event_id").cast("string"))
    sent = as_messages(scored.select(*PREDICTION_SCHEMA.fieldNames())).withColumn("timestamp", F.get_json_object(
        "value", "$.timestamp").cast("timestamp"))
    good, _ = parse_predictions(parted_stream(sent, scratch_dir(spark, "e17-messages"), 4, SPEC), SPEC)
    pipeline.drain([start_monitor(good, config, "1 day")])
    return config


@query("e17_streamed_monitor")
def e17_stream(spark, d):
    out = monitor_report(spark, _monitored(spark, d), 1440.0)
    levels = [F.col("alert_distribution")[x].alias(x.lower()) for x in scoring.LEVELS]
    return tidy(windows.with_bounds(out.select("*", *levels).drop("alert_distribution")))


@query("e17_streamed_samples")
def e17_stream_samples(spark, d):
    out = monitor_samples(spark, _monitored(spark, d), "1 day")
    return tidy(out.select(F.col("window.start").alias("window_start"), "sample", F.col("event_id").cast("long").alias("event_id")))


# A monitored stream must give what the monitor of the table gives.
ORACLES["e17_streamed_monitor"] = ORACLES["e17_prediction_monitor"]
ORACLES["e17_streamed_samples"] = ORACLES["e17_window_samples"]


@query("j08_streamed_dead_letters",
       f"SELECT errors, count(*) AS n FROM (SELECT cast({_N_ERRORS} AS bigint) AS errors FROM faults) "
       "WHERE errors > 0 GROUP BY 1", _FAULTS)
def j08(spark, d):
    _, bad = pipeline.parse(_messages(spark, d))
    done = _finish(spark, bad.drop("rejected_at"), "j08")
    return tidy(done.groupBy(F.size("errors").alias("errors")).agg(F.count(F.lit(1)).alias("n")))


@query("j09_streamed_scores",
       "SELECT concat(cast(id % 4 AS varchar), '_', cast(id AS varchar)) AS message_id, "
       "cast(coalesce(t > 60, false) AS bigint) AS prediction, CASE WHEN t > 60 THEN 'HIGH' ELSE 'NONE' END AS alert_level, "
       f"device_id FROM faults WHERE ({_N_ERRORS}) = 0", _FAULTS)
def j09(spark, d):
    scored = pipeline.scored_messages(_messages(spark, d), scoring.rule_scores)
    done = _finish(spark, scored, "j09")
    return tidy(done.select("message_id", "prediction", "alert_level",
                            F.col("sensor_data.device_id").alias("device_id")))


@query("c18_streamed_distinct", "SELECT location, count(*) AS n FROM r GROUP BY 1")
def c18_stream(spark, d):
    # Every message is sent twice; the repeat must vanish.
    twice = _stream(spark, d).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    once = pipeline.deduplicate(twice, ["event_id"], "timestamp", "1 day")
    done = _finish(spark, once.select("event_id", "location"), "c18")
    return tidy(done.groupBy("location").agg(F.count(F.lit(1)).alias("n")))


# Training. A fitted model has no SQL counterpart.

@query("n03_standardised")
def n03(spark, d):
    df = readings(spark, d)
    fitted = Pipeline(stages=training.feature_stages()).fit(df)
    names = training.feature_names()
    values = fitted.transform(df).select(vector_to_array("features").alias("v"))
    wide = values.agg(*[F.struct(F.lit(n).alias("feature"), F.avg(F.col("v")[i]).alias("mean"),
                                 F.stddev_samp(F.col("v")[i]).alias("std")).alias(f"f_{i}")
                        for i, n in enumerate(names)])
    return tidy(wide.select(F.inline(F.array(*[F.col(f"f_{i}") for i in range(len(names))]))))


_BUCKETS = """b AS (SELECT alarm, cast('0x' || substr(md5(id || '-42'), 1, 3) AS int) AS bucket FROM r),
upto AS (SELECT alarm, bucket, sum(count(*)) OVER (PARTITION BY alarm ORDER BY bucket) AS k,
    sum(count(*)) OVER (PARTITION BY alarm) AS n FROM b GROUP BY alarm, bucket)"""


@query("n04_split_shares",
       "SELECT alarm AS label, cast(max(n) AS bigint) AS n, cast(coalesce(max(k) FILTER (k * 100 <= n * 80), 0) AS bigint) AS train "
       "FROM upto GROUP BY alarm", _BUCKETS)
def n04(spark, d):
    return tidy(training.split_shares(readings(spark, d), "event_id"))


@query("n05_forest_search")
def n05(spark, d):
    train, test = training.split(readings(spark, d), "event_id")
    trees = training.forest(numTrees=10)
    # Two points: all 162 of the wide grid take hours even on little data.
    grid = training.ParamGridBuilder().addGrid(trees.maxDepth, [3, 5]).build()
    found = training.search(train, trees, grid, folds=2, scale=False)
    return tidy(training.evaluate(found.bestModel, test, "forest"))


@query("n06_logistic_search")
def n06(spark, d):
    train, test = training.split(readings(spark, d), "event_id")
    linear = training.logistic()
    grid = training.logistic_grid(linear, train.count())
    found = training.search(train, linear, grid)
    return tidy(training.evaluate(found.bestModel, test, "logistic"))


@query("n08_model_scores")
def n08(spark, d):
    train, test = training.split(readings(spark, d), "event_id")
    model = training.fit(train, training.logistic(regParam=0.01))
    scored = scoring.model_scores(model, test)
    return tidy(scored.select("event_id", "prediction", "score", "confidence", "alert_level"))


@query("k05_feature_importance")
def k05(spark, d):
    model = training.fit(readings(spark, d), training.forest(numTrees=10, maxDepth=5), scale=False)
    return tidy(training.importances(model, spark))


@query("n09_historical_scoring")
def n09(spark, d):
    result = historical.score_history(readings(spark, d))
    return tidy(result.alerts.groupBy("sensor", "severity").agg(F.count(F.lit(1)).alias("n")))


ORACLES["n09_historical_scoring"] = (
    f"WITH a AS ({ORACLES['m03_reading_alerts']}), m AS ({ORACLES['n12_rule_scores']}), "
    f"v AS ({ORACLES['n13_score_or_error']}) "
    "SELECT sensor, severity, count(*) AS n FROM (SELECT sensor, severity FROM a UNION ALL "
    "SELECT 'ML', 'HIGH' FROM m JOIN v USING (event_id) WHERE m.prediction = 1 AND NOT v.failed) GROUP BY 1, 2")


@query("n09_historical_summary")
def n09_summary(spark, d):
    result = historical.score_history(readings(spark, d))
    return tidy(result.summary.crossJoin(F.broadcast(   # one row each
        result.metrics.withColumnRenamed("total", "judged"))))
