"""Streaming queries over one parsed stream of readings."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sensorlake.functions.columns import alert_level
from sensorlake.operators.alerts import explode_alerts, window_alerts
from sensorlake.operators.quality import with_window_quality
from sensorlake.operators.validate import decode, flatten, split_valid, validate
from sensorlake.operators.windows import window_analytics
from sensorlake.sources.kafka import as_messages, kafka_sink_options, with_message_id
from sensorlake.spec import DEFAULT_SPEC, SensorSpec, c


@dataclass
class StreamConfig:
    """Stream settings (the values are the usual defaults)."""

    output_path: str
    checkpoint_path: str
    window: str = "5 minutes"
    slide: str = "1 minute"
    watermark: str = "10 minutes"
    trigger_interval: str = "30 seconds"
    available_now: bool = False
    arrival_time: bool = False      # window on processing time instead of event time
    archive: bool = True
    console: bool = False
    kafka_servers: str | None = None
    kafka_topic: str | None = None
    spec: SensorSpec = field(default_factory=lambda: DEFAULT_SPEC)

    @property
    def trigger(self) -> dict:
        return {"availableNow": True} if self.available_now else {"processingTime": self.trigger_interval}

    @property
    def event_time(self) -> str:
        return "processing_timestamp" if self.arrival_time else self.spec.event_time


def parse(messages: DataFrame, *keep: str, broker_time: str = "timestamp") -> tuple[DataFrame, DataFrame]:
    """(readings, dead letters) of a message stream with a JSON ``value``."""
    renamed = messages.withColumnRenamed(broker_time, "broker_time")
    checked = validate(decode(renamed))
    good, bad = split_valid(checked)
    readings = flatten(good, *keep, broker_time="broker_time")
    return readings, bad.select("value", "errors", "broker_time",
                                F.current_timestamp().alias("rejected_at"))


def analytics(readings: DataFrame, config: StreamConfig, *by: str) -> DataFrame:
    """Windowed statistics with quality; state is dropped behind the watermark."""
    marked = readings.withWatermark(config.event_time, config.watermark)
    out = window_analytics(marked, config.window, config.slide, *by,
                           event_time=config.event_time, spec=config.spec)
    return with_window_quality(out)


def deduplicate(readings: DataFrame, keys: list[str], event_time: str, delay: str) -> DataFrame:
    """Drop repeats of a key that arrive within the watermark delay."""
    return readings.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


def write_epoch(path: str, build: Callable[[DataFrame], dict[str, DataFrame]]):
    """Micro-batch writer: each epoch owns a folder, so a repeated epoch overwrites itself.

    The batch feeds several outputs and is therefore kept for their duration.
    """
    def write(batch: DataFrame, epoch: int) -> None:
        batch.persist()
        try:
            for name, out in build(batch).items():
                out.write.mode("overwrite").parquet(f"{path}/{name}/epoch={epoch}")
        finally:
            batch.unpersist()

    return write


def _window_outputs(spec: SensorSpec):
    def build(batch: DataFrame) -> dict[str, DataFrame]:
        flat = batch.withColumns({"window_start": F.col("window.start"), "window_end": F.col("window.end")})
        found = explode_alerts(flat, window_alerts(spec.window_limits), "window_start", "window_end")
        return {"windows": flat.drop("window"),
                "alerts": found.withColumn("timestamp", F.current_timestamp())}

    return build


def start_analytics(windows: DataFrame, config: StreamConfig, mode: str = "update") -> StreamingQuery:
    """Window and alert tables, one folder per epoch."""
    return (windows.writeStream.foreachBatch(write_epoch(f"{config.output_path}/analytics",
                                                         _window_outputs(config.spec)))
            .outputMode(mode).option("checkpointLocation", f"{config.checkpoint_path}/analytics")
            .trigger(**config.trigger).queryName("analytics").start())


def start_archive(readings: DataFrame, config: StreamConfig, by_device: bool = False) -> StreamingQuery:
    """Raw readings as Parquet by event date; by device too if asked (many small files)."""
    dated = readings.withColumns({"ds": F.to_date(config.event_time),
                                  config.spec.device: F.coalesce(c(config.spec.device), F.lit("unknown"))})
    parts = ["ds", config.spec.device] if by_device else ["ds"]
    return (dated.writeStream.format("parquet").partitionBy(*parts).outputMode("append")
            .option("path", f"{config.output_path}/archive")
            .option("checkpointLocation", f"{config.checkpoint_path}/archive")
            .trigger(**config.trigger).queryName("archive").start())


def start_dead_letters(rejected: DataFrame, config: StreamConfig) -> StreamingQuery:
    return (rejected.writeStream.format("json").outputMode("append")
            .option("path", f"{config.output_path}/dead_letters")
            .option("checkpointLocation", f"{config.checkpoint_path}/dead_letters")
            .trigger(**config.trigger).queryName("dead_letters").start())


def start_console(windows: DataFrame, config: StreamConfig, rows: int = 20) -> StreamingQuery:
    return (windows.writeStream.format("console").outputMode("update").option("truncate", "false")
            .option("numRows", rows).trigger(**config.trigger).queryName("console").start())


def start_publisher(df: DataFrame, config: StreamConfig, mode: str = "update") -> StreamingQuery:
    """Rows as JSON messages to the configured topic."""
    options = kafka_sink_options(config.kafka_servers, config.kafka_topic,
                                 f"{config.checkpoint_path}/publisher")
    return (as_messages(df).writeStream.format("kafka").options(**options).outputMode(mode)
            .trigger(**config.trigger).queryName("publisher").start())


def start_all(messages: DataFrame, config: StreamConfig) -> list[StreamingQuery]:
    """Analytics, archive, dead letters and the optional sinks from one message stream."""
    readings, rejected = parse(messages)
    windows = analytics(readings, config)
    queries = [start_analytics(windows, config), start_dead_letters(rejected, config)]
    if config.archive:
        queries.append(start_archive(readings, config))
    if config.console:
        queries.append(start_console(windows, config))
    if config.kafka_servers and config.kafka_topic:
        queries.append(start_publisher(windows, config))
    return queries


def wait_and_stop(spark: SparkSession, queries: list[StreamingQuery]) -> None:
    """Return when any query ends (raising its failure) and stop the rest."""
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for q in queries:
            q.stop()


def drain(queries: list[StreamingQuery]) -> None:
    """Wait for ``availableNow`` queries to finish their input."""
    for q in queries:
        q.awaitTermination()


def scored_messages(messages: DataFrame, scorer: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Score valid messages and attach id, metadata, original reading and alert level."""
    marked = with_message_id(messages)
    readings, _ = parse(marked, "message_id", "stream_metadata")
    original = F.struct(*[c(n) for n in readings.columns if n not in (
        "message_id", "stream_metadata", "kafka_timestamp", "processing_timestamp")])
    scored = scorer(readings.withColumn("sensor_data", original))
    return scored.select(
        "message_id", "stream_metadata", "sensor_data", "timestamp", "prediction", "prediction_label",
        "probability", "confidence", alert_level(F.col("prediction"), F.col("confidence")).alias("alert_level"))


def interval_counters(log: DataFrame, interval: str, watermark: str,
                      spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    """Counters per tumbling interval; every interval starts from zero."""
    return log.withWatermark(spec.event_time, watermark).groupBy(
        F.window(c(spec.event_time), interval)).agg(
        F.count_if(~F.col("failed")).alias("processed"), F.count_if("failed").alias("failed"),
        F.count_if(F.col("anomaly")).alias("anomalies"), F.sum("alerts").alias("alerts"),
        F.avg("quality").alias("quality"), F.avg("processing_ms").alias("mean_ms"))
