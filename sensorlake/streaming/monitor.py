"""Monitor of a stream of predictions.

Predictions arrive as JSON messages, as ``pipeline.scored_messages`` publishes them. Each
micro-batch adds one row of sums per window and the batch's first predictions of each
window to two epoch tables; a report adds the rows of all epochs up. The stream keeps no
state, late predictions count like others, and a window's sample stays at its first
predictions however many there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sensorlake.functions.columns import finite
from sensorlake.operators.scoring import merged_monitor, monitor_sums, window_samples
from sensorlake.spec import DEFAULT_SPEC, SensorSpec
from sensorlake.streaming.pipeline import StreamConfig, write_epoch

PREDICTION_SCHEMA = T.StructType([
    T.StructField("message_id", T.StringType()), T.StructField("timestamp", T.TimestampType()),
    T.StructField("prediction", T.IntegerType()), T.StructField("prediction_label", T.StringType()),
    T.StructField("probability", T.StructType([T.StructField("no_fire", T.DoubleType()), T.StructField("fire", T.DoubleType())])),
    T.StructField("confidence", T.DoubleType()), T.StructField("alert_level", T.StringType()),
])


def parse_predictions(messages: DataFrame, spec: SensorSpec = DEFAULT_SPEC) -> tuple[DataFrame, DataFrame]:
    """(predictions, dead letters) of a message stream with a JSON ``value``.

    A message that is no JSON object or has no time is a dead letter. A missing alert level is
    ``NONE``; a missing or non-finite confidence is NULL. The message id serves as row id.
    """
    read = messages.select("value", F.from_json("value", PREDICTION_SCHEMA).alias("p"))
    usable = F.col("p").isNotNull() & F.col("p.timestamp").isNotNull()
    good = read.where(usable).select("p.*").withColumns({
        "confidence": finite(F.col("confidence")), "alert_level": F.coalesce("alert_level", F.lit("NONE"))})
    return (good.withColumnsRenamed({"timestamp": spec.event_time, "message_id": spec.row_id}),
            read.where(F.coalesce(~usable, F.lit(True))).select("value"))


def start_monitor(predictions: DataFrame, config: StreamConfig, duration: str, samples: int = 5) -> StreamingQuery:
    """Sums and samples per tumbling window, one folder per epoch."""
    def build(batch: DataFrame) -> dict[str, DataFrame]:
        return {"sums": monitor_sums(batch, duration, config.spec),
                "samples": window_samples(batch, duration, samples, config.spec).drop("sample")}

    return (predictions.writeStream.foreachBatch(write_epoch(f"{config.output_path}/monitor", build))
            .option("checkpointLocation", f"{config.checkpoint_path}/monitor")
            .trigger(**config.trigger).queryName("monitor").start())


def monitor_report(spark: SparkSession, config: StreamConfig, minutes: float) -> DataFrame:
    """The report of every window so far, as ``scoring.prediction_monitor`` gives it for a table."""
    return merged_monitor(spark.read.parquet(f"{config.output_path}/monitor/sums"), minutes)


def monitor_samples(spark: SparkSession, config: StreamConfig, duration: str, samples: int = 5) -> DataFrame:
    """The first predictions of every window so far; each epoch holds ``samples`` a window at most."""
    held = spark.read.parquet(f"{config.output_path}/monitor/samples").drop("epoch", "window")
    return window_samples(held, duration, samples, config.spec)

