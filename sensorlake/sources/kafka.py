"""Message sources and sinks: Kafka (connector package needed at run time) and file streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def kafka_source_options(servers: str, topic: str, *, starting: str = "latest",
                         max_offsets: int | None = None) -> dict[str, str]:
    """Lost offsets are tolerated; positions live in the query's checkpoint."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic,
               "startingOffsets": starting, "failOnDataLoss": "false"}
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def kafka_stream(spark: SparkSession, servers: str, topic: str, **kw) -> DataFrame:
    return spark.readStream.format("kafka").options(**kafka_source_options(servers, topic, **kw)).load()


def kafka_sink_options(servers: str, topic: str, checkpoint: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic, "checkpointLocation": checkpoint}


def as_messages(df: DataFrame, key: str | None = None) -> DataFrame:
    """Rows as JSON values for a message sink."""
    value = F.to_json(F.struct("*")).alias("value")
    return df.select(F.col(f"`{key}`").cast("string").alias("key"), value) if key else df.select(value)


MESSAGE_SCHEMA = T.StructType([
    T.StructField("value", T.StringType()), T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()), T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])


def file_stream(spark: SparkSession, path: str, schema: T.StructType = MESSAGE_SCHEMA,
                fmt: str = "json", max_files: int | None = None) -> DataFrame:
    """Stream of files dropped into a folder, in order of modification time."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def with_message_id(df: DataFrame) -> DataFrame:
    """Message id and metadata struct from broker columns."""
    return df.withColumns({
        "message_id": F.concat_ws("_", "partition", "offset"),
        "stream_metadata": F.struct("topic", "partition", "offset", "timestamp",
                                    F.current_timestamp().alias("processing_timestamp"))})
