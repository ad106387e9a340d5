"""Finite replays that end: a closing row moves the watermark behind all others.

A stream that has read all its files still holds what its watermark has not passed. A
replay's stream is united with that of a closing folder, empty until the replay has read
its input. A single row there, far in the future and without values, then lets the
watermark pass everything, and a second start of the query from its checkpoint releases
what was held back. A closed replay takes no further rows: all would be late.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sensorlake.session import written
from sensorlake.sources.kafka import file_stream
from sensorlake.spec import DEFAULT_SPEC, SensorSpec, c

# A fixed value: later than any reading.
END_OF_TIME = "9999-01-01 00:00:00"


def closable(readings: DataFrame, folder: str, spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    """``readings`` and the closing row, if there is one in ``folder``; all its other columns are NULL."""
    spark = readings.sparkSession
    # A stream may start only on a folder that is there.
    closing_rows(spark, spec).limit(0).write.mode("append").parquet(folder)
    closing = spark.readStream.schema(readings.schema).parquet(folder)
    return readings.unionByName(closing)


def closing_rows(spark: SparkSession, spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    return spark.range(1).select(F.to_timestamp(F.lit(END_OF_TIME)).alias(spec.event_time))


def replay(spark: SparkSession, folder: str, start: Callable[[], StreamingQuery],
           spec: SensorSpec = DEFAULT_SPEC) -> list[StreamingQuery]:
    """Run an ``availableNow`` query over its input, close the input and run it to the end.

    ``start`` starts the query from its checkpoint and is called twice.
    """
    first = start()
    first.awaitTermination()
    closing_rows(spark, spec).coalesce(1).write.mode("append").parquet(folder)
    second = start()
    second.awaitTermination()
    return [first, second]


# Rows of a file: so many take a task seconds, and a large part still feeds every core.
FILE_ROWS = 100_000


def in_parts(readings: DataFrame, folder: str, parts: int, spec: SensorSpec = DEFAULT_SPEC) -> str:
    """Readings written as files in order of event time, one file a part, for a stream to take one by one.

    The parts are equal spans of time; rows without a time come last.
    """
    held, part, _ = _placed(readings, parts, spec)
    _write(held, part, folder, parts, 1)
    return folder


def parted_stream(readings: DataFrame, folder: str, parts: int, spec: SensorSpec = DEFAULT_SPEC, *,
                  stored: bool = False) -> DataFrame:
    """Stream that takes the parts of ``in_parts`` one per micro-batch, each from as many files as its rows need.

    ``stored``: ``readings`` are a table as it lies in files and are not written once more before they are parted.

    All parts have the same number of files, since a stream counts files. A part too small for
    them (under 1,000 rows a file) brings the number down, to one if a part is empty.
    """
    held, part, sizes = _placed(readings, parts, spec, stored)
    smallest = min(sizes.values()) if len(sizes) == parts else 0
    files = max(1, min(max(sizes.values(), default=0) // FILE_ROWS, smallest // 1000))
    _write(held, part, folder, parts, files)
    return file_stream(readings.sparkSession, folder, held.schema, "parquet", files)


def _placed(readings: DataFrame, parts: int, spec: SensorSpec,
            stored: bool = False) -> tuple[DataFrame, Column, dict[int, int]]:
    """The readings, computed once for all parts, each row's part and the rows per part."""
    held = readings if stored else written(readings, "parts")
    time = F.unix_micros(c(spec.event_time).cast("timestamp"))
    lo, hi = held.agg(F.min(time), F.max(time)).first()
    width = 1 if lo is None else max(1, -(-(hi - lo + 1) // parts))
    part = F.coalesce(F.floor((time - F.lit(lo or 0)) / F.lit(width)), F.lit(parts - 1))
    return held, part, {r.part: r["count"] for r in held.groupBy(part.alias("part")).count().collect()}


def _write(held: DataFrame, part: Column, folder: str, parts: int, files: int) -> None:
    """One job a part, so that a part's files are older than the next one's."""
    for i in range(parts):
        rows = held.where(part == i)
        (rows.coalesce(1) if files == 1 else rows.repartition(files)).write.mode("append").parquet(folder)
