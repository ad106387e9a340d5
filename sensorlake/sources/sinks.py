"""Batch sinks: CSV history, feature and prediction exports, JSON reports, dated tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake.spec import NULL_MARKER


def append_history(df: DataFrame, path: str, event_time: str = "timestamp") -> None:
    """CSV history in date folders; missing values are written as the marker."""
    (df.withColumn("ds", F.to_date(event_time)).write.mode("append").partitionBy("ds")
     .options(header=True, nullValue=NULL_MARKER, emptyValue="").csv(path))


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def export_json(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).json(path)


def write_report(df: DataFrame, path: str) -> None:
    """A report of few rows as one JSON file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def write_dated(df: DataFrame, path: str, event_time: str = "timestamp", mode: str = "append",
                extra: dict[str, Column] | None = None) -> None:
    """Parquet partitioned by event date. Rows are first brought together by date, with AQE
    splitting a day too large for one task, so a day does not become one file per task."""
    dated = df.withColumns({"ds": F.to_date(event_time), **(extra or {})})
    dated.hint("rebalance", "ds").write.mode(mode).partitionBy("ds").parquet(path)
