"""Readings projected from the event table.

The driver tables hold no sensor readings, so a deterministic projection of
``events`` supplies them: every event is one reading with all channels, some
values missing or out of range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

READING_COLUMNS = (
    "event_id",
    "cast(ts AS timestamp) AS `timestamp`",
    "concat('sensor_', cast(user_id AS string)) AS device_id",
    "event_type AS location",
    "CASE WHEN event_id % 20 = 3 THEN NULL WHEN event_id % 97 = 0 THEN -60.0D + k ELSE 15.0D + value / 5.0D - (k % 7) END AS `Temperature[C]`",
    "CASE WHEN event_id % 23 = 5 THEN NULL WHEN event_id % 89 = 0 THEN 104.0D ELSE cast(k AS double) END AS `Humidity[%]`",
    "CASE WHEN event_id % 101 = 0 THEN -5.0D ELSE value * 8.0D END AS `TVOC[ppb]`",
    "400.0D + value * 3.0D AS `eCO2[ppm]`",
    "12000.0D + k * 10 AS `Raw H2`",
    "18000.0D + event_id % 1000 AS `Raw Ethanol`",
    "930.0D + k * 1.4D + event_id % 5 AS `Pressure[hPa]`",
    "value / 6.0D AS `PM1.0`",
    "value / 4.0D AS `PM2.5`",
    "value * 10.0D AS `NC0.5`",
    "value * 7.0D AS `NC1.0`",
    "value * 2.0D AS `NC2.5`",
    "cast(event_id % 200 AS int) AS `CNT`",
    "cast(CASE WHEN event_type = 'error' AND value > 100 THEN 1 ELSE 0 END AS int) AS `Fire Alarm`",
)


def project_readings(events: DataFrame) -> DataFrame:
    """Readings from an event DataFrame (batch or streaming)."""
    keyed = events.selectExpr("*", "cast(get_json_object(props, '$.k') AS int) AS k")
    return keyed.selectExpr(*READING_COLUMNS)


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project_readings(spark.read.parquet(f"{sf_dir}/events.parquet"))
