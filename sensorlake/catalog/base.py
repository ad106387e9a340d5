"""Registry of queries over the driver tables and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlake.sources.readings import readings
from sensorlake.spec import DEFAULT_SPEC, c

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Slice widths are measured per table.
SPEC = DEFAULT_SPEC

READINGS_CTE = """
readings AS (
  SELECT event_id, ts AS "timestamp", concat('sensor_', cast(user_id AS varchar)) AS device_id,
    event_type AS location,
    CASE WHEN event_id % 20 = 3 THEN NULL WHEN event_id % 97 = 0 THEN -60.0e0 + k
         ELSE 15.0e0 + value / 5.0e0 - (k % 7) END AS t,
    CASE WHEN event_id % 23 = 5 THEN NULL WHEN event_id % 89 = 0 THEN 104.0e0
         ELSE cast(k AS double) END AS h,
    CASE WHEN event_id % 101 = 0 THEN -5.0e0 ELSE value * 8.0e0 END AS tvoc,
    400.0e0 + value * 3.0e0 AS eco2, 12000.0e0 + k * 10 AS h2,
    18000.0e0 + event_id % 1000 AS ethanol,
    930.0e0 + k * 1.4e0 + event_id % 5 AS pressure, value / 6.0e0 AS pm1, value / 4.0e0 AS pm25,
    value * 10.0e0 AS nc05, value * 7.0e0 AS nc1, value * 2.0e0 AS nc25,
    cast(event_id % 200 AS int) AS cnt,
    cast(CASE WHEN event_type = 'error' AND value > 100 THEN 1 ELSE 0 END AS int) AS alarm, value
  FROM (SELECT *, cast(json_extract_string(props, '$.k') AS int) AS k FROM events)),
r AS (
  SELECT *, event_id AS id, "timestamp" AS ts,
    cast(floor(epoch("timestamp")) AS bigint) AS sec FROM readings)"""

# Means of two-decimal values often end in a 5 just behind the last kept digit. The
# nudge moves such ties away from the rounding border in both engines. Adding 0.0
# afterwards turns a negative zero into zero.
NUDGE = 3e-08

# Channel name -> short name in the check SQL.
SHORT = {
    "Temperature[C]": "t", "Humidity[%]": "h", "TVOC[ppb]": "tvoc", "eCO2[ppm]": "eco2",
    "Raw H2": "h2", "Raw Ethanol": "ethanol", "Pressure[hPa]": "pressure", "PM1.0": "pm1",
    "PM2.5": "pm25", "NC0.5": "nc05", "NC1.0": "nc1", "NC2.5": "nc25", "CNT": "cnt",
    "Fire Alarm": "alarm",
}


def query(name: str, sql: str | None = None, ctes: str = ""):
    """Register a query; ``sql`` may use the tables ``r`` and those in ``ctes``."""

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_readings(sql, ctes)
        return fn

    return register


def with_readings(sql: str, ctes: str = "") -> str:
    more = f",\n{ctes.strip()}" if ctes.strip() else ""
    return f"WITH {READINGS_CTE.strip()}{more}\n{sql.strip()}"


def tidy(df: DataFrame, digits: int = 4) -> DataFrame:
    """Comparable output: doubles rounded, timestamps as epoch seconds, dates as text."""
    out = []
    for f in df.schema.fields:
        col = c(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            col = F.round(col.cast("double") + F.lit(NUDGE), digits) + F.lit(0.0)
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            col = F.unix_seconds(col.cast("timestamp"))
        elif isinstance(f.dataType, T.DateType):
            col = F.date_format(col, "yyyy-MM-dd")
        elif isinstance(f.dataType, T.IntegralType):
            col = col.cast("bigint")
        out.append(col.alias(f.name))
    return df.select(*out)


def rounded(expr: str, name: str, digits: int = 4) -> str:
    return f"round(cast({expr} AS double) + {NUDGE!r}, {digits}) + 0.0e0 AS {name}"


def unioned(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def long_cte(channels: list[str], name: str = "long") -> str:
    """Present channel values in long form."""
    parts = [f"SELECT id, ts, sec, device_id, '{n}' AS channel, cast({SHORT[n]} AS double) AS v "
             f"FROM r WHERE {SHORT[n]} IS NOT NULL" for n in channels]
    return f"{name} AS ({unioned(parts)})"


def hops(size: int, slide: int, table: str = "r", name: str = "hops") -> str:
    """Rows repeated for each sliding window that holds them."""
    return (f"{name} AS (SELECT x.*, (sec // {slide}) * {slide} - {slide} * o AS ws, "
            f"(sec // {slide}) * {slide} - {slide} * o + {size} AS we "
            f"FROM {table} x, range({size // slide}) g(o))")


__all__ = ["DEFAULT_SPEC", "ORACLES", "QUERIES", "SHORT", "SPEC", "hops", "long_cte", "query",
           "readings", "rounded", "tidy", "unioned", "with_readings"]
