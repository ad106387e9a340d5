"""Event-time window aggregates; the same functions serve tables and streams."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorlake.spec import (DEFAULT_SPEC, ECO2, ETHANOL, H2, HUMIDITY, PM1, PM25, PRESSURE,
                             TEMPERATURE, TVOC, SensorSpec, c)

# Quantiles among the window statistics: name -> (channel, probability).
QUANTILES = {"temp_median": (TEMPERATURE, 0.5), "tvoc_95th_percentile": (TVOC, 0.95)}


def analytics_columns(spec: SensorSpec = DEFAULT_SPEC) -> list[Column]:
    """The window statistics. All have bounded state: sums, extremes and sketches."""
    t, h, tvoc = c(TEMPERATURE), c(HUMIDITY), c(TVOC)
    averages = {
        "avg_temperature": TEMPERATURE, "avg_humidity": HUMIDITY, "avg_tvoc": TVOC,
        "avg_eco2": ECO2, "avg_pm25": PM25, "avg_pm10": PM1, "avg_pressure": PRESSURE,
        "avg_h2": H2, "avg_ethanol": ETHANOL,
    }
    alarm = c(spec.label) == 1
    return [
        *[F.avg(c(n)).alias(name) for name, n in averages.items()],
        F.max(t).alias("max_temperature"), F.min(t).alias("min_temperature"),
        F.max(h).alias("max_humidity"), F.min(h).alias("min_humidity"),
        F.max(tvoc).alias("max_tvoc"), F.max(c(PM25)).alias("max_pm25"),
        F.stddev_samp(t).alias("temp_stddev"), F.stddev_samp(h).alias("humidity_stddev"),
        F.stddev_samp(tvoc).alias("tvoc_stddev"), F.var_samp(t).alias("temp_variance"),
        *[F.percentile_approx(c(n), p).alias(name) for name, (n, p) in QUANTILES.items()],
        F.count(F.lit(1)).alias("record_count"),
        F.count_if(alarm).alias("fire_alarm_count"),
        F.sum(F.when(alarm, 1).otherwise(0)).alias("total_fire_alarms"),
        F.count_if(t.isNull()).alias("null_temperature_count"),
        F.count_if(tvoc.isNull()).alias("null_tvoc_count"),
        F.approx_count_distinct(c(spec.device)).alias("unique_devices"),
        F.approx_count_distinct(c(spec.location)).alias("unique_locations"),
    ]


def window_analytics(df: DataFrame, duration: str = "5 minutes", slide: str = "1 minute",
                     *by: str, event_time: str | None = None,
                     spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    """Sliding-window statistics, optionally per device or location."""
    ts = c(event_time or spec.event_time)
    return df.groupBy(F.window(ts, duration, slide), *[c(b) for b in by]).agg(
        *analytics_columns(spec))


def with_exact_quantiles(windows: DataFrame, df: DataFrame, duration: str, slide: str,
                         *by: str, event_time: str | None = None,
                         spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    """``windows`` of ``df`` with the exact discrete quantiles in place of the sketches' values.

    For tables, such as a stream's archive. Equal values of a window are counted before they
    are ranked, and ranks are running sums of these counts: a window's distinct values are
    sorted, which may spill, and are never one row's state.
    """
    ts, keys = c(event_time or spec.event_time), ["window", *by]
    cells = F.array(*[F.struct(F.lit(name).alias("_name"), c(n).cast("double").alias("_value"))
                      for name, (n, _) in QUANTILES.items()])
    counts = (df.select(ts.alias("_ts"), *[c(b) for b in by], F.inline(cells)).where("_value IS NOT NULL")
              .groupBy(F.window("_ts", duration, slide), *[c(b) for b in by], "_name", "_value")
              .agg(F.count(F.lit(1)).alias("_n")))
    group = Window.partitionBy(*[c(k) for k in keys], "_name")
    # Decimals: 0.95 of a whole number must not fall a hair above its rank.
    share = F.create_map(*[x for name, (_, p) in QUANTILES.items() for x in (F.lit(name), F.lit(Decimal(str(p))))])
    rank = F.ceil(share[F.col("_name")] * F.sum("_n").over(group).cast("decimal(20,0)"))
    ranked = counts.withColumns({"_upto": F.sum("_n").over(group.orderBy("_value")), "_rank": rank})
    found = (ranked.where((F.col("_upto") >= F.col("_rank")) & (F.col("_upto") - F.col("_n") < F.col("_rank")))
             .groupBy(*[c(k).alias(f"_k{i}") for i, k in enumerate(keys)])
             .agg(*[F.max(F.when(F.col("_name") == name, F.col("_value"))).alias(f"_q_{name}") for name in QUANTILES]))
    match = F.lit(True)
    for i, k in enumerate(keys):
        match = match & c(k).eqNullSafe(F.col(f"_k{i}"))
    return windows.join(found, match, "left").select(
        *[F.col(f"_q_{n}").alias(n) if n in QUANTILES else c(n) for n in windows.columns])


def window_members(df: DataFrame, duration: str, slide: str,
                   spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    """Which devices and locations reported in each window, one row each with its count.

    The list form would grow with the fleet inside one row; rows stay distributed.
    """
    return df.groupBy(F.window(c(spec.event_time), duration, slide),
                      c(spec.device), c(spec.location)).agg(F.count(F.lit(1)).alias("readings"))


def unique_devices(df: DataFrame, duration: str, slide: str,
                   spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    """Exact number of devices per window."""
    return df.groupBy(F.window(c(spec.event_time), duration, slide)).agg(
        F.countDistinct(c(spec.device)).alias("unique_devices"))


def device_windows(df: DataFrame, duration: str, slide: str | None = None,
                   spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    """Count and temperature range per device and window."""
    t = c(TEMPERATURE)
    return df.groupBy(F.window(c(spec.event_time), duration, slide), c(spec.device)).agg(
        F.count(F.lit(1)).alias("readings"), F.avg(t).alias("avg_temperature"),
        F.max(t).alias("max_temperature"), F.min(t).alias("min_temperature"))


def gauge_means(df: DataFrame, duration: str, spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    """Recording rules: mean of each gauge per tumbling window."""
    gauges = {"temperature_avg": TEMPERATURE, "humidity_avg": HUMIDITY, "tvoc_avg": TVOC,
              "eco2_avg": ECO2, "pressure_avg": PRESSURE, "pm_avg": PM25}
    return df.groupBy(F.window(c(spec.event_time), duration)).agg(
        *[F.avg(c(n)).alias(name) for name, n in gauges.items()])


def with_bounds(windows: DataFrame) -> DataFrame:
    """Window struct as two epoch-second columns."""
    return windows.select(F.unix_seconds("window.start").alias("window_start"),
                          F.unix_seconds("window.end").alias("window_end"),
                          *[c(n) for n in windows.columns if n != "window"])
