"""Feature columns shared by training and scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake.functions.columns import row_norm
from sensorlake.operators.clean import impute
from sensorlake.spec import (DEFAULT_SPEC, ECO2, ETHANOL, H2, HUMIDITY, PM1, PM25, PRESSURE,
                             TEMPERATURE, TVOC, SensorSpec, c)

# Fixed value: keeps ratios finite.
EPSILON = 1e-5


def engineered(columns: Sequence[str]) -> dict[str, Column]:
    """Engineered features whose inputs are all among ``columns``."""
    t, h, tvoc, eco2 = c(TEMPERATURE), c(HUMIDITY), c(TVOC), c(ECO2)
    pm1, pm25, h2, eth = c(PM1), c(PM25), c(H2), c(ETHANOL)
    groups = [
        ((TEMPERATURE,), {"temp_squared": t * t, "temp_log": F.log1p(t + 50)}),
        ((HUMIDITY,), {"humidity_squared": h * h, "humidity_log": F.log1p(h)}),
        ((TVOC, ECO2), {"tvoc_eco2_ratio": tvoc / (eco2 + EPSILON)}),
        ((PM1, PM25), {"pm_ratio": pm1 / (pm25 + EPSILON), "pm_sum": pm1 + pm25}),
        ((PRESSURE,), {"pressure_deviation": F.abs(c(PRESSURE) - 1013.25)}),
        ((TEMPERATURE, HUMIDITY), {"temp_humidity_interaction": t * h, "heat_index": t + 0.5 * h}),
        ((H2, ETHANOL), {"gas_sensor_ratio": h2 / (eth + EPSILON), "gas_sensor_sum": h2 + eth}),
    ]
    out: dict[str, Column] = {}
    for inputs, features in groups:
        if set(inputs) <= set(columns):
            out.update(features)
    return out


def add_features(df: DataFrame) -> DataFrame:
    return df.withColumns(engineered(df.columns))


def batch_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Two product features, then every row scaled to Euclidean length 1 (zero rows stay)."""
    wide = df.withColumns({"Temp_Humidity_Product": c(TEMPERATURE) * c(HUMIDITY),
                           "PM_sum": c(PM1) + c(PM25)})
    names = [*columns, "Temp_Humidity_Product", "PM_sum"]
    placed = wide.withColumn("_norm", row_norm([c(n).cast("double") for n in names]))
    norm = F.when(F.col("_norm") == 0, 1.0).otherwise(F.col("_norm"))
    return placed.withColumns({n: c(n) / norm for n in names}).drop("_norm")


def prepare_features(df: DataFrame, features: Sequence[str], policy: str = "defaults", *,
                     keep: Sequence[str] = (), spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    """Features in a fixed order; absent columns get their default, missing values the policy."""
    have = set(df.columns)
    picked = df.select(*[c(k) for k in keep], *[
        c(n).cast("double").alias(n) if n in have
        else F.lit(float(spec.defaults.get(n, 0.0))).alias(n) for n in features])
    return impute(picked, [n for n in features if n in have], policy, spec)
