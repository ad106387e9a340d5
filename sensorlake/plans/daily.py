"""The daily job: one lazy chain from a day's readings to cleaned features."""

from __future__ import annotations

from pyspark.sql import DataFrame

from sensorlake.operators.clean import clean
from sensorlake.plans.features import batch_features
from sensorlake.spec import DEFAULT_SPEC, SensorSpec


def daily_features(day: DataFrame, spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    """Cleaned readings with normalised features; label, time and device stay as they are."""
    return batch_features(clean(day, spec), spec.channels)
