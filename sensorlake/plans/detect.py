"""All detectors over one table of readings."""

from __future__ import annotations

from pyspark.sql import DataFrame

from sensorlake.operators import alerts
from sensorlake.operators.rolling import rolling_scores
from sensorlake.spec import DEFAULT_SPEC, SensorSpec


def detect_all(df: DataFrame, spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    """Threshold, statistical and pattern alerts with the reading's id."""
    per_row = [*alerts.ladder_alerts(spec), *alerts.pattern_alerts()]
    rows = alerts.explode_alerts(df, per_row, spec.row_id)
    statistical = alerts.statistical_alerts(rolling_scores(df, spec=spec), spec.row_id)
    return rows.unionByName(statistical)


def messages(df: DataFrame, spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    """Only the alert texts."""
    return detect_all(df, spec).select(spec.row_id, "message")
