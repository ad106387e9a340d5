"""Processing log: what handling each reading amounted to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake.operators.alerts import alert_count, reading_alerts
from sensorlake.operators.quality import message_quality
from sensorlake.operators.validate import reading_failed
from sensorlake.spec import DEFAULT_SPEC, SensorSpec, c


def processing_log(df: DataFrame, processing_ms: Column,
                   spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    """One row per reading: failed, time, alert count, quality."""
    keep = [spec.row_id, spec.event_time, spec.device, spec.location]
    judged = df.select(
        *[c(n) for n in keep], reading_failed(spec).alias("failed"),
        processing_ms.alias("processing_ms"), alert_count(reading_alerts()).alias("alerts"))
    return judged.withColumns({
        "anomaly": F.col("alerts") > 0, "quality": message_quality(F.col("alerts"))})
