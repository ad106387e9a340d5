"""Historical scoring: predictions, alerts, quality issues and reports of one table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.operators import alerts, evaluation, quality, scoring
from sensorlake.operators.validate import reading_errors
from sensorlake.spec import DEFAULT_SPEC, SensorSpec


@dataclass
class HistoricalResult:
    predictions: DataFrame
    alerts: DataFrame
    quality_issues: DataFrame
    metrics: DataFrame
    summary: DataFrame


def score_history(df: DataFrame, scorer: Callable[[DataFrame], DataFrame] = scoring.rule_scores,
                  spec: SensorSpec = DEFAULT_SPEC) -> HistoricalResult:
    """Score every reading; invalid ones become error rows and stay out of the metrics."""
    judged = scoring.score_or_error(scorer(df), reading_errors(spec)).withColumns({
        "quality_score": quality.reading_quality()[0],
        "threshold_alerts": alerts.alert_count(alerts.reading_alerts())})
    return _reports(judged, spec)


def _reports(judged: DataFrame, spec: SensorSpec) -> HistoricalResult:
    """What follows from the scored readings."""
    checks = [*alerts.reading_alerts(), *alerts.prediction_alerts()]
    poor = judged.where("quality_score < 80").select(spec.row_id, "quality_score",
                                                     quality.reading_quality()[1].alias("issues"))
    valid = judged.where(F.col("error").isNull())
    return HistoricalResult(
        predictions=judged,
        alerts=alerts.explode_alerts(judged, checks, spec.row_id),
        quality_issues=poor,
        metrics=evaluation.binary_metrics(valid, spec.label),
        summary=scoring.prediction_summary(judged))


def write_history(result: HistoricalResult, path: str, spec: SensorSpec = DEFAULT_SPEC) -> None:
    """JSON outputs: row-level results as partitioned files, reports as one row each.

    Readings are scored once: everything else is read off the written predictions.
    """
    result.predictions.write.mode("overwrite").json(f"{path}/predictions")
    spark = result.predictions.sparkSession
    scored = spark.read.schema(result.predictions.schema).json(f"{path}/predictions")
    again = _reports(scored, spec)
    for name in ("alerts", "quality_issues"):
        getattr(again, name).write.mode("overwrite").json(f"{path}/{name}")
    for name in ("metrics", "summary"):
        getattr(again, name).coalesce(1).write.mode("overwrite").json(f"{path}/{name}")
