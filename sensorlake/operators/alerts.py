"""Alert detectors.

A row-level detector is a list of :class:`Check`: a value and the limits that
apply to it. ``explode_alerts`` lays the checks of any number of detectors out as
rows of one generated loop and judges them by a single rule chain, so the code to
compile stays small however many checks there are, and the scan is shared.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake.functions.columns import finite
from sensorlake.spec import (ALARM, DEFAULT_SPEC, ECO2, HUMIDITY, PATTERN_LIMITS, PM25,
                             TEMPERATURE, TVOC, SensorSpec, WindowLimits, c)

# Judged top to bottom, the first step that holds wins: limit, comparison, severity.
STEPS = (
    ("low_critical", "<", "CRITICAL"),
    ("high_critical", ">", "CRITICAL"),
    ("low_high", "<", "HIGH"),
    ("high_high", ">", "HIGH"),
    ("high_medium", ">", "MEDIUM"),
    ("low_low", "<", "LOW"),
    ("from_critical", ">=", "CRITICAL"),
    ("from_high", ">=", "HIGH"),
)


@dataclass(frozen=True, eq=False)
class Check:
    """A value and its limits; ``name`` and ``unit`` are for the message."""

    sensor: str
    value: Column
    alert_type: str
    name: str = ""
    unit: str = ""
    low_critical: float | None = None
    high_critical: float | None = None
    low_high: float | None = None
    high_high: float | None = None
    high_medium: float | None = None
    low_low: float | None = None
    from_critical: float | None = None
    from_high: float | None = None

    def as_struct(self) -> Column:
        text = {n: F.lit(getattr(self, n)) for n in ("sensor", "alert_type", "name", "unit")}
        limits = {n: F.lit(getattr(self, n)).cast("double") for n, _, _ in STEPS}
        return F.struct(*[e.alias(n) for n, e in text.items()],
                        finite(self.value.cast("double")).alias("value"),
                        *[e.alias(n) for n, e in limits.items()])

    def hit(self) -> Column:
        """Whether any step holds; false for a missing value."""
        value = finite(self.value.cast("double"))
        tests = [_holds(value, side, F.lit(getattr(self, n)))
                 for n, side, _ in STEPS if getattr(self, n) is not None]
        return F.coalesce(reduce(lambda a, b: a | b, tests), F.lit(False))


def _holds(value: Column, side: str, limit: Column) -> Column:
    return value < limit if side == "<" else value > limit if side == ">" else value >= limit


def _chain(results: list[Column]) -> Column:
    out = None
    for (name, side, _), result in zip(STEPS, results):
        test = _holds(F.col("value"), side, F.col(name))
        out = F.when(test, result) if out is None else out.when(test, result)
    return out


def _message() -> Column:
    """Alert text by detector."""
    value, sensor, kind, sev = F.col("value"), F.col("sensor"), F.col("alert_type"), F.col("severity")
    word = F.initcap(sev)
    low = F.col("threshold").isin(F.col("low_critical"), F.col("low_high")) & (value < F.col("threshold"))
    ladder = (F.when(sev == "MEDIUM", "Elevated")
              .when(sev == "HIGH", F.when(low, "Low").otherwise("High"))
              .otherwise(F.when(low, "Critically low").otherwise("Critically high")))
    return (
        F.when(sensor == "FIRE_ALARM", F.format_string("Fire alarm triggered: %.0f alarms", value))
        .when(kind == "WINDOW", F.format_string("%s %s: %.2f%s", word, F.col("name"), value, F.col("unit")))
        .when(kind == "THRESHOLD", F.concat(ladder, F.lit(" "), sensor, F.lit(": "), value.cast("string")))
        .when(sensor == ALARM, F.lit("FIRE ALARM ACTIVATED!"))
        .when(kind == "PATTERN", F.format_string(
            "%s: %.0f/4 indicators active",
            F.when(sev == "CRITICAL", "Fire pattern detected").otherwise("Potential fire risk"), value))
        .when(kind == "ML_FIRE_PREDICTION", F.format_string("Fire predicted with confidence %.2f", value))
        .otherwise(F.concat(word, F.lit(" "), F.col("name"), F.lit(": "), value.cast("string"), F.col("unit"))))


def explode_alerts(df: DataFrame, checks: list[Check], *keep: str) -> DataFrame:
    """One row per alert with the kept columns and the alert fields."""
    laid_out = df.select(*[c(k) for k in keep], F.inline(F.array(*[x.as_struct() for x in checks])))
    judged = laid_out.withColumns({
        "severity": _chain([F.lit(sev) for _, _, sev in STEPS]),
        "threshold": _chain([F.col(n) for n, _, _ in STEPS]),
    }).where(F.col("severity").isNotNull())
    return judged.withColumn("message", _message()).select(
        *[c(k) for k in keep], "sensor", "value", "threshold", "severity", "message", "alert_type")


def alert_count(checks: list[Check]) -> Column:
    """Number of alerts a row would give."""
    return reduce(lambda a, b: a + b, [x.hit().cast("int") for x in checks])


def window_alerts(limits: WindowLimits = WindowLimits()) -> list[Check]:
    """Checks of a window-analytics row."""
    return [
        Check("TEMPERATURE", c("avg_temperature"), "WINDOW", "temperature", "°C",
              high_critical=limits.temperature_critical, high_high=limits.temperature_high,
              low_low=limits.temperature_low),
        Check("TVOC", c("avg_tvoc"), "WINDOW", "TVOC level", " ppb",
              high_critical=limits.tvoc_critical, high_high=limits.tvoc_high),
        Check("PM2.5", c("avg_pm25"), "WINDOW", "PM2.5 level", " μg/m³",
              high_critical=limits.pm25_critical, high_high=limits.pm25_high),
        Check("FIRE_ALARM", c("fire_alarm_count"), "WINDOW", high_critical=0.0),
    ]


def reading_alerts() -> list[Check]:
    """Basic checks of a reading; a missing value counts as 0."""
    value = lambda name: F.coalesce(finite(c(name).cast("double")), F.lit(0.0))
    return [
        Check(TEMPERATURE, value(TEMPERATURE), "BASIC", "temperature", "°C", high_high=50.0, low_low=-10.0),
        Check(HUMIDITY, value(HUMIDITY), "BASIC", "humidity", "%", high_high=90.0, low_low=10.0),
        Check(TVOC, value(TVOC), "BASIC", "TVOC", " ppb", high_high=1000.0),
        Check(ECO2, value(ECO2), "BASIC", "eCO2", " ppm", high_high=1000.0),
        Check(PM25, value(PM25), "BASIC", "PM2.5", " μg/m³", high_high=35.0),
        Check(ALARM, F.when(c(ALARM) == 1, 1.0), "BASIC", "fire alarm", from_critical=1.0),
    ]


def ladder_alerts(spec: SensorSpec = DEFAULT_SPEC) -> list[Check]:
    """Severity ladder over the channels that define one."""
    return [Check(x.channel, c(x.channel), "THRESHOLD", low_critical=x.low_critical,
                  low_high=x.low_high, high_medium=x.high_medium, high_high=x.high_high,
                  high_critical=x.high_critical) for x in spec.ladders]


def pattern_alerts() -> list[Check]:
    """Fire pattern over several channels; a NULL in any input silences the row."""
    n = reduce(lambda a, b: a + b, [(finite(c(x)) > limit).cast("int") for x, limit in PATTERN_LIMITS.items()])
    known = n.isNotNull() & c(ALARM).isNotNull()
    return [
        Check(ALARM, F.when(known & (c(ALARM) == 1), 1.0), "PATTERN", from_critical=1.0),
        Check("Fire Pattern", F.when(known, n), "PATTERN", from_critical=3.0, from_high=2.0),
    ]


def prediction_alerts() -> list[Check]:
    """Alert of a positive prediction (columns ``prediction`` and ``confidence``).

    The prediction alone decides: a positive one has a confidence of 0.5 or more, and one
    whose confidence is missing counts as 0.5.
    """
    sure = F.greatest(F.coalesce(finite(c("confidence")), F.lit(0.5)), F.lit(0.5))
    return [Check("ML", F.when(c("prediction") == 1, sure), "ML_FIRE_PREDICTION", from_high=0.5)]


def statistical_alerts(scores: DataFrame, *keep: str, z_threshold: float = 3.0) -> DataFrame:
    """Alerts from rolling z-scores (columns ``channel``, ``value``, ``z``)."""
    z = c("z")
    return scores.where(z > z_threshold).select(
        *[c(k) for k in keep], c("channel").alias("sensor"), c("value"),
        F.lit(z_threshold).alias("threshold"),
        F.when(z > 4.0, "HIGH").otherwise("MEDIUM").alias("severity"),
        F.concat(F.lit("Statistical anomaly in "), c("channel"), F.lit(": "), c("value").cast("string"),
                 F.format_string(" (Z-score: %.2f)", z)).alias("message"),
        F.lit("STATISTICAL").alias("alert_type"))


def alert_history(windows: DataFrame, spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    """Window alerts with their window and the time they were raised."""
    found = explode_alerts(windows, window_alerts(spec.window_limits), "window")
    return found.withColumn("timestamp", F.col("window.end"))
