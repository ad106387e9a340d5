"""The current state of tables that a stream writes epoch by epoch.

In update mode every epoch holds the windows that changed in it. A window's newest epoch is
its current state; its epochs in order are its history, from which alerts become
transitions: one row where a window's level for a sensor changes, and none while it stays.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorlake.spec import c

WINDOW = ("window_start", "window_end")


def latest(table: DataFrame, keys: Sequence[str] = WINDOW, version: str = "epoch") -> DataFrame:
    """The newest version of each key, columns in their order (also of a complete-mode table)."""
    values = [n for n in table.columns if n not in keys]
    newest = table.groupBy(*[c(k) for k in keys]).agg(
        F.max_by(F.struct(*[c(n) for n in values]), c(version)).alias("_row"))
    return newest.select(*[c(n) if n in keys else F.col("_row")[n].alias(n) for n in table.columns])


def _levels(windows: DataFrame, alerts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Level of each (window, sensor) that ever alerted, at each epoch of the window."""
    pairs = alerts.select(*[c(k) for k in keys], "sensor").distinct()
    epochs = windows.select(*[c(k) for k in keys], "epoch").join(pairs, list(keys))
    return epochs.join(alerts.select(*[c(k) for k in keys], "sensor", "epoch", "severity", "value", "threshold"),
                       [*keys, "sensor", "epoch"], "left")


def alert_transitions(windows: DataFrame, alerts: DataFrame, keys: Sequence[str] = WINDOW) -> DataFrame:
    """(keys, sensor, epoch, previous, severity, value, threshold) wherever a window's level changes.

    ``windows`` and ``alerts`` are the epoch tables of one stream. ``previous`` is NULL where an
    alert is raised first, ``severity`` where a later epoch has none any more.
    """
    order = Window.partitionBy(*[c(k) for k in keys], "sensor").orderBy("epoch")
    levels = _levels(windows, alerts, keys).withColumn("previous", F.lag("severity").over(order))
    return levels.where(~F.col("severity").eqNullSafe(F.col("previous"))).select(
        *[c(k) for k in keys], "sensor", "epoch", "previous", "severity", "value", "threshold")


def open_alerts(windows: DataFrame, alerts: DataFrame, keys: Sequence[str] = WINDOW) -> DataFrame:
    """Alerts of the current state: those written with the newest epoch of their window."""
    newest = windows.groupBy(*[c(k) for k in keys]).agg(F.max("epoch").alias("epoch"))
    return alerts.join(newest, [*keys, "epoch"], "left_semi")
