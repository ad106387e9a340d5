"""Sensor analytics on Spark: one set of DataFrame operators for tables and streams."""

from sensorlake.spec import READING_SCHEMA, SensorSpec, c
from sensorlake.session import build_session, scratch_dir

__all__ = ["READING_SCHEMA", "SensorSpec", "build_session", "c", "scratch_dir"]
