"""Queries over the driver tables."""

from sensorlake.catalog import detection, faulty, intake, scored, sequences, streams  # noqa: F401
from sensorlake.catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
