"""JSON payloads derived from readings, some of them faulty, as a message source would hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.spec import ALARM, REQUIRED_CHANNELS, TVOC, c


def payloads(readings: DataFrame, row_id: str = "event_id") -> DataFrame:
    """``(row_id, timestamp, value)``: missing values drop out of the JSON object.

    By row id some payloads get a TVOC that is no number, an alarm outside its
    domain, no alarm at all, or are cut off.
    """
    rid = c(row_id)
    text = {n: c(n).cast("string") for n in REQUIRED_CHANNELS}
    text[TVOC] = F.when(rid % 31 == 7, F.lit("bad")).otherwise(text[TVOC])
    text[ALARM] = F.when(rid % 41 == 13, F.lit(None)).when(rid % 37 == 11, F.lit("2")).otherwise(text[ALARM])
    body = F.to_json(F.struct(
        *[e.alias(n) for n, e in text.items()], c("timestamp"), c("device_id"), c("location")))
    return readings.select(rid, c("timestamp"), F.when(
        rid % 53 == 17, F.substring(body, 1, 20)).otherwise(body).alias("value"))
