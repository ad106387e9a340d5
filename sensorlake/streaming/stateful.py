"""Rolling z-scores on a stream.

Row frames do not exist on streams, so each device keeps its waiting readings and the last
values of its channels as state. Rows wait until the watermark passes them and are then taken in event
order, which makes the result independent of arrival order and equal to the batch
operator's. Event timers release the rows; a replay that is closed (``streaming.replay``)
moves the watermark behind its last row, so that every row comes out.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from sensorlake.functions.columns import finite
from sensorlake.spec import DEFAULT_SPEC, DOUBLE_CHANNELS, SensorSpec, c

# Python workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

OUTPUT = ("device_id string, channel string, row_id long, ts_us long, value double, "
          "mean double, std double, n int, z double")
# Values scored at a time: their frames lie next to each other in a matrix.
CHUNK = 4096
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _score(values: list[np.ndarray], tails: list[np.ndarray], size: int, min_values: int) -> pd.DataFrame:
    """Mean, deviation and |z| of each value among its channel's last ``size``, given the values before."""
    size = min(size, max(len(v) + len(t) for v, t in zip(values, tails)))
    gap = np.full(size - 1, np.nan)
    joined = np.concatenate([x for v, t in zip(values, tails) for x in (gap, t, v)])
    ends = np.cumsum([len(gap) + len(t) + len(v) for v, t in zip(values, tails)])
    # A frame ends at its value; a gap of missing values keeps channels apart.
    at = np.concatenate([np.arange(e - len(v), e) for v, e in zip(values, ends)])
    frames = np.lib.stride_tricks.sliding_window_view(joined, size)[at - (size - 1)]
    present = ~np.isnan(frames)
    n = present.sum(axis=1)
    # Differences to each frame's own values: no cancellation for large values, and equal ones deviate by 0.
    away = np.where(present, frames - frames[:, -1:], 0.0)
    mean = away.sum(axis=1) / n
    std = np.sqrt((np.where(present, away - mean[:, None], 0.0) ** 2).sum(axis=1) / n)
    out = pd.DataFrame({"value": joined[at], "mean": joined[at] + mean, "n": n.astype("int32"), "std": std})
    usable = (out["n"] >= min_values) & (out["std"] > 0)
    out["z"] = (np.abs(out["value"] - out["mean"]) / out["std"].where(usable))
    return out


def _wakes(ts_us: int) -> int:
    """Milliseconds of the watermark that has passed a row."""
    return int(ts_us) // 1000 + 1


class RollingScores(StatefulProcessor):
    """Readings of one device: those that wait, and the last values of each channel before them.

    Input rows hold ``ts_us``, ``row_id`` and a column per channel, with NaN for a missing value.
    """

    def __init__(self, size: int, min_values: int, channels: Sequence[str] = ("value",)):
        self.size, self.min_values, self.channels = size, min_values, list(channels)
        # Input columns; PySpark takes no names with dots there.
        self.columns = self.channels if self.channels == ["value"] else [f"channel_{i}" for i in range(len(self.channels))]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        values = [f"v{i}" for i in range(len(self.channels))]
        self.rows = np.dtype([("ts", np.int64), ("id", np.int64), *[(v, np.float64) for v in values]])
        self.waiting = handle.getListState("waiting", "ts long, id long, " + ", ".join(f"{v} double" for v in values))
        # Newest values last; shorter channels start with NaN.
        self.tail = handle.getListState("tail", ", ".join(f"{v} double" for v in values))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for batch in rows:
            if len(batch):
                times = batch["ts_us"].tolist()
                values = [batch[n].astype(float).tolist() for n in self.columns]
                self.waiting.appendList(list(zip(times, batch["row_id"].tolist(), *values)))
                first = min(times) if first is None else min(first, *times)
        # A timer for the earliest row, unless an earlier one is set.
        if first is not None and all(_wakes(first) < t for t in self.handle.listTimers()):
            self.handle.registerTimer(_wakes(first))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.waiting.exists():
            return
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = np.fromiter(self.waiting.get(), dtype=self.rows)
        due, rest = np.sort(waiting[waiting["ts"] < mark], order=["ts", "id"]), waiting[waiting["ts"] >= mark]
        if not len(due):
            return
        tails = [np.zeros(0)] * len(self.channels)
        if self.tail.exists():
            kept = np.array([tuple(row) for row in self.tail.get()], dtype=float)
            tails = [kept[~np.isnan(kept[:, i]), i] for i in range(len(self.channels))]
        step = max(1, CHUNK // len(self.channels))
        for at in range(0, len(due), step):
            rows = due[at:at + step]
            cells = [rows[f"v{i}"] for i in range(len(self.channels))]
            there = [~np.isnan(v) for v in cells]
            values = [v[x] for v, x in zip(cells, there)]
            out = _score(values, tails, self.size, self.min_values)
            out["device_id"], out["channel"] = key[0], np.repeat(self.channels, [len(v) for v in values])
            for name, field in (("row_id", "id"), ("ts_us", "ts")):
                out[name] = np.concatenate([rows[field][x] for x in there])
            yield out[["device_id", "channel", "row_id", "ts_us", "value", "mean", "std", "n", "z"]]
            tails = [np.concatenate([t, v])[-(self.size - 1):] if self.size > 1 else t for t, v in zip(tails, values)]
        longest = max(map(len, tails))
        if longest:
            padded = [np.concatenate([np.full(longest - len(t), np.nan), t]) for t in tails]
            self.tail.put(list(zip(*[t.tolist() for t in padded])))
        if len(rest):
            self.waiting.put(rest.tolist())
            self.handle.registerTimer(_wakes(rest["ts"].min()))
        else:
            self.waiting.clear()

    def close(self) -> None:
        pass


def rolling_scores_stream(readings: DataFrame, delay: str, channels: Sequence[str] = DOUBLE_CHANNELS, *,
                          size: int = 100, min_values: int = 30,
                          spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    """Streaming counterpart of ``rolling_scores``; emits rows once the watermark passed them.

    Sets the state store to RocksDB, which timers and list state need; waiting rows then lie
    on disk and not in an executor's memory.
    """
    readings.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    marked = readings.withWatermark(spec.event_time, delay)
    processor = RollingScores(size, min_values, channels)
    # A row without a time or any value moves at most the watermark. The condition names the time, so
    # that the optimizer cannot move it below the watermark.
    scored = F.when(c(spec.event_time).isNotNull(), F.coalesce(*processor.columns)).isNotNull()
    flat = marked.select(F.coalesce(c(spec.device), F.lit("")).alias("device_id"), c(spec.event_time),
                         F.unix_micros(c(spec.event_time)).alias("ts_us"),
                         c(spec.row_id).alias("row_id"),
                         *[finite(c(n).cast("double")).alias(to) for n, to in zip(channels, processor.columns)])
    return flat.where(scored).groupBy("device_id").transformWithStateInPandas(processor, OUTPUT, "append", "eventTime")
