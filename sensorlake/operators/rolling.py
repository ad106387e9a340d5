"""Rolling statistics, counters and sustained conditions over ordered readings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorlake.functions.columns import finite, ratio, rows_from
from sensorlake.operators.ordered import (islands, range_sums, rows_window, running,
                                          slice_seconds_for, sliding_sums)
from sensorlake.spec import DEFAULT_SPEC, DOUBLE_CHANNELS, SUSTAINED_RULES, SensorSpec, c


def _slices(df: DataFrame, keys: Sequence[str], spec: SensorSpec, ts: str | None = None) -> float | None:
    """Slice width of the spec, or measured on the table."""
    return spec.slice_seconds or slice_seconds_for(df, keys, ts or spec.event_time)


def unpivot(df: DataFrame, keep: Sequence[str], channels: Sequence[str]) -> DataFrame:
    """One row per present (finite) channel value."""
    cells = F.array(*[F.struct(F.lit(n).alias("channel"), finite(c(n).cast("double")).alias("value"))
                      for n in channels])
    return df.select(*[c(k) for k in keep], F.inline(cells)).where("value IS NOT NULL")


def rolling_scores(df: DataFrame, channels: Sequence[str] = DOUBLE_CHANNELS, *, size: int = 100,
                   min_values: int = 30, spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    """Rolling mean, deviation and |z| of each value among the last ``size`` values.

    The frame counts present values only and includes the current one; ``z`` is
    NULL below ``min_values`` values or at zero deviation.
    """
    keys = [spec.device, "channel"]
    long = unpivot(df, [spec.device, spec.event_time, spec.row_id], channels)

    def exprs(w):
        # Every row has a value, so that its place tells how many its frame holds; a frame is added anew
        # for each row, and one sum and one deviation are all that is added.
        frame = w.rowsBetween(-(size - 1), 0)
        n = F.least(F.row_number().over(w), F.lit(size)).cast("long")
        return {"mean": F.sum("value").over(frame) / n, "std": F.stddev_pop("value").over(frame), "n": n}

    out = rows_window(long, keys, [spec.event_time, spec.row_id], exprs, before=size - 1,
                      slice_seconds=_slices(df, [spec.device], spec))
    z = F.when((F.col("n") >= min_values) & (F.col("std") > 0),
               F.abs(F.col("value") - F.col("mean")) / F.col("std"))
    return out.withColumn("z", z)


def rolling_percentile(df: DataFrame, channel: str, p: float, *, size: int = 100,
                       spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    """Linear percentile of the last ``size`` present values of one channel."""
    long = unpivot(df, [spec.device, spec.event_time, spec.row_id], [channel])
    return rows_window(
        long, [spec.device, "channel"], [spec.event_time, spec.row_id],
        lambda w: {"percentile": F.percentile("value", F.lit(p)).over(w.rowsBetween(1 - size, 0))},
        before=size - 1, slice_seconds=_slices(df, [spec.device], spec))


def rolling_mean(df: DataFrame, keys: Sequence[str], columns: dict[str, str], *, size: int = 1000,
                 spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    """Mean of the last ``size`` rows for each ``{output: input}`` column.

    A wide frame would be summed anew for every row; sums over row numbers are linear.
    NaN and infinities are missing values.
    """
    value = {o: finite(c(i).cast("double")) for o, i in columns.items()}
    numbered_rows = running(df, keys, [spec.event_time, spec.row_id], {"_row": F.lit(1)},
                            slice_seconds=_slices(df, keys, spec))
    sums = {**{f"_s_{o}": v for o, v in value.items()}, **{f"_n_{o}": v.isNotNull().cast("long") for o, v in value.items()}}
    out = sliding_sums(numbered_rows, keys, F.col("_row"), size - 1, sums)
    return out.withColumns({o: F.try_divide(F.col(f"_s_{o}"), F.col(f"_n_{o}")) for o in columns}).drop(
        "_row", *[f"_{x}_{o}" for x in "sn" for o in columns])


def rolling_rates(log: DataFrame, keys: Sequence[str], *, seconds: int = 300,
                  spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    """Rolling processing metrics over the last ``seconds`` seconds of a processing log.

    The log (``failed``, ``anomaly``, ``quality``, ``processing_ms``) is first summed per
    second, so simultaneous messages reach the window as one row. One output row
    per key and second.
    """
    at = F.date_trunc("second", c(spec.event_time))
    ok = ~F.col("failed")
    per_second = log.groupBy(*[c(k) for k in keys], at.alias("at")).agg(
        F.count_if(ok).alias("processed"), F.count_if("failed").alias("failed"),
        F.count_if(ok & F.col("anomaly")).alias("anomalies"),
        F.sum(F.when(ok, finite(F.col("quality")).try_cast("decimal(17,13)"))).alias("quality_sum"),
        F.sum(F.when(ok, finite(F.col("processing_ms")))).alias("ms_sum"))
    sums = ("processed", "failed", "anomalies", "quality_sum", "ms_sum")
    out = range_sums(per_second, keys, "at", seconds, {f"w_{n}": F.col(n) for n in sums})
    w = {n: F.col(f"w_{n}") for n in sums}
    return out.select(
        *[c(k) for k in keys], "at",
        (w["processed"] / seconds).alias("rate"),
        ratio(w["failed"], w["processed"] + w["failed"]).alias("error_rate"),
        ratio(w["failed"], w["processed"]).alias("error_ratio"),
        ratio(w["anomalies"], w["processed"]).alias("anomaly_rate"),
        F.coalesce(F.try_divide(w["quality_sum"], w["processed"].cast("decimal(19,0)")).cast("double"),
                   F.lit(0.0)).alias("quality"),
        (ratio(w["ms_sum"], w["processed"]) / 1000).alias("processing_seconds"))


def health_warnings(rates: DataFrame, *keep: str) -> DataFrame:
    """Warning rows from rolling rates: errors above 5 %, quality below 0.8, rate below 1/s."""
    tests = {
        "HIGH_ERROR_RATE": (F.col("error_rate") > 0.05, F.col("error_rate")),
        "LOW_QUALITY": (F.col("quality") < 0.8, F.col("quality")),
        "LOW_RATE": (F.col("rate") < 1.0, F.col("rate")),
    }
    rows = [F.when(hit, F.struct(F.lit(name).alias("warning"), v.alias("value")))
            for name, (hit, v) in tests.items()]
    return rows_from(rates, keep, rows)


def counter_rate(df: DataFrame, keys: Sequence[str], counter: str, *, seconds: int = 300,
                 spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    """Per-second rate of a counter over the last ``seconds`` seconds; a drop is a reset."""
    order = [spec.event_time, spec.row_id]
    width = _slices(df, keys, spec)
    steps = rows_window(df, keys, order, lambda w: {"_before": F.lag(c(counter)).over(w)},
                        before=1, slice_seconds=width)
    delta = F.when(F.col("_before").isNull(), 0).when(
        c(counter) < F.col("_before"), c(counter)).otherwise(c(counter) - F.col("_before"))
    moved = steps.withColumn("_delta", delta).drop("_before")
    out = range_sums(moved, keys, spec.event_time, seconds, {"_sum": F.col("_delta")})
    return out.withColumn("rate", F.col("_sum") / seconds).drop("_sum", "_delta")


def running_means(df: DataFrame, keys: Sequence[str], columns: dict[str, str],
                  spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    """Running row count and running mean of each ``{output: input}`` column."""
    sums = {"running_count": F.lit(1),
            **{f"_s_{o}": F.coalesce(c(i), F.lit(0.0)) for o, i in columns.items()}}
    out = running(df, keys, [spec.event_time, spec.row_id], sums,
                  slice_seconds=_slices(df, keys, spec))
    return out.withColumns({o: F.col(f"_s_{o}") / F.col("running_count") for o in columns}).drop(
        *[f"_s_{o}" for o in columns])


def numbered(df: DataFrame, keys: Sequence[str] = (), *, batch_size: int = 1000,
             spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    """Row index, batch index and index in batch, all from 0, in event order."""
    out = running(df, keys, [spec.event_time, spec.row_id], {"_at": F.lit(1)},
                  slice_seconds=_slices(df, keys, spec))
    index = F.col("_at") - 1
    return out.withColumns({
        "row_index": index,
        "batch_index": F.floor(index / batch_size),
        "index_in_batch": index % batch_size,
    }).drop("_at")


def sustained(df: DataFrame, keys: Sequence[str], order: Sequence[str],
              rules: dict[str, tuple[Column, int]], spec: SensorSpec = DEFAULT_SPEC,
              width: float | None = None) -> DataFrame:
    """Runs during which a rule's condition held for at least its number of seconds.

    ``rules`` maps a name to (condition, seconds). The rule name joins the key, so
    any number of rules shares one scan and one pass over the ordered rows.
    """
    flags = F.array(*[
        F.struct(F.lit(name).alias("alert"), F.lit(seconds).alias("_need"),
                 F.coalesce(hit, F.lit(False)).alias("_hit"))
        for name, (hit, seconds) in rules.items()])
    long = df.select(*[c(n) for n in (*keys, *order)], F.inline(flags))
    runs = islands(long, [*keys, "alert", "_need"], order, F.col("_hit"),
                   slice_seconds=width if width else _slices(df, keys, spec, order[0]))
    lasted = F.unix_seconds("end_time") - F.unix_seconds("start_time")
    return (runs.withColumn("duration_seconds", lasted)
            .where(F.col("duration_seconds") >= F.col("_need")).drop("_need"))


def sustained_rules(df: DataFrame, keys: Sequence[str], names: Sequence[str] = tuple(SUSTAINED_RULES),
                    spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    """The named reading rules, e.g. ``HighTVOC``."""
    rules = {n: (c(SUSTAINED_RULES[n][0]) > SUSTAINED_RULES[n][1], SUSTAINED_RULES[n][2])
             for n in names}
    return sustained(df, keys, [spec.event_time, spec.row_id], rules, spec)


# Sustained rules on rolling rates (fixed values): name -> (column, side, limit, seconds).
RATE_RULES = {
    "HighErrorRate": ("error_ratio", ">", 0.05, 300),
    "LowProcessingRate": ("rate", "<", 1.0, 300),
    "PoorDataQuality": ("quality", "<", 0.8, 300),
    "HighAnomalyRate": ("anomaly_rate", ">", 0.1, 300),
    "ProcessingDelay": ("processing_seconds", ">", 1.0, 300),
    "ServiceDown": ("up", "=", 0.0, 60),
}


def sustained_rate_rules(rates: DataFrame, keys: Sequence[str], names: Sequence[str],
                         spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    """Named rules on a metric table with one row per key and ``at``."""
    rules = {}
    for name in names:
        column, side, limit, seconds = RATE_RULES[name]
        v = c(column)
        rules[name] = (v > limit if side == ">" else v < limit if side == "<" else v == limit, seconds)
    # One row per key and second, so a day's slice has a known size.
    return sustained(rates, keys, ["at"], rules, spec, width=86400)


def latest_values(df: DataFrame, channels: Sequence[str],
                  spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    """Newest present value of each channel per device."""
    when = F.struct(c(spec.event_time), c(spec.row_id))
    present = lambda n: F.when(c(n).isNotNull(), when)
    return df.groupBy(c(spec.device)).agg(
        *[F.max_by(c(n), present(n)).alias(f"latest_{i}") for i, n in enumerate(channels)]
    ).select(c(spec.device), F.inline(F.array(*[
        F.struct(F.lit(n).alias("channel"), F.col(f"latest_{i}").cast("double").alias("value"))
        for i, n in enumerate(channels)])))
