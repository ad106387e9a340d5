"""Cleaning: typed selection, imputation, dedup, range filter, time parts, target lookup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlake.functions.columns import day_of_week
from sensorlake.operators.quantiles import quantiles
from sensorlake.spec import DEFAULT_SPEC, HUMIDITY, TEMPERATURE, SensorSpec, c


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def impute(df: DataFrame, columns: Sequence[str], policy: str = "median",
           spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    """Fill missing values by ``median``, ``mean``, ``zero`` or channel ``defaults``."""
    if policy == "zero":
        return df.na.fill(0, subset=[f"`{n}`" for n in columns])
    if policy == "defaults":
        return df.withColumns({n: F.coalesce(c(n), F.lit(spec.defaults[n])) for n in columns})
    if policy == "median":
        fills = quantiles(df, columns, [0.5])
        names = [f"q_{i}_0" for i in range(len(columns))]
    elif policy == "mean":
        fills = df.agg(*[F.avg(c(n)).alias(f"q_{i}_0") for i, n in enumerate(columns)])
        names = fills.columns
    else:
        raise ValueError(f"unknown fill policy: {policy}")
    types = {f.name: f.dataType for f in df.schema.fields}
    filled = {}
    for n, q in zip(columns, names):
        # A median of whole numbers may end in .5, so integer columns become double.
        target = types[n] if isinstance(types[n], T.FractionalType) else T.DoubleType()
        filled[n] = F.coalesce(c(n).cast(target), F.col(q).cast(target))
    return df.crossJoin(F.broadcast(fills)).withColumns(filled).drop(*names)   # one row


def drop_duplicates(df: DataFrame, business_columns: Sequence[str]) -> DataFrame:
    """Distinct readings; the map side already reduces large groups of copies."""
    return df.select(*[c(n) for n in business_columns]).distinct()


def plausible(temperature: str = TEMPERATURE, humidity: str = HUMIDITY) -> Column:
    t, h = c(temperature), c(humidity)
    return (t > -50) & (t < 100) & (h >= 0) & (h <= 100)


def time_parts(df: DataFrame, ts: Column) -> DataFrame:
    return df.withColumns({"datetime": ts, "hour": F.hour(ts), "day_of_week": day_of_week(ts)})


def clean(df: DataFrame, spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    """The daily cleaning chain: median fill, distinct, range filter, time parts."""
    columns = [n for n in (*spec.channels, spec.label) if n in df.columns]
    filled = impute(df, columns, "median", spec)
    distinct = drop_duplicates(filled, [spec.event_time, spec.device, spec.location, *columns])
    return time_parts(distinct.where(plausible()), c(spec.event_time))


def find_target(df: DataFrame, candidates: Sequence[str] = (
        "Fire Alarm", "fire_alarm", "target", "label", "class")) -> str:
    """Name of the target column: a known name, else the first two-valued whole-number column."""
    for name in candidates:
        if name in df.columns:
            return name
    options = [f.name for f in df.schema.fields
               if isinstance(f.dataType, (T.IntegralType, T.BooleanType))]
    if options:
        found = two_valued(df, options).where("two_valued").orderBy("position").first()
        if found:
            return found.channel
    raise ValueError("no target column found")


def two_valued(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Which columns hold exactly two values.

    Minimum and maximum decide it: two values exist exactly when they differ and
    nothing lies between them, so no distinct set is built.
    """
    bounds = df.agg(*[F.struct(F.min(c(n)).alias("lo"), F.max(c(n)).alias("hi")).alias(f"b_{i}")
                      for i, n in enumerate(columns)])
    inner = df.crossJoin(F.broadcast(bounds)).agg(*[   # one row
        F.struct(
            F.lit(i).alias("position"), F.lit(n).alias("channel"),
            (F.coalesce(F.bool_or(c(n) == F.col(f"b_{i}.lo")), F.lit(False))
             & F.coalesce(F.bool_or((c(n) == F.col(f"b_{i}.hi")) & (c(n) != F.col(f"b_{i}.lo"))),
                          F.lit(False))
             & ~F.coalesce(F.bool_or((c(n) != F.col(f"b_{i}.lo")) & (c(n) != F.col(f"b_{i}.hi"))),
                           F.lit(False))).alias("two_valued")).alias(f"r_{i}")
        for i, n in enumerate(columns)])
    return inner.select(F.inline(F.array(*[F.col(f"r_{i}") for i in range(len(columns))])))
