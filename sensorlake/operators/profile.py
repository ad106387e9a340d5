"""Column profiles and daily aggregates, one pass over the table each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake.operators.quantiles import quantiles
from sensorlake.spec import DEFAULT_SPEC, SensorSpec, c


def _inline(rows: list[Column]) -> Column:
    return F.inline(F.array(*rows))


def daily_aggregate(df: DataFrame, columns: Sequence[str],
                    spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    """Mean, maximum and minimum of each column per day, long form."""
    day = F.to_date(c(spec.event_time)).alias("ds")
    wide = df.groupBy(day).agg(*[
        e for i, n in enumerate(columns)
        for e in (F.avg(c(n)).alias(f"mean_{i}"), F.max(c(n)).alias(f"max_{i}"),
                  F.min(c(n)).alias(f"min_{i}"))])
    return wide.select("ds", _inline([
        F.struct(F.concat(F.lit(n), F.lit(f"_{stat}")).alias("name"),
                 F.col(f"{stat}_{i}").cast("double").alias("value"))
        for i, n in enumerate(columns) for stat in ("mean", "max", "min")]))


def numeric_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, min, max, mean and sample deviation per column."""
    wide = df.agg(*[
        F.struct(F.lit(n).alias("channel"), F.count(c(n)).alias("n"),
                 F.min(c(n)).cast("double").alias("min"), F.max(c(n)).cast("double").alias("max"),
                 F.avg(c(n)).alias("mean"), F.stddev_samp(c(n)).alias("std")).alias(f"p_{i}")
        for i, n in enumerate(columns)])
    return wide.select(_inline([F.col(f"p_{i}") for i in range(len(columns))]))


def category_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values of categorical columns with their counts, one row per value."""
    cells = F.array(*[F.struct(F.lit(n).alias("channel"), c(n).cast("string").alias("value"))
                      for n in columns])
    return df.select(F.inline(cells)).groupBy("channel", "value").agg(
        F.count(F.lit(1)).alias("n"))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, std, min, exact quartiles and max per column."""
    quartiles = [0.25, 0.5, 0.75]
    base = df.agg(*[
        F.struct(F.count(c(n)).alias("count"), F.avg(c(n)).alias("mean"),
                 F.stddev_samp(c(n)).alias("std"), F.min(c(n)).cast("double").alias("min"),
                 F.max(c(n)).cast("double").alias("max")).alias(f"d_{i}")
        for i, n in enumerate(columns)])
    both = base.crossJoin(F.broadcast(quantiles(df, columns, quartiles)))   # one row each
    return both.select(_inline([
        F.struct(F.lit(n).alias("channel"), F.col(f"d_{i}.count").alias("count"),
                 F.col(f"d_{i}.mean").alias("mean"), F.col(f"d_{i}.std").alias("std"),
                 F.col(f"d_{i}.min").alias("min"), F.col(f"q_{i}_0").alias("p25"),
                 F.col(f"q_{i}_1").alias("p50"), F.col(f"q_{i}_2").alias("p75"),
                 F.col(f"d_{i}.max").alias("max"))
        for i, n in enumerate(columns)]))


def recent_day(df: DataFrame, run_date: str, ds: str = "ds") -> DataFrame:
    """Rows of the day before ``run_date``; prunes to one partition of a dated table."""
    return df.where(c(ds) == F.date_sub(F.lit(run_date).cast("date"), 1))


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Fail early when a source is empty."""
    if df.limit(1).count() == 0:
        raise FileNotFoundError(f"no rows: {what}")
    return df
