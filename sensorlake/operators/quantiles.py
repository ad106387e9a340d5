"""Exact interpolated quantiles of whole columns, by refinement.

Each round counts, in one scan with aggregation before the shuffle, how many values of a
column fall in each of some evenly spaced buckets between two bounds, together with the
buckets' smallest and largest values. The bucket that holds a wanted rank gives the next
round's bounds. A rank is found when its bucket holds one distinct value. What moves is
columns x ranks x buckets, whatever the rows, and no guess can miss.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.functions.columns import finite, rows_from
from sensorlake.session import written
from sensorlake.spec import c

BUCKETS = 512


def _ranks(n: int, p: float) -> tuple[int, int, float]:
    at = (n - 1) * p
    low = math.floor(at)
    return low, min(low + 1, n - 1), at - low


def quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
              *, buckets: int = BUCKETS) -> DataFrame:
    """One row whose column ``q_<i>_<j>`` is quantile ``probs[j]`` of ``columns[i]``.

    Missing, NaN and infinite values are left out; a column without values gives NULL. The
    columns are written once (a double per value), and all rounds read that.
    """
    values = written(df.select(*[finite(c(n).cast("double")).alias(f"v_{i}") for i, n in enumerate(columns)]), "quantiles")
    ends = values.agg(*[e for i in range(len(columns)) for e in (
        F.count(f"v_{i}").alias(f"n_{i}"), F.min(f"v_{i}").alias(f"lo_{i}"), F.max(f"v_{i}").alias(f"hi_{i}"))]).first()
    # Open searches: (column, rank) -> smallest and largest value left, values before them.
    found: dict[tuple[int, int], float] = {}
    spans: dict[tuple[int, int], tuple[float, float, int]] = {}
    for i in range(len(columns)):
        n = ends[f"n_{i}"]
        for p in probs if n else ():
            for rank in _ranks(n, p)[:2]:
                _place(found, spans, (i, rank), ends[f"lo_{i}"], ends[f"hi_{i}"], 0)
    while spans:
        _narrow(values, found, spans, buckets)
    cells = []
    for i in range(len(columns)):
        for j, p in enumerate(probs):
            value = None
            if ends[f"n_{i}"]:
                low, high, part = _ranks(ends[f"n_{i}"], p)
                value = found[i, low] + (found[i, high] - found[i, low]) * part
            cells.append(F.lit(value).cast("double").alias(f"q_{i}_{j}"))
    return df.sparkSession.range(1).select(*cells)


def _place(found: dict, spans: dict, key: tuple[int, int], lo: float, hi: float, before: int) -> None:
    if lo == hi:
        found[key] = lo
        spans.pop(key, None)
    else:
        spans[key] = (lo, hi, before)


def _narrow(values: DataFrame, found: dict, spans: dict, buckets: int) -> None:
    """One round for all open searches; several in the same span share a count."""
    shared: dict[tuple[int, float, float], int] = {}
    for (i, _), (lo, hi, _) in spans.items():
        shared.setdefault((i, lo, hi), len(shared))
    cells = []
    for (i, lo, hi), s in shared.items():
        v, width = F.col(f"v_{i}"), hi / buckets - lo / buckets
        # Halves first: the difference of two huge numbers may not be finite.
        bucket = F.floor((v / 2 - lo / 2) / (width / 2)) if width > 0 else (v > lo).cast("long")
        cells.append(F.when(v.between(lo, hi), F.struct(
            F.lit(s).alias("s"), F.least(bucket, F.lit(buckets - 1)).alias("b"), v.alias("v"))))
    counted: dict[int, list] = {}
    rows = rows_from(values, [], cells).groupBy("s", "b").agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    for r in rows.collect():
        counted.setdefault(r["s"], []).append((r["lo"], r["hi"], r["n"]))
    for (i, rank), (lo, hi, before) in list(spans.items()):
        for low, high, n in sorted(counted[shared[i, lo, hi]]):
            if before + n > rank:
                _place(found, spans, (i, rank), low, high, before)
                break
            before += n


def quantile_table(df: DataFrame, columns: Sequence[str], probs: Sequence[float], **kw) -> DataFrame:
    """Long form: one row ``(channel, prob, value)`` per column and probability."""
    wide = quantiles(df, columns, probs, **kw)
    cells = [F.struct(F.lit(n).alias("channel"), F.lit(float(p)).alias("prob"),
                      F.col(f"q_{i}_{j}").alias("value"))
             for i, n in enumerate(columns) for j, p in enumerate(probs)]
    return wide.select(F.inline(F.array(*cells)))
