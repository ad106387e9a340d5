"""Splitters of a weighted key by repeated exact counting.

Each round counts, in one aggregation, the exact weight and rows between candidate
boundaries. The rounds go on between the two candidates around each target until a
candidate is within tolerance, or until one single key lies between them. Only the
counts of the candidates reach the driver: at most ``parts * probes`` rows a round.
"""

from __future__ import annotations

import bisect
import math
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Keys are whole numbers that a double holds exactly.
KEY_BITS = 52
MOST_PARTS = 8192


@dataclass(frozen=True)
class Splitter:
    """``weight`` and ``rows`` are those of all keys below ``key``."""

    key: int
    weight: int
    rows: int


def bucketed(df: DataFrame, key: str, bounds: list[int], out: str) -> DataFrame:
    """Add ``out``: how many of the ascending ``bounds`` are at or below the key."""
    if not bounds:
        return df.withColumn(out, F.lit(0))
    splits = [-math.inf, *map(float, bounds), math.inf]
    marked = Bucketizer(splits=splits, inputCol=key, outputCol=out).transform(df)
    return marked.withColumn(out, F.col(out).cast("int"))


def splitters(points: DataFrame, parts: int, tolerance: float, *, coarse: int = 0,
              coarse_tolerance: float = 0.0, probes: int = 24) -> tuple[list[Splitter], int, int]:
    """The ``parts - 1`` splitters of ``points`` (key double, weight long), total weight, rows.

    ``points`` should be a narrow written table: each round reads it. A target is met
    within ``tolerance`` of a part's weight, and within ``coarse_tolerance`` of it at
    each ``coarse``-th splitter. Equal keys are never parted; such splitters may coincide.
    """
    if not 1 <= parts <= MOST_PARTS:
        raise ValueError(f"parts must be between 1 and {MOST_PARTS}")
    ends = points.agg(F.min("key").alias("lo"), F.max("key").alias("hi"),
                      F.sum("weight").alias("w"), F.count(F.lit(1)).alias("n")).first()
    if not ends.n:
        return [Splitter(0, 0, 0)] * (parts - 1), 0, 0
    total = int(ends.w)
    known = [Splitter(int(ends.lo), 0, 0), Splitter(int(ends.hi) + 1, total, int(ends.n))]
    targets = [total * i // parts for i in range(1, parts)]
    slack = [(coarse_tolerance if coarse and i % coarse == 0 else tolerance) * total / parts
             for i in range(1, parts)]
    while True:
        weights = [s.weight for s in known]
        chosen, candidates = [], set()
        for target, most in zip(targets, slack):
            at = bisect.bisect_right(weights, target)
            lo, hi = known[at - 1], known[min(at, len(known) - 1)]
            near = min((lo, hi), key=lambda s: abs(s.weight - target))
            chosen.append(near)
            if abs(near.weight - target) > most and hi.key - lo.key > 1:
                step = (hi.key - lo.key) / (probes + 1)
                candidates.update(k for j in range(1, probes + 1)
                                  if lo.key < (k := lo.key + round(step * j)) < hi.key)
        if not candidates:
            return chosen, total, int(ends.n)
        bounds = sorted(candidates)
        counted = {r.bin: (int(r.w), int(r.n)) for r in
                   bucketed(points, "key", bounds, "bin").groupBy("bin")
                   .agg(F.sum("weight").alias("w"), F.count(F.lit(1)).alias("n")).collect()}
        weight = rows = 0
        fresh = []
        for i, bound in enumerate(bounds):
            w, n = counted.get(i, (0, 0))
            weight, rows = weight + w, rows + n
            fresh.append(Splitter(bound, weight, rows))
        known = sorted({*known, *fresh}, key=lambda s: s.key)
