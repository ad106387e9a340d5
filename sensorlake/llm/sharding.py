"""Histogram-sort sharding: equal bytes per shard after a single exchange.

Documents are ordered by a key. Exact byte counts below candidate boundaries are
refined until the splitters meet the tolerance (``histogram.splitters``); then every
row moves once, to its slice. A shard consists of several slices, so that a shard is
no single task, and the exact row counts below the splitters number its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorlake.llm.common import columns_of, fresh, without, written
from sensorlake.llm.histogram import MOST_PARTS, bucketed, splitters

TIE_BITS = 12


def text_size(text: str = "text") -> Column:
    """UTF-8 bytes plus 1; a null text has no bytes."""
    return (F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)) + 1).cast("long")


def spread_key(*columns: str) -> Column:
    """52-bit key: 40 bits of the columns' hash, then 12 bits of the row's place in the input.

    The last bits part rows that are equal in all columns, however many there are. The
    input must be a table scan (or another plan whose rows stay in place when re-run).
    """
    content = F.shiftrightunsigned(F.xxhash64(*[F.col(f"`{c}`") for c in columns]), 24)
    tie = F.shiftrightunsigned(F.xxhash64(F.monotonically_increasing_id()), 64 - TIE_BITS)
    return (F.shiftleft(content, TIE_BITS) + tie).cast("double")


def histogram_shards(docs: DataFrame, n_shards: int = 8, *, size: Column | None = None,
                     key: Column | None = None, tolerance: float = 0.001,
                     slice_bytes: int = 4 << 20) -> DataFrame:
    """``docs`` with ``size`` long, ``shard`` int and ``slot`` long (gapless from 0 in a shard).

    ``key``: the sort key, a double of whole numbers below 2**52 (default: a hash, which
    shuffles the documents). ``tolerance``: how far a boundary may be from its place, in
    parts of a shard, unless a single row or a run of equal keys lies there.

    Null columns take part in the hash as nulls; a null text has size 1. An empty table
    gives an empty result. Repeated rows are rows like any other. Columns of ``docs``
    named like a result column are replaced.
    """
    if n_shards < 1 or n_shards > MOST_PARTS:
        raise ValueError(f"n_shards must be between 1 and {MOST_PARTS}")
    spark = docs.sparkSession
    kept = without(docs, "size", "shard", "slot")
    size_, key_, slice_, before_ = fresh(kept, "_size", "_key", "_slice", "_before")
    sizes = text_size() if size is None else size.cast("long")
    keys = spread_key("doc_id", "text") if key is None else key.cast("double")
    points = written(docs.select(keys.alias("key"), sizes.alias("weight")), "sizes")
    total = points.agg(F.sum("weight")).first()[0] or 0
    per_shard = max(1, min(MOST_PARTS // n_shards, -(-total // (n_shards * slice_bytes))))
    found, _, _ = splitters(points, n_shards * per_shard, 0.05, coarse=per_shard,
                            coarse_tolerance=tolerance * per_shard)
    # Coinciding splitters enclose nothing: the last one of them opens the next slice.
    first_row = [0] + [s.rows for s in found]
    bounds, slices = [], [(0, 0, 0)]
    for i, s in enumerate(found, start=1):
        shard = i // per_shard
        row = (shard, s.rows - first_row[shard * per_shard])
        if bounds and bounds[-1] == s.key:
            slices[-1] = (len(bounds), *row)
        else:
            bounds.append(s.key)
            slices.append((len(bounds), *row))
    # At most MOST_PARTS rows of three numbers.
    start = spark.createDataFrame(slices, f"{slice_} int, shard int, {before_} long")
    placed = docs.select(*columns_of(kept), sizes.alias(size_), keys.alias(key_))
    moved = bucketed(placed, key_, bounds, slice_).join(F.broadcast(start), slice_)
    place = F.row_number().over(Window.partitionBy(slice_).orderBy(key_))
    return moved.select(*columns_of(kept), F.col(size_).alias("size"), "shard",
                        (F.col(before_) + place - 1).alias("slot"))
