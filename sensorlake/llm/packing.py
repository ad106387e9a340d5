"""Sequence packing along a space-filling curve.

Every document is tokenised once. A hashed vector of its tokens is projected to a few
dimensions; their Hilbert index is the document's place on the curve, so that neighbours
on it are alike. The documents are range-sorted by it and laid end to end, and the line is
cut every ``LENGTH`` tokens: no sequence but the last has padding. A document's place on
the line follows from exact token counts of the ranges before its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorlake.llm.common import bounded_batches, pieces_of, written
from sensorlake.llm.histogram import MOST_PARTS, bucketed, splitters
from sensorlake.llm.wordbpe import ID, word_bpe

LENGTH = 2048
# Added after each document.
END = 1
VECTOR, DIMS, LEVELS = 512, 4, 8
# Bits of the key besides the curve's: they part documents at one place of the curve.
TIE_BITS = 20
ONE_END = np.array([END], ID).tobytes()


def projection(seed: int = 3) -> np.ndarray:
    return np.random.default_rng(seed).normal(0, 1, (VECTOR, DIMS))


def hashed_vector(ids: np.ndarray) -> np.ndarray:
    """Unit vector of damped counts of hashed token ids."""
    slots = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(55)
    v = np.sqrt(np.bincount(slots.astype(np.int64), minlength=VECTOR))
    return v / max(1e-9, np.sqrt((v * v).sum()))


def hilbert_index(x: np.ndarray, bits: int = LEVELS) -> np.ndarray:
    """Hilbert curve index of rows of ``bits``-bit coordinates (Skilling's transform)."""
    x = x.astype(np.int64).copy()
    n = x.shape[1]
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[:, i] & q) != 0
            swap = np.where(high, 0, (x[:, 0] ^ x[:, i]) & p)
            x[:, 0] = np.where(high, x[:, 0] ^ p, x[:, 0] ^ swap)
            x[:, i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[:, i] ^= x[:, i - 1]
    t = np.zeros(len(x), np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[:, n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t[:, None]
    out = np.zeros(len(x), np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            out = (out << 1) | ((x[:, i] >> b) & 1)
    return out


TOKENS = ("row long, doc_id long, n int, ids binary, " + ", ".join(f"p{i} double" for i in range(DIMS)))


def tokenised(docs: DataFrame, path: str) -> DataFrame:
    """(row, doc_id, n, ids, p0 .. p3): each row's token ids and projected vector."""
    cast = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, plane = word_bpe(path), projection()
        for batch in batches:
            for piece in pieces_of(batch, most_bytes=2 << 20):
                ids = [x + ONE_END for x in tokens.encode(piece.column("text").to_pylist())]
                p = np.array([hashed_vector(np.frombuffer(x, ID)) for x in ids]) @ plane
                yield pa.record_batch(
                    [piece.column("row"), piece.column("doc_id"),
                     pa.array([len(x) // ID.itemsize for x in ids], pa.int32()), pa.array(ids, pa.binary()),
                     *[pa.array(p[:, i]) for i in range(DIMS)]],
                    names=["row", "doc_id", "n", "ids", *[f"p{i}" for i in range(DIMS)]])

    return cast.mapInArrow(run, TOKENS)


def spread(tokens: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of each projected dimension."""
    stats = tokens.agg(*[f(f"p{i}") for i in range(DIMS) for f in (F.avg, F.stddev_pop)]).first()
    return (np.array([stats[2 * i] or 0.0 for i in range(DIMS)]),
            np.array([stats[2 * i + 1] or 1.0 for i in range(DIMS)]))


def _keyed(tokens: DataFrame, mean: np.ndarray, width: np.ndarray) -> DataFrame:
    """Add ``key``: the place on the curve, with a hash of the row below it."""
    @F.pandas_udf("long")
    def curve(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
        p = np.stack([a, b, c, d], axis=1)
        # A smooth step sends a bell-shaped spread to nearly even cells.
        even = 1 / (1 + np.exp(-1.702 * np.clip((p - mean) / width, -20, 20)))
        cells = np.minimum((even * (1 << LEVELS)).astype(np.int64), (1 << LEVELS) - 1)
        return pd.Series(hilbert_index(cells))

    tie = F.shiftrightunsigned(F.xxhash64("row"), 64 - TIE_BITS)
    return tokens.withColumn("key", (F.shiftleft(curve(*[f"p{i}" for i in range(DIMS)]), TIE_BITS) + tie)
                             .cast("double"))


PIECES = ("doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, "
          "`offset` long")


def pack(docs: DataFrame, path: str, *, length: int = LENGTH, slice_tokens: int = 1 << 20) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset): the pieces of all documents.

    ``path``: a tokeniser file that every executor has. ``ids`` holds little-endian unsigned
    32-bit token ids. Null and empty texts are the end token alone. Repeated rows and rows
    without ``doc_id`` are packed like any other; other columns are ignored; an empty
    table gives an empty result.
    """
    spark = docs.sparkSession
    bounded_batches(docs.sparkSession)
    tokens = written(tokenised(docs, path), "tokens")
    numbers = ["row", "doc_id", "n", *[f"p{i}" for i in range(DIMS)]]
    # Row numbers are stored by now and the spread is measured once (sums of floating-point
    # numbers depend on their order), so that the keys are the same in every job.
    measured = spread(tokens)
    places = written(_keyed(tokens.select(*numbers), *measured).select("row", "n", "key"), "places")
    points = places.select("key", F.col("n").cast("long").alias("weight"))
    total = points.agg(F.sum("weight")).first()[0] or 0
    found, _, _ = splitters(points, max(1, min(MOST_PARTS, -(-total // slice_tokens))), 0.1)
    bounds, slices = [], [(0, 0)]
    for s in found:
        if bounds and bounds[-1] == s.key:
            slices[-1] = (len(bounds), s.weight)
        else:
            bounds.append(s.key)
            slices.append((len(bounds), s.weight))
    # At most MOST_PARTS rows of two numbers; an Arrow table reaches the executors without Python workers.
    before = F.broadcast(spark.createDataFrame(pa.table(
        {"_slice": pa.array([s for s, _ in slices], pa.int32()), "_before": pa.array([w for _, w in slices], pa.int64())})))
    order = Window.partitionBy("_slice").orderBy("key", "row")
    sofar = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1))
    # Every slice is in ``before``. An inner join would filter by the slice first and so work out each key twice, by
    # two Python workers a core.
    line = bucketed(_keyed(tokens, *measured).drop(*[f"p{i}" for i in range(DIMS)]), "key", bounds, "_slice").join(
        before, "_slice", "left").withColumn("at", F.col("_before") + F.coalesce(sofar, F.lit(0)))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (piece for whole in batches for piece in pieces_of(whole, "ids")):
            rows = []
            for doc, n, ids, at in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "n", "ids", "at")]):
                start = 0
                while start < n:
                    sequence, offset = divmod(at + start, length)
                    size = min(n - start, length - offset)
                    rows.append((doc, start, size, ids[start * ID.itemsize:(start + size) * ID.itemsize], n,
                                 sequence, offset))
                    start += size
            types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.record_batch([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)],
                                  names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    return line.select("doc_id", "n", "ids", "at").mapInArrow(cut, PIECES)
