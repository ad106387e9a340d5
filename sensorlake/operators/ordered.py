"""Ordered-window operators that keep working when one key holds most rows.

A plain ``Window.partitionBy(key)`` puts a key's whole history into one task.
Here each key's timeline is cut into time slices; ``(key, slice)`` is the unit of
work, and only what has to cross a slice border is exchanged a second time:

* ``rows_window``   frames counted in rows: the few rows next to a border.
* ``sliding_sums``  sums over the last values of a whole number (seconds, row numbers): blocks as
                    wide as the frame, so that a frame is the end of one block and the start of the next.
* ``running``       unbounded prefixes: one subtotal row per ``(key, slice)``.
* ``islands``       runs of a true condition: only the first and last row of each run.

Results equal the plain window's. ``slice_seconds_for`` measures a table: it gives
the slice width that keeps every task small, or None if no key needs slicing. With
``slice_seconds=None`` the operators are plain windows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from sensorlake.spec import c

# A slice has few border rows, so that many slices' borders fit one task.
BORDER_WIDTH = 64

WindowExprs = Callable[[WindowSpec], dict[str, Column]]


def _slice_of(ts: str, seconds: float) -> Column:
    micros = F.unix_micros(c(ts).cast("timestamp"))
    return F.floor(micros / F.lit(float(round(seconds * 1_000_000))))


def _by(keys: Sequence[str], *more: str) -> list[Column]:
    return [c(k) for k in (*keys, *more)]


def rows_window(df: DataFrame, keys: Sequence[str], order: Sequence[str], *exprs: WindowExprs,
                before: int = 0, after: int = 0, slice_seconds: float | None = None,
                levels: int = 2) -> DataFrame:
    """Add window columns whose frames reach ``before`` rows back and ``after`` rows ahead.

    ``order`` starts with the event time and ends with a unique column. Each of
    ``exprs`` receives the ordered window and builds columns from it (a frame or
    lag/lead no wider than announced); a later one may use the columns of an earlier.

    The rows near borders form a table with the same neighbours, which is windowed in
    turn with ``BORDER_WIDTH`` times wider slices, ``levels`` times in all, before the
    few rows left are windowed per key.
    """
    def apply(rows: DataFrame, window: WindowSpec) -> DataFrame:
        for e in exprs:
            rows = rows.withColumns(e(window))
        return rows

    across = Window.partitionBy(*_by(keys)).orderBy(*_by(order))
    if slice_seconds is None or levels == 0:
        return apply(df, across)
    reach = before + after
    in_slice = Window.partitionBy(*_by(keys, "_slice"))
    placed = df.withColumn("_slice", _slice_of(order[0], slice_seconds)).withColumns({
        "_pos": F.row_number().over(in_slice.orderBy(*_by(order))),
        "_size": F.count(F.lit(1)).over(in_slice),
    })
    complete = (F.col("_pos") > before) & (F.col("_pos") <= F.col("_size") - after)
    near_border = (F.col("_pos") <= reach) | (F.col("_pos") > F.col("_size") - reach)

    inner = apply(placed, in_slice.orderBy(*_by(order))).where(complete)
    helpers, unfinished = ["_slice", "_pos", "_size"], f"_unfinished{levels}"
    near = placed.where(near_border).withColumn(unfinished, ~complete).drop(*helpers)
    border = rows_window(near, keys, order, *exprs, before=before, after=after,
                         slice_seconds=slice_seconds * BORDER_WIDTH, levels=levels - 1)
    return inner.drop(*helpers).unionByName(border.where(unfinished).drop(unfinished))


def sliding_sums(df: DataFrame, keys: Sequence[str], at: Column, reach: int, sums: dict[str, Column]) -> DataFrame:
    """Add sums over a key's rows whose ``at`` (whole numbers) lies in ``[at - reach, at]`` of each row.

    Blocks are ``reach + 1`` wide, so that a frame is the start of its row's block and the end
    of the block before. A block's starts are running sums forwards; its ends, running sums
    backwards over a copy of its values in the next block, where a copy drops out ``reach``
    after its own place. Nothing is subtracted, so that a large value leaves no trace in
    frames without it, and the work is linear in the rows. Blocks lie at fixed places and
    ``(key, block)`` is the unit of work: twice a frame's rows at most, however busy the key.

    NULL counts as nothing, and a frame without any value has sum 0. Rows without ``at`` form
    one frame of their own. Rows of one ``at`` are peers: each has the sum of all of them.
    """
    start = F.col("_at") - F.pmod(F.col("_at"), F.lit(reach + 1))
    rows = df.withColumns({"_at": at.cast("long"), **{f"_v_{n}": e for n, e in sums.items()}}).withColumn("_start", start)
    both = F.when(F.col("_start").isNull(), F.array("_start")).otherwise(F.array("_start", F.col("_start") + reach + 1))
    own = F.col("_start").eqNullSafe(F.col("_block"))
    dealt = rows.withColumn("_block", F.explode(both)).withColumn("_own", own)
    # Copies carry their values only.
    dealt = dealt.withColumns({n: F.when(F.col("_own"), c(n)) for n in df.columns if n not in keys})
    by = _by(keys, "_block")
    # Said outright: rows that already lie by key alone would stay so, a whole key in one task.
    dealt = dealt.repartition(*by)
    forwards = Window.partitionBy(*by).orderBy("_at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    until = F.when(F.col("_own"), F.col("_at")).otherwise(F.col("_at") + reach)
    backwards = (Window.partitionBy(*by).orderBy(until.desc(), F.col("_own"))
                 .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    zero = F.lit(0)
    starts = {f"_p_{n}": F.sum(F.when(F.col("_own"), F.col(f"_v_{n}"))).over(forwards) for n in sums}
    ends = {f"_e_{n}": F.sum(F.when(~F.col("_own"), F.col(f"_v_{n}"))).over(backwards) for n in sums}
    out = dealt.withColumns(starts).withColumns(ends).where("_own").withColumns(
        {n: F.coalesce(F.col(f"_p_{n}"), zero) + F.coalesce(F.col(f"_e_{n}"), zero) for n in sums})
    return out.drop("_at", "_start", "_block", "_own", *[f"_{x}_{n}" for n in sums for x in "vpe"])


def range_sums(df: DataFrame, keys: Sequence[str], ts: str, seconds: int, sums: dict[str, Column]) -> DataFrame:
    """Add sums over the last ``seconds`` seconds up to each row (peers included)."""
    return sliding_sums(df, keys, F.unix_seconds(c(ts).cast("timestamp")), seconds, sums)


def running(df: DataFrame, keys: Sequence[str], order: Sequence[str],
            sums: dict[str, Column], *, slice_seconds: float | None = None) -> DataFrame:
    """Add running totals from each key's first row to the current row."""
    if slice_seconds is None:
        whole = (Window.partitionBy(*_by(keys)).orderBy(*_by(order))
                 .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        return df.withColumns({n: F.coalesce(F.sum(e).over(whole), F.lit(0)) for n, e in sums.items()})
    sliced = df.withColumns({"_slice": _slice_of(order[0], slice_seconds),
                             **{f"_v_{n}": e for n, e in sums.items()}})
    totals = sliced.groupBy(*_by(keys, "_slice")).agg(
        *[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums])
    earlier = (Window.partitionBy(*_by(keys)).orderBy("_slice")
               .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(
        *[c(k).alias(f"_k{i}") for i, k in enumerate((*keys, "_slice"))],
        *[F.coalesce(F.sum(f"_t_{n}").over(earlier), F.lit(0)).alias(f"_o_{n}") for n in sums])
    # Subtotals are one row per (key, slice); Spark broadcasts them only if they are small.
    same = None
    for i, k in enumerate((*keys, "_slice")):
        hit = c(k).eqNullSafe(F.col(f"_k{i}"))
        same = hit if same is None else same & hit
    upto = (Window.partitionBy(*_by(keys, "_slice")).orderBy(*_by(order))
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = sliced.join(offsets, same).withColumns(
        {n: F.coalesce(F.sum(f"_v_{n}").over(upto), F.lit(0)) + F.col(f"_o_{n}") for n in sums})
    return out.drop("_slice", *[f"_k{i}" for i in range(len(keys) + 1)],
                    *[f"_v_{n}" for n in sums], *[f"_o_{n}" for n in sums])


def islands(df: DataFrame, keys: Sequence[str], order: Sequence[str], condition: Column,
            *, slice_seconds: float | None = None) -> DataFrame:
    """One row ``(keys, start_time, end_time)`` per maximal run of rows meeting ``condition``."""
    ts = order[0]
    flagged = df.select(*_by((*keys, *order)),
                        F.coalesce(condition, F.lit(False)).alias("_on"))
    seen = rows_window(
        flagged, keys, order,
        lambda w: {"_prev": F.lag("_on").over(w), "_next": F.lead("_on").over(w)},
        before=1, after=1, slice_seconds=slice_seconds)
    ends = seen.where("_on").select(
        *_by((*keys, *order)),
        (~F.coalesce("_prev", F.lit(False))).alias("_first"),
        (~F.coalesce("_next", F.lit(False))).alias("_last"),
    ).where("_first OR _last")
    # First and last rows alternate, so a run's end is on its own row or the next one.
    paired = rows_window(
        ends, keys, order,
        lambda w: {"end_time": F.when(F.col("_last"), c(ts)).otherwise(F.lead(c(ts)).over(w))},
        after=1, slice_seconds=slice_seconds)
    return paired.where("_first").select(*_by(keys), c(ts).alias("start_time"), "end_time")


def slice_seconds_for(df: DataFrame, keys: Sequence[str], ts: str,
                      rows_per_slice: int = 2_000_000) -> float | None:
    """Slice width that keeps even the busiest hour's slices near ``rows_per_slice`` rows.

    None if every key has at most that many rows altogether. Reads only the key and
    time columns, counts them before the shuffle and returns two numbers to the driver.
    """
    hour = F.date_trunc("hour", c(ts).cast("timestamp"))
    cells = df.groupBy(*_by(keys), hour.alias("_hour")).agg(F.count(F.lit(1)).alias("_n"))
    per_key = cells.groupBy(*_by(keys)).agg(F.sum("_n").alias("_n"), F.max("_n").alias("_busiest"))
    row = per_key.agg(F.max("_n").alias("total"), F.max("_busiest").alias("busiest")).first()
    if row.total is None or row.total <= rows_per_slice:
        return None
    return max(0.001, 3600.0 * rows_per_slice / row.busiest)
