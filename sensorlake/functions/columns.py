"""Scalar column helpers shared by batch and streaming operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlake.spec import NULL_MARKER


def finite(value: Column) -> Column:
    """The number, or NULL for NaN and infinities: both count as missing everywhere."""
    # x - x is 0 for finite numbers only.
    return F.when((value - value) == 0, value)


def finite_numbers(df: DataFrame) -> DataFrame:
    """All floating-point columns with NaN and infinities as NULL; done where data enter."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    return df.withColumns({n: finite(F.col(f"`{n}`")) for n in floats}) if floats else df


def parsed(text: Column) -> Column:
    """Text to double, NULL when it is no number.

    A cast alone would also take Java literals with a type suffix such as ``1.5d``.
    """
    doubtful = reduce(lambda a, b: a | b, [F.endswith(text, F.lit(x)) for x in ("d", "D", "f", "F", " ")])
    # The costly test runs only behind the cheap one.
    suffixed = doubtful & text.rlike(r"[0-9.][dDfF]\s*$")
    return F.when(~suffixed, text).try_cast("double")


def to_double(text: Column) -> Column:
    """Text to a finite double; ``NaN``, ``Infinity`` and overflowing numbers give NULL."""
    return finite(parsed(text))


def to_int(text: Column) -> Column:
    """Text to int through double, truncating toward zero."""
    return to_double(text).try_cast("int")


def double_or(text: Column, default: float = 0.0) -> Column:
    return F.coalesce(to_double(text), F.lit(float(default)))


def int_or(text: Column, default: int = 0) -> Column:
    return F.coalesce(to_int(text), F.lit(int(default)))


def or_marker(value: Column) -> Column:
    """Text form with the missing-value marker in place of NULL."""
    return F.coalesce(value.cast("string"), F.lit(NULL_MARKER))


def label_text(prediction: Column, fire: str = "Fire Detected", clear: str = "No Fire") -> Column:
    return F.when(prediction == 1, fire).otherwise(clear)


def alert_level(prediction: Column, confidence: Column) -> Column:
    """Level of a positive prediction by confidence; NONE for a negative one."""
    return (F.when(~F.coalesce(prediction == 1, F.lit(False)), "NONE")
            .when(confidence > 0.9, "CRITICAL")
            .when(confidence > 0.7, "HIGH")
            .otherwise("MEDIUM"))


def row_norm(columns: list[Column]) -> Column:
    """Euclidean length of a row; NULL cells count as NULL."""
    return F.sqrt(reduce(lambda a, b: a + b, [x * x for x in columns]))


def ratio(part: Column, whole: Column, default: float | None = 0.0) -> Column:
    out = F.try_divide(part.cast("double"), whole.cast("double"))
    return out if default is None else F.coalesce(out, F.lit(default))


def day_of_week(ts: Column) -> Column:
    """Monday = 0."""
    return F.weekday(ts)


def texts(items: list[Column]) -> Column:
    """Array of the non-null texts among ``items`` (which must differ from one another).

    ``array_compact`` would do the same, but it is a lambda function, and those
    evaluate everything below them without generated code.
    """
    return F.array_except(F.array(*items), F.array(F.lit(None).cast("string")))


def rows_from(df: DataFrame, keep: Sequence[str], items: list[Column]) -> DataFrame:
    """One row per non-null struct among ``items``, with the kept columns.

    All items are produced in the same generated loop and the absent ones filtered
    right behind it. The first field of the struct must not be NULL in a real item.
    """
    out = df.select(*[F.col(f"`{k}`") for k in keep], F.inline(F.array(*items)))
    return out.where(F.col(f"`{out.columns[len(keep)]}`").isNotNull())


def once(value: Column) -> Column:
    """Select-list generator that evaluates ``value`` one time per row.

    The optimizer copies a plain expression into every later projection and filter
    that uses it; a generator's output is computed once and filters stay above it.
    """
    return F.explode(F.array(value))
