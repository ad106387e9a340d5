"""Historical patterns: alarm rates over time, correlations, arg-max, recent rows, retention."""

from __future__ import annotations

from collections.abc import Sequence
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorlake.functions.columns import day_of_week, rows_from
from sensorlake.spec import DEFAULT_SPEC, SensorSpec, c


def alarm_calendar(df: DataFrame, spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    """Readings and alarms by weekday and hour: at most 168 rows, the base of all rates."""
    ts = c(spec.event_time)
    return df.groupBy(day_of_week(ts).alias("weekday"), F.hour(ts).alias("hour")).agg(
        F.count(c(spec.label)).alias("readings"), F.sum(c(spec.label)).alias("alarms"))


def alarm_rate_by(calendar: DataFrame, part: str) -> DataFrame:
    return calendar.groupBy(part).agg(
        F.sum("readings").alias("readings"),
        F.try_divide(F.sum("alarms"), F.sum("readings")).alias("alarm_rate"))


def peak(rates: DataFrame, part: str) -> DataFrame:
    """Key of the highest rate; the smallest key wins a tie."""
    return rates.agg(
        F.max_by(part, F.struct("alarm_rate", -F.col(part))).alias(f"peak_{part}"),
        F.max("alarm_rate").alias("peak_rate"))


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, in one pass.

    One aggregate per pair would be too much code to compile. Instead each row
    appears once per distance ``k`` next to its columns shifted by ``k`` places, and
    a group per ``k`` correlates every column with its shifted partner.
    """
    n = len(columns)
    shifts = range(1, n // 2 + 1)
    x = [c(name).cast("double") for name in columns]
    shifted = F.inline(F.array(*[
        F.struct(F.lit(k).alias("k"), *[x[(i + k) % n].alias(f"y_{i}") for i in range(n)])
        for k in shifts]))
    pairs = df.select(*[e.alias(f"x_{i}") for i, e in enumerate(x)], shifted)
    wide = pairs.groupBy("k").agg(*[F.corr(f"x_{i}", f"y_{i}").alias(f"r_{i}") for i in range(n)])
    names = F.array(*map(F.lit, columns))
    cells = wide.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("a"), ((F.lit(i) + F.col("k")) % n).alias("b"),
                 F.col(f"r_{i}").alias("r")) for i in range(n)])))
    # With an even number of columns the largest shift meets every pair twice.
    ordered = cells.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "r")
    return (ordered.groupBy("a", "b").agg(F.max("r").alias("r"))
            .select(names[F.col("a")].alias("x"), names[F.col("b")].alias("y"), "r"))


def label_correlations(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    wide = df.agg(*[F.corr(c(n).cast("double"), c(label).cast("double")).alias(f"r_{i}")
                    for i, n in enumerate(columns)])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("channel"), F.abs(F.col(f"r_{i}")).alias("strength"))
        for i, n in enumerate(columns)])))


def top_indicators(df: DataFrame, columns: Sequence[str], label: str, k: int = 5) -> DataFrame:
    """The ``k`` channels most correlated with the label (label itself excluded).

    Strengths that differ by float noise only (channels proportional to one another) are
    ties, which go by name.
    """
    others = [n for n in columns if n != label]
    return (label_correlations(df, others, label).where("strength IS NOT NULL")
            .orderBy(F.round("strength", 9).desc(), "channel").limit(k))


def newest(df: DataFrame, n: int, spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    return df.orderBy(c(spec.event_time).desc(), c(spec.row_id).desc()).limit(n)


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    return df.orderBy(*[c(o) for o in order]).limit(n)


def retention_plan(items: DataFrame, family: str, modified: str, item: str, size: str,
                   run_date: str, *, keep_newest: int = 5, max_age_days: int = 30) -> DataFrame:
    """Items a retention run would drop, with reasons and size; nothing is deleted.

    The ``keep_newest``-th item of each family is found first (ranking stops at
    that many rows per task), then every item is compared with that cut. A family
    holding most items is therefore never sorted as a whole.
    """
    order = Window.partitionBy(c(family)).orderBy(c(modified).desc(), c(item).desc())
    cut = (items.select(c(family), c(modified), c(item))
           .withColumn("_rank", F.row_number().over(order))
           .where(F.col("_rank") <= keep_newest)
           .groupBy(c(family)).agg(
               F.count(F.lit(1)).alias("_kept"),
               F.min(F.struct(c(modified).alias("m"), c(item).alias("i"))).alias("_cut")))
    joined = items.join(cut.withColumnRenamed(family, "_family"),
                        c(family).eqNullSafe(F.col("_family")))
    surplus = F.struct(c(modified).alias("m"), c(item).alias("i")) < F.col("_cut")
    expired = c(modified) < F.date_sub(F.lit(run_date).cast("date"), max_age_days)
    return (joined.select(c(family), c(item), c(modified), c(size),
                          surplus.alias("surplus"), expired.alias("expired"))
            .where("surplus OR expired"))


def retention_summary(plan: DataFrame, family: str, size: str) -> DataFrame:
    return plan.groupBy(c(family)).agg(
        F.count_if("surplus").alias("surplus_items"), F.count_if("expired").alias("expired_items"),
        F.sum(c(size)).alias("freed"))


# A topic asks for attention beyond its bound: above, or (accuracy) below it.
BOUNDS = {"max_temperature": 80.0, "accuracy": 0.85}


def insights(report: DataFrame) -> DataFrame:
    """Facts of a one-row pattern report as rows ``(topic, subject, value, bound, attention)``.

    Columns read: ``peak_hour``, ``peak_weekday`` (Monday = 0), ``indicator``, ``strength``,
    ``mean_temperature``, ``max_temperature``, ``fire_rate``, ``accuracy``; a missing one
    gives no row.
    """
    def fact(topic: str, value: Column, subject: Column | None = None) -> Column:
        bound = F.lit(BOUNDS.get(topic)).cast("double")
        number = value.cast("double")
        beyond = number < bound if topic == "accuracy" else number > bound
        return F.when(value.isNotNull(), F.struct(
            F.lit(topic).alias("topic"), (F.lit(None) if subject is None else subject).cast("string").alias("subject"),
            number.alias("value"), bound.alias("bound"), F.coalesce(beyond, F.lit(False)).alias("attention")))

    plain = ("peak_hour", "peak_weekday", "mean_temperature", "max_temperature", "fire_rate", "accuracy")
    return rows_from(report, [], [fact(t, F.col(t)) for t in plain]
                     + [fact("indicator", F.col("strength"), F.col("indicator"))])
