"""Prediction tables: rule scorers, model output, error rows, keyed scoring, summaries."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.ml.functions import vector_to_array

from sensorlake.functions.columns import alert_level, finite, label_text, once, ratio, texts
from sensorlake.spec import DEFAULT_SPEC, TEMPERATURE, SensorSpec, c


def as_prediction(df: DataFrame, fire: Column, prediction: Column) -> DataFrame:
    """Add the prediction columns for a fire probability and a 0/1 prediction."""
    scored = df.withColumns({"score": fire, "prediction": prediction.cast("int")})
    return with_prediction_fields(scored)


def with_prediction_fields(scored: DataFrame) -> DataFrame:
    """Label, probabilities, confidence and alert level from ``score`` and ``prediction``."""
    confidence = F.greatest(F.col("score"), 1 - F.col("score"))
    return scored.withColumns({
        "prediction_label": label_text(F.col("prediction")),
        "probability": F.struct((1 - F.col("score")).alias("no_fire"), F.col("score").alias("fire")),
        "confidence": confidence,
    }).withColumn("alert_level", alert_level(F.col("prediction"), F.col("confidence")))


def rule_scores(df: DataFrame, limit: float = 60.0) -> DataFrame:
    """Temperature rule scorer: above ``limit`` fire with probability 0.8, else 0.2."""
    hot = F.coalesce(c(TEMPERATURE) > limit, F.lit(False))
    return as_prediction(df, F.when(hot, 0.8).otherwise(0.2), hot)


def linear_scores(df: DataFrame) -> DataFrame:
    """Score proportional to temperature, held within [0.01, 0.99], two decimals."""
    # The small offset keeps temperatures such as 28.5 off the rounding border.
    score = F.round(F.coalesce(F.least(F.lit(0.99), F.greatest(
        F.lit(0.01), c(TEMPERATURE) / 100)), F.lit(0.01)) + F.lit(1e-9), 2)
    return as_prediction(df, score, score > 0.5)


def weak_labels(temperature: Column, humidity: Column, smoke: Column,
                tvoc: Column | None = None) -> Column:
    """Rule label from temperature, humidity, smoke and optionally TVOC."""
    fire = (((temperature > 35) & (humidity < 30) & (smoke > 0.2))
            | ((temperature > 40) & (smoke > 0.15)) | (smoke > 0.3))
    if tvoc is not None:
        fire = fire | ((tvoc > 200) & (smoke > 0.1))
    return F.coalesce(fire, F.lit(False)).cast("int")


def model_scores(model, df: DataFrame) -> DataFrame:
    """Predictions of a fitted pipeline with a probability vector."""
    scored = model.transform(df)
    fire = vector_to_array("probability")[1]
    kept = [c(n) for n in df.columns]
    return with_prediction_fields(
        scored.select(*kept, fire.alias("score"), F.col("prediction").cast("int")))


def score_or_error(scored: DataFrame, errors: Column) -> DataFrame:
    """Blank the prediction of invalid readings and keep their errors, rows stay complete."""
    fields = ("score", "prediction", "prediction_label", "probability", "confidence", "alert_level")
    judged = scored.select("*", once(errors).alias("_errors"))
    text = F.when(F.size("_errors") > 0, F.array_join("_errors", "; "))
    return judged.withColumn("error", text).drop("_errors").withColumns({
        n: F.when(F.col("error").isNull(), F.col(n)) for n in fields if n in scored.columns})


def score_by_key(df: DataFrame, features: Sequence[str],
                 score: Callable[[DataFrame], DataFrame], digits: int = 2) -> DataFrame:
    """Score each distinct rounded feature vector once and join the result back.

    Large groups of equal vectors shrink to one row before the shuffle; on the way
    back Spark splits their side of the join (skew join) or broadcasts a small one.
    """
    rounded = [F.round(c(n).cast("double"), digits).alias(n) for n in features]
    names = [f"_k{i}" for i in range(len(features))]
    keyed = df.withColumns({k: F.round(c(n).cast("double"), digits)
                            for k, n in zip(names, features)})
    vectors = score(df.select(*rounded).distinct())
    added = [n for n in vectors.columns if n not in features]
    side = vectors.select(*[c(n).alias(f"_r{i}") for i, n in enumerate(features)],
                          *[c(n) for n in added])
    same = None
    for i in range(len(features)):
        hit = F.col(f"_k{i}").eqNullSafe(F.col(f"_r{i}"))
        same = hit if same is None else same & hit
    return keyed.join(side, same).drop(*names, *[f"_r{i}" for i in range(len(features))])


def attach(df: DataFrame, predictions: DataFrame, key: str) -> DataFrame:
    """Put separately stored predictions next to their readings."""
    return df.join(predictions, key)


def unlabelled(df: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Readings without ground truth."""
    return df.join(labels, key, "left_anti")


def _confidence_stats(std: Callable[[Column], Column]) -> list[Column]:
    # A zero confidence counts as absent.
    conf = F.when(F.col("confidence") != 0, F.col("confidence"))
    return [F.avg(conf).alias("confidence_mean"), std(conf).alias("confidence_std"),
            F.min(conf).alias("confidence_min"), F.max(conf).alias("confidence_max")]


def prediction_summary(predictions: DataFrame) -> DataFrame:
    """Totals, rates and confidence statistics, one row.

    Optional columns: ``error``, ``threshold_alerts`` (count per row), ``quality_score``.
    """
    has = set(predictions.columns)
    ok = F.col("error").isNull() if "error" in has else F.lit(True)
    fire = F.coalesce(F.col("prediction") == 1, F.lit(False)) & ok
    alerts = (F.coalesce(F.sum("threshold_alerts"), F.lit(0)) if "threshold_alerts" in has
              else F.lit(0))
    issues = F.count_if(F.col("quality_score") < 80) if "quality_score" in has else F.lit(0)
    return predictions.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(ok).alias("successful"),
        F.count_if(~ok).alias("failed"), F.count_if(fire).alias("fire"),
        F.count_if(ok & ~fire).alias("no_fire"),
        F.coalesce(F.try_divide(F.count_if(fire), F.count_if(ok)), F.lit(0.0)).alias("fire_rate"),
        F.count_if(fire).alias("ml_alerts"), alerts.alias("threshold_alerts"),
        issues.alias("quality_issues"), *_confidence_stats(F.stddev_pop))


def prediction_counters(predictions: DataFrame) -> DataFrame:
    """Total, fire detections, percentages and means of confidence and time."""
    fire = F.col("prediction") == 1
    out = [F.count(F.lit(1)).alias("total"), F.count_if(fire).alias("fire"),
           F.count_if(~fire).alias("no_fire"),
           F.coalesce(100 * F.try_divide(F.count_if(fire), F.count(F.lit(1))), F.lit(0.0))
           .alias("fire_percent"),
           F.avg("score").alias("mean_fire_confidence")]
    if "processing_ms" in predictions.columns:
        out.append(F.avg("processing_ms").alias("mean_processing_ms"))
    return predictions.agg(*out)


# Fixed values.
LEVELS = ("NONE", "MEDIUM", "HIGH", "CRITICAL")


def monitor_sums(predictions: DataFrame, duration: str, spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    """Per tumbling window, what ``merged_monitor`` adds up over parts of a table or stream."""
    fire = F.col("prediction") == 1
    conf = F.when(F.col("confidence") != 0, F.col("confidence"))
    return predictions.groupBy(F.window(c(spec.event_time), duration)).agg(
        F.count(F.lit(1)).alias("total"), F.count("prediction").alias("judged"),
        F.count_if(fire).alias("fire"), F.count_if(~fire).alias("no_fire"),
        *[F.count_if(F.col("alert_level") == x).alias(f"level_{x.lower()}") for x in LEVELS],
        F.count(conf).alias("confidences"), F.sum(conf).alias("confidence_sum"),
        F.min(conf).alias("confidence_min"), F.max(conf).alias("confidence_max"))


def merged_monitor(sums: DataFrame, minutes: float) -> DataFrame:
    """Totals, rate, level counts and confidence statistics of each window over all its parts."""
    added = ["total", "judged", "fire", "no_fire", *[f"level_{x.lower()}" for x in LEVELS], "confidences", "confidence_sum"]
    merged = sums.groupBy("window").agg(*[F.sum(n).alias(n) for n in added],
                                        F.min("confidence_min").alias("confidence_min"),
                                        F.max("confidence_max").alias("confidence_max"))
    return merged.select(
        "window", "total", (F.col("total") / minutes).alias("per_minute"), "fire", "no_fire",
        F.try_divide("fire", "judged").alias("fire_rate"),
        F.map_from_arrays(F.array(*map(F.lit, LEVELS)), F.array(*[f"level_{x.lower()}" for x in LEVELS]))
        .alias("alert_distribution"),
        F.try_divide("confidence_sum", "confidences").alias("confidence_mean"), "confidence_min", "confidence_max")


def prediction_monitor(predictions: DataFrame, duration: str, minutes: float,
                       spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    """Per tumbling window: totals, rate, level counts, confidence statistics."""
    return merged_monitor(monitor_sums(predictions, duration, spec), minutes)


def window_samples(predictions: DataFrame, duration: str, n: int = 5,
                   spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    """The first ``n`` predictions of each window; ranking stops at ``n`` rows per task."""
    placed = predictions.withColumn("window", F.window(c(spec.event_time), duration))
    order = Window.partitionBy("window").orderBy(c(spec.event_time), c(spec.row_id))
    return placed.withColumn("sample", F.row_number().over(order)).where(F.col("sample") <= n)


def performance_metrics(predictions: DataFrame, *groups: str, seconds: str, failed: str = "failed",
                        most_failed: float = 0.05, spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    """What ``performance_report`` reads, per group (one row without groups), from one pass.

    ``seconds`` is the response time of a prediction, ``failed`` whether it could not be made; a
    group is healthy if less than ``most_failed`` of it failed. Rows without label or prediction
    do not count for the accuracy. The drift indicators are those of ``drift_report``.
    """
    rates = predictions.groupBy(*[c(g) for g in groups]).agg(
        *drift_rates(), F.avg(c(failed).cast("int")).alias("failed_share"),
        (100 * F.avg((c(spec.label) == F.col("prediction")).cast("int"))).alias("accuracy"),
        exact_mean(c(seconds), "decimal(26,12)").alias("response_seconds"))
    return rates.select(*[c(g) for g in groups], (F.col("failed_share") < most_failed).alias("healthy"),
                        "accuracy", "response_seconds", F.size(drift_indicators()).alias("drift_count"))


def exact_mean(value: Column, decimal: str) -> Column:
    """Mean of sums in decimals: its comparison with a limit does not depend on the order of rows.

    NaN, infinities and values that do not fit are missing values.
    """
    return F.avg(finite(value.cast("double")).try_cast(decimal)).cast("double")


def drift_rates() -> list[Column]:
    """Aggregates that ``drift_indicators`` judges."""
    conf = F.col("confidence")
    return [
        F.count(F.lit(1)).alias("total"),
        (100 * F.avg((F.col("prediction") == 1).cast("int"))).alias("fire_rate_percent"),
        exact_mean(conf, "decimal(17,13)").alias("mean_confidence"),
        F.avg((conf > 0.8).cast("int")).alias("high_share"),
        F.avg(conf.between(0.5, 0.8).cast("int")).alias("medium_share"),
        F.avg((conf < 0.5).cast("int")).alias("low_share")]


def drift_indicators() -> Column:
    return texts([
        F.when(F.col("fire_rate_percent") > 15, "high fire rate"),
        F.when(F.col("fire_rate_percent") < 0.5, "very low fire rate"),
        F.when(F.col("mean_confidence") < 0.6, "low mean confidence"),
        F.when(F.col("low_share") > 0.2, "many low-confidence predictions")])


def drift_report(predictions: DataFrame) -> DataFrame:
    """Fire rate, confidence shares and drift indicators, one row."""
    return predictions.agg(*drift_rates()).withColumn("indicators", drift_indicators())


def interval_metrics(log: DataFrame, duration: str, seconds: float,
                     spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    """Per interval: success percentage, throughput, mean time and quality, anomaly totals."""
    ok = ~F.col("failed")
    return log.groupBy(F.window(c(spec.event_time), duration)).agg(
        F.count_if(ok).alias("processed"), F.count_if("failed").alias("failed"),
        ratio(100 * F.count_if(ok), F.count(F.lit(1))).alias("success_rate"),
        (F.count(F.lit(1)) / seconds).alias("throughput"),
        F.coalesce(F.avg(F.when(ok, F.col("processing_ms"))), F.lit(0.0)).alias("mean_ms"),
        F.coalesce(F.avg(F.when(ok, F.col("quality"))), F.lit(1.0)).alias("mean_quality"),
        F.count_if(ok & (F.col("alerts") > 0)).alias("anomalies"),
        F.coalesce(F.sum(F.when(ok, F.col("alerts"))), F.lit(0)).alias("alerts"))


# Upper bucket edges in seconds (fixed values).
TIME_BUCKETS = (0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0)


def time_histogram(log: DataFrame, operation: str, milliseconds: str,
                   edges: Sequence[float] = TIME_BUCKETS) -> DataFrame:
    """Cumulative counts per operation and upper edge (the last edge is infinite)."""
    secs = c(milliseconds) / 1000
    wide = log.groupBy(c(operation)).agg(
        *[F.count_if(secs <= e).alias(f"b_{i}") for i, e in enumerate(edges)],
        F.count(secs).alias("b_all"), F.sum(secs).alias("total_seconds"))
    rows = [F.struct(F.lit(str(e)).alias("le"), F.col(f"b_{i}").alias("count"))
            for i, e in enumerate(edges)]
    rows.append(F.struct(F.lit("+Inf").alias("le"), F.col("b_all").alias("count")))
    return wide.select(c(operation), "total_seconds", F.inline(F.array(*rows)))


def labelled_counts(df: DataFrame, *labels: str) -> DataFrame:
    return df.groupBy(*[c(n) for n in labels]).agg(F.count(F.lit(1)).alias("n"))


def performance_report(metrics: DataFrame) -> DataFrame:
    """Score, recommendations and alerts for a metrics row.

    Columns read: ``healthy``, ``accuracy`` (percent), ``response_seconds``, ``drift_count``.
    """
    acc, rt, drift = F.col("accuracy"), F.col("response_seconds"), F.col("drift_count")
    healthy = F.coalesce(F.col("healthy"), F.lit(False))
    score = F.round(
        F.when(healthy, 25).otherwise(0) + acc * 0.4 + F.greatest(F.lit(0.0), 25 - rt * 10)
        + F.greatest(F.lit(0), 10 - drift * 2), 2)
    scored = metrics.withColumn("performance_score", score)
    s = F.col("performance_score")
    return scored.withColumns({
        "recommendations": texts([
            F.when(s < 70, "performance below threshold"),
            F.when(acc < 80, "consider retraining"),
            F.when(rt > 2, "optimize inference"),
            F.when(drift > 2, "investigate data changes")]),
        "alerts": texts([
            F.when(s < 50, "CRITICAL: performance degraded"),
            F.when(~healthy, "CRITICAL: scoring not available"),
            F.when(acc < 70, "CRITICAL: accuracy below 70%"),
            F.when(rt > 5, "WARNING: response time above 5 s"),
            F.when(drift > 3, "WARNING: several drift indicators")]),
    })
