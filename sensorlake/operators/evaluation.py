"""Evaluation of predictions against labels, from counts that Spark pre-aggregates."""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorlake.functions.columns import finite, ratio
from sensorlake.session import written
from sensorlake.spec import c


def confusion(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Counts per (label, prediction); rows with a missing side are left out."""
    return (df.where(c(label).isNotNull() & c(prediction).isNotNull())
            .groupBy(c(label).cast("int").alias("label"), c(prediction).cast("int").alias("prediction"))
            .agg(F.count(F.lit(1)).alias("n")))


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(c(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))


def binary_metrics(df: DataFrame, label: str, prediction: str = "prediction",
                   score: str | None = "score") -> DataFrame:
    """Accuracy, precision, recall, F1 (0 where undefined), counts and AUC, one row."""
    known = df.where(c(label).isNotNull() & c(prediction).isNotNull())
    y, p = c(label) == 1, c(prediction) == 1
    counts = known.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(y).alias("positives"),
        F.count_if(p).alias("predicted"), F.count_if(y & p).alias("hits"),
        F.count_if(c(label) == c(prediction)).alias("right"))
    precision = ratio(F.col("hits"), F.col("predicted"))
    recall = ratio(F.col("hits"), F.col("positives"))
    out = counts.select(
        ratio(F.col("right"), F.col("total")).alias("accuracy"), precision.alias("precision"),
        recall.alias("recall"),
        ratio(2 * F.col("hits"), F.col("predicted") + F.col("positives")).alias("f1"),
        "total", "positives", "predicted")
    if score is None:
        return out
    return out.crossJoin(F.broadcast(ranking_metrics(known, label, score)))   # one row each


def score_curve(df: DataFrame, label: str, score: str = "score", buckets: int = 1000) -> DataFrame:
    """True and false positives at every distinct score, counted from the highest down.

    Equal scores are one row before anything is ordered. The running totals are built per
    bucket plus the totals of the buckets above. The bucket edges are quantiles of the
    distinct scores, so that no task orders many of them, however crowded a range is.
    Missing, NaN and infinite scores are left out.
    """
    # Written once (three numbers a distinct score): edges, bucket sums and the curve all read it.
    points = written(df.where(c(label).isNotNull()).select(c(label).alias("y"), finite(c(score).cast("double")).alias("threshold"))
              .where("threshold IS NOT NULL").groupBy("threshold")
              .agg(F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") != 1).alias("neg")), "curve-points")
    marks = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    # At most ``buckets`` numbers; a rough edge costs balance, never correctness.
    edges = sorted(set(points.agg(F.percentile_approx("threshold", marks, 10 * buckets)).first()[0] or []))
    placed = (Bucketizer(splits=[-math.inf, *edges, math.inf], inputCol="threshold", outputCol="_b").transform(points)
              if edges else points.withColumn("_b", F.lit(0.0)))
    sums = placed.groupBy("_b").agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    above = Window.orderBy(F.col("_b").desc()).rowsBetween(Window.unboundedPreceding, -1)
    # One row per bucket.
    offsets = sums.select(
        F.col("_b").alias("_bucket"),
        F.coalesce(F.sum("_p").over(above), F.lit(0)).alias("_p0"),
        F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("_n0"),
        F.sum("_p").over(Window.partitionBy(F.lit(1))).alias("positives"),
        F.sum("_n").over(Window.partitionBy(F.lit(1))).alias("negatives"))
    down = (Window.partitionBy("_b").orderBy(F.col("threshold").desc())
            .rowsBetween(Window.unboundedPreceding, 0))
    return (placed.join(offsets, F.col("_b") == F.col("_bucket"))
            .withColumns({"tp": F.sum("pos").over(down) + F.col("_p0"),
                          "fp": F.sum("neg").over(down) + F.col("_n0")})
            .drop("_b", "_bucket", "_p0", "_n0"))


def roc_curve(curve: DataFrame) -> DataFrame:
    return curve.select("threshold", ratio(F.col("fp"), F.col("negatives"), None).alias("fpr"),
                        ratio(F.col("tp"), F.col("positives"), None).alias("tpr"))


def precision_recall_curve(curve: DataFrame) -> DataFrame:
    return curve.select("threshold", (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
                        ratio(F.col("tp"), F.col("positives"), None).alias("recall"))


def ranking_metrics(df: DataFrame, label: str, score: str = "score") -> DataFrame:
    """ROC AUC and average precision, one row; NULL unless both classes occur."""
    curve = score_curve(df, label, score)
    return curve.agg(
        F.try_divide(F.sum(F.col("pos") * (F.col("negatives") - F.col("fp") + F.col("neg") / 2)),
                     F.max(F.col("positives").cast("double") * F.col("negatives"))).alias("auc"),
        F.try_divide(F.sum(F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp"))),
                     F.max("positives").cast("double")).alias("average_precision"))


def class_report(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class."""
    pairs = confusion(df, label, prediction)
    sides = pairs.select(F.inline(F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("support"),
                 F.lit(0).cast("long").alias("predicted"), _hit()),
        F.struct(F.col("prediction").alias("class"), F.lit(0).cast("long").alias("support"),
                 F.col("n").alias("predicted"), F.lit(0).cast("long").alias("hits")))))
    sums = sides.groupBy("class").agg(F.sum("support").alias("support"),
                                      F.sum("predicted").alias("predicted"),
                                      F.sum("hits").alias("hits"))
    return sums.select(
        "class", ratio(F.col("hits"), F.col("predicted")).alias("precision"),
        ratio(F.col("hits"), F.col("support")).alias("recall"),
        ratio(2 * F.col("hits"), F.col("predicted") + F.col("support")).alias("f1"),
        "support", "hits")


def _hit() -> Column:
    return F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("hits")


def averaged_metrics(report: DataFrame) -> DataFrame:
    """Accuracy and weighted and macro averages of a class report, one row."""
    total = F.sum("support")
    weighted = lambda n: ratio(F.sum(F.col(n) * F.col("support")), total)
    return report.agg(
        ratio(F.sum("hits"), total).alias("accuracy"),
        *[weighted(n).alias(f"{n}_weighted") for n in ("precision", "recall", "f1")],
        *[F.avg(n).alias(f"{n}_macro") for n in ("precision", "recall", "f1")],
        total.alias("support"))


def promote(metrics: DataFrame, min_accuracy: float = 0.80, min_f1: float = 0.75) -> DataFrame:
    """Metrics rows good enough for use."""
    return metrics.where((F.col("accuracy") >= min_accuracy) & (F.col("f1") >= min_f1))


def best_model(results: DataFrame, name: str = "model", score: str = "f1") -> DataFrame:
    """Model with the highest score; the first name wins a tie."""
    top = results.orderBy(c(score).desc(), c(name)).limit(1)
    return top
