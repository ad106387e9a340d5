"""Training and scoring pipelines: one fitted object holds imputing, features, scaling and model."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import Imputer, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sensorlake.operators import evaluation, penalised, scoring
from sensorlake.session import written
from sensorlake.spec import (ALARM, ECO2, ETHANOL, H2, HUMIDITY, NUMERIC_CHANNELS, PM1, PM25, PRESSURE,
                             TEMPERATURE, TVOC, c)

# Engineered features over imputed columns; the keys match ``plans.features.engineered``.
_ENGINEERED = {
    "temp_squared": ("{t} * {t}", (TEMPERATURE,)),
    "temp_log": ("log1p({t} + 50)", (TEMPERATURE,)),
    "humidity_squared": ("{h} * {h}", (HUMIDITY,)),
    "humidity_log": ("log1p({h})", (HUMIDITY,)),
    "tvoc_eco2_ratio": ("try_divide({tvoc}, {eco2} + 1e-5)", (TVOC, ECO2)),
    "pm_ratio": ("try_divide({pm1}, {pm25} + 1e-5)", (PM1, PM25)),
    "pm_sum": ("{pm1} + {pm25}", (PM1, PM25)),
    "pressure_deviation": ("abs({p} - 1013.25)", (PRESSURE,)),
    "temp_humidity_interaction": ("{t} * {h}", (TEMPERATURE, HUMIDITY)),
    "heat_index": ("{t} + 0.5 * {h}", (TEMPERATURE, HUMIDITY)),
    "gas_sensor_ratio": ("try_divide({h2}, {eth} + 1e-5)", (H2, ETHANOL)),
    "gas_sensor_sum": ("{h2} + {eth}", (H2, ETHANOL)),
}
_SHORT = {TEMPERATURE: "t", HUMIDITY: "h", TVOC: "tvoc", ECO2: "eco2", PM1: "pm1", PM25: "pm25",
          PRESSURE: "p", H2: "h2", ETHANOL: "eth"}


def feature_names(channels: Sequence[str] = NUMERIC_CHANNELS) -> list[str]:
    """Names of the assembled vector's entries, in order."""
    return [*channels, *[n for n, (_, needs) in _ENGINEERED.items() if set(needs) <= set(channels)]]


def feature_stages(channels: Sequence[str] = NUMERIC_CHANNELS, strategy: str = "median",
                   scale: bool = True) -> list:
    """Stages from channel columns to the vector column ``features``."""
    raw = {n: f"_c{i}" for i, n in enumerate(channels)}       # ML columns must not hold dots
    filled = {n: f"_f{i}" for i, n in enumerate(channels)}
    pick = ", ".join(f"CAST(`{n}` AS double) AS {a}" for n, a in raw.items())
    names = {s: filled[n] for n, s in _SHORT.items() if n in filled}
    made = {n: e.format(**names) for n, (e, needs) in _ENGINEERED.items() if set(needs) <= set(channels)}
    extra = "".join(f", coalesce({e}, 0.0D) AS _e_{n}" for n, e in made.items())
    vector = [*filled.values(), *[f"_e_{n}" for n in made]]
    stages = [
        SQLTransformer(statement=f"SELECT *, {pick} FROM __THIS__"),
        Imputer(inputCols=list(raw.values()), outputCols=list(filled.values()), strategy=strategy),
        SQLTransformer(statement=f"SELECT *{extra} FROM __THIS__"),
        VectorAssembler(inputCols=vector, outputCol="_vector" if scale else "features"),
    ]
    if scale:
        stages.append(StandardScaler(inputCol="_vector", outputCol="features", withMean=True, withStd=True))
    return stages


SPLIT_BUCKETS = 4096


def _bucket(row_id: str, seed: int) -> Column:
    """One of ``SPLIT_BUCKETS`` by the MD5 of the id: the same row always falls in the same one."""
    digest = F.md5(F.concat_ws("-", c(row_id).cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 3), 16, 10).cast("int")


def _sides(df: DataFrame, row_id: str, label: str, seed: int, train_percent: int) -> DataFrame:
    """``df`` with ``_train``. Each class gives its lowest buckets until it has its share."""
    counts = df.groupBy(c(label).alias("_class"), _bucket(row_id, seed).alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    # At most SPLIT_BUCKETS rows a class, however many rows it has.
    upto = Window.partitionBy("_class").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("_class")
    cuts = (counts.withColumns({"_upto": F.sum("_n").over(upto), "_all": F.sum("_n").over(whole)})
            .where(F.col("_upto") * 100 <= F.col("_all") * train_percent)
            .groupBy("_class").agg(F.max("_b").alias("_cut")))
    placed = df.withColumn("_b", _bucket(row_id, seed))
    # One row a class. A shuffle by class would put all rows of a class into one task.
    return (placed.join(F.broadcast(cuts), c(label).eqNullSafe(F.col("_class")), "left")
            .withColumn("_train", F.coalesce(F.col("_b") <= F.col("_cut"), F.lit(False)))
            .drop("_b", "_class", "_cut"))


def split(df: DataFrame, row_id: str, label: str = ALARM, seed: int = 42,
          train_percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """Train and test rows with the same share of every class, by a hash of the id."""
    sides = _sides(df, row_id, label, seed, train_percent)
    return sides.where("_train").drop("_train"), sides.where("NOT _train").drop("_train")


def split_shares(df: DataFrame, row_id: str, label: str = ALARM, seed: int = 42) -> DataFrame:
    """Rows and training rows per class."""
    return _sides(df, row_id, label, seed, 80).groupBy(c(label).alias("label")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("_train").alias("train"))


def label_index(column: str, output: str = "label") -> StringIndexer:
    """Alphabetical index of a text label."""
    return StringIndexer(inputCol=column, outputCol=output, stringOrderType="alphabetAsc")


def forest(**params) -> RandomForestClassifier:
    return RandomForestClassifier(featuresCol="features", labelCol="_label", seed=42, **params)


def logistic(**params) -> LogisticRegression:
    return LogisticRegression(featuresCol="features", labelCol="_label", **{"maxIter": 1000, **params})


def forest_grid(estimator: RandomForestClassifier, full: bool = True) -> list:
    """The wide grid of 162 points (its values are fixed), or without ``full`` a quick one of four."""
    grid = ParamGridBuilder()
    if not full:
        return (grid.addGrid(estimator.numTrees, [20, 50]).addGrid(estimator.maxDepth, [5, 10]).build())
    return (grid.addGrid(estimator.numTrees, [100, 200, 300]).addGrid(estimator.maxDepth, [10, 20, 30])
            .addGrid(estimator.minInstancesPerNode, [1, 2, 4]).addGrid(estimator.minInfoGain, [0.0, 0.001, 0.01])
            .addGrid(estimator.featureSubsetStrategy, ["sqrt", "log2"]).build())


def logistic_grid(estimator: LogisticRegression, rows: int,
                  strengths: Sequence[float] = (0.1, 1.0, 10.0, 100.0)) -> list:
    """L1 and L2 penalties; strength C over n rows is ``regParam = 1 / (C * n)``."""
    return (ParamGridBuilder().addGrid(estimator.elasticNetParam, [1.0, 0.0])
            .addGrid(estimator.regParam, [1.0 / (s * max(rows, 1)) for s in strengths]).build())


def _with_label(df: DataFrame, label: str) -> DataFrame:
    return df.where(c(label).isNotNull()).withColumn("_label", c(label).cast("double"))


def fit(df: DataFrame, estimator, label: str = ALARM,
        channels: Sequence[str] = NUMERIC_CHANNELS, scale: bool = True) -> PipelineModel:
    return Pipeline(stages=[*feature_stages(channels, scale=scale), estimator]).fit(_with_label(df, label))


@dataclass
class SearchResult:
    """The pipeline refitted at the best point, and every point's mean score."""

    bestModel: PipelineModel
    points: list
    scores: list[float]


def search(df: DataFrame, estimator, grid: list, label: str = ALARM, *, folds: int = 5,
           row_id: str = "event_id", channels: Sequence[str] = NUMERIC_CHANNELS,
           scale: bool = True) -> SearchResult:
    """Cross-validated grid search by F1 of the positive class.

    Imputing and scaling are fitted on each fold's training rows only, once for all points
    of the grid. Ties go to the earlier point. A logistic estimator's points are fitted together.
    """
    # Every fold's stages and the last fit read it, which would compute the split each time.
    labelled = written(_with_label(df.select(c(row_id), c(label), *[c(n) for n in channels if n not in (row_id, label)]), label), "labelled")
    fold = _bucket(row_id, 7) % folds
    judge = MulticlassClassificationEvaluator(labelCol="_label", metricName="fMeasureByLabel", metricLabel=1.0)
    together = penalised.applies(estimator, grid) and labelled.where("_label NOT IN (0, 1)").isEmpty()
    stages = Pipeline(stages=feature_stages(channels, scale=scale))
    totals = [0.0] * len(grid)
    for k in range(folds):
        train, test = labelled.where(fold != k), labelled.where(fold == k)
        prepared = stages.fit(train)
        if together:
            known = _numbers(prepared.transform(train)).persist()
            points = penalised.fit_points(known, estimator, grid)
            for i, score in enumerate(penalised.f1_scores(_numbers(prepared.transform(test)), points)):
                totals[i] += score
            known.unpersist()
            continue
        known = prepared.transform(train).select("features", "_label").persist()
        unseen = prepared.transform(test).select("features", "_label").persist()
        for i, model in estimator.fitMultiple(known, grid):
            totals[i] += judge.evaluate(model.transform(unseen))
        known.unpersist()
        unseen.unpersist()
    scores = [t / folds for t in totals]
    best = estimator.copy(grid[max(range(len(grid)), key=scores.__getitem__)])
    if not together:
        return SearchResult(fit(labelled, best, label, channels, scale), grid, scores)
    prepared = stages.fit(labelled)
    known = _numbers(prepared.transform(labelled)).persist()
    last = penalised.model_of(df.sparkSession, best, penalised.fit_points(known, best, [{}])[0])
    known.unpersist()
    return SearchResult(PipelineModel([*prepared.stages, last]), grid, scores)


def _numbers(df: DataFrame) -> DataFrame:
    return df.select(vector_to_array("features").alias("x"), F.col("_label").alias("y"))


def search_results(found: SearchResult, spark: SparkSession) -> DataFrame:
    """One row per grid point with its mean score (the grid is a driver-side list already)."""
    rows = [(", ".join(f"{p.name}={v}" for p, v in sorted(point.items(), key=lambda kv: kv[0].name)),
             float(score)) for point, score in zip(found.points, found.scores)]
    return spark.createDataFrame(rows, "params string, f1 double")


def evaluate(model: PipelineModel, df: DataFrame, name: str, label: str = ALARM) -> DataFrame:
    """Metrics row of a fitted pipeline on held-out readings."""
    scored = written(scoring.model_scores(model, df).select(c(label), "prediction", "score"), "scored")
    weighted = evaluation.averaged_metrics(evaluation.class_report(scored, label))
    ranking = evaluation.ranking_metrics(scored, label)
    row = weighted.crossJoin(F.broadcast(ranking))   # one row each
    return row.select(F.lit(name).alias("model"), "accuracy", F.col("precision_weighted").alias("precision"),
                      F.col("recall_weighted").alias("recall"), F.col("f1_weighted").alias("f1"),
                      "auc", "average_precision", "support")


def importances(model: PipelineModel, spark: SparkSession,
                channels: Sequence[str] = NUMERIC_CHANNELS, k: int = 20) -> DataFrame:
    """The ``k`` most important features of a forest, or largest coefficients of a linear model."""
    last = model.stages[-1]
    weights = (last.featureImportances if hasattr(last, "featureImportances") else last.coefficients).toArray()
    rows = [(n, float(abs(w))) for n, w in zip(feature_names(channels), weights)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.col("importance").desc(), "feature").limit(k)


def save_model(model: PipelineModel, path: str, name: str, spark: SparkSession, *,
               label: str = ALARM, channels: Sequence[str] = NUMERIC_CHANNELS) -> None:
    """Pipeline and a description row next to it."""
    model.write().overwrite().save(f"{path}/pipeline")
    about = [(name, list(channels), label, datetime.now(timezone.utc).isoformat())]
    spark.createDataFrame(
        about, "model_name string, feature_columns array<string>, target_column string, trained_at string",
    ).coalesce(1).write.mode("overwrite").json(f"{path}/about")


def load_model(path: str, spark: SparkSession) -> tuple[PipelineModel, DataFrame]:
    return PipelineModel.load(f"{path}/pipeline"), spark.read.json(f"{path}/about")
