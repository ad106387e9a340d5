import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorlake.functions.columns import alert_level
from sensorlake.operators import clean, evaluation, patterns, quality, scoring, validate
from sensorlake.plans import features, historical, training
from sensorlake.plans.daily import daily_features
from sensorlake.spec import NUMERIC_CHANNELS, c
from tests.conftest import FIRE, NORMAL, OUTLIER


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(11)
    rows = [(i, int(rng.random() < 0.3), float(np.round(rng.random(), 3))) for i in range(800)]
    return rows, spark.createDataFrame(rows, "id int, y int, score double").withColumn(
        "prediction", (F.col("score") > 0.5).cast("int"))


def test_auc_and_average_precision(scored):
    rows, df = scored
    pos = np.array([s for _, y, s in rows if y]); neg = np.array([s for _, y, s in rows if not y])
    auc = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    ap, recall_before = 0.0, 0.0
    for t in sorted({s for _, _, s in rows}, reverse=True):
        recall, precision = (pos >= t).mean(), (pos >= t).sum() / ((pos >= t).sum() + (neg >= t).sum())
        ap, recall_before = ap + (recall - recall_before) * precision, recall
    row = evaluation.binary_metrics(df, "y").first()
    assert row.auc == pytest.approx(auc) and row.average_precision == pytest.approx(ap)
    # Few buckets put many scores into each; the result stays.
    curve = evaluation.score_curve(df, "y", buckets=3)
    points = {round(r.threshold, 3): r.tpr for r in evaluation.roc_curve(curve).collect()}
    assert points[min(points)] == 1.0
    assert points[0.5 if 0.5 in points else min(points)] == pytest.approx((pos >= (0.5 if 0.5 in points else min(points))).mean())


def test_crowded_scores_are_spread(spark):
    """Nearly all scores below 0.001, some outside 0 to 1 and some that are no numbers."""
    rng = np.random.default_rng(5)
    s = np.concatenate([rng.random(1980) * 0.001, [3.5, -2.0, 0.5] * 6 + [1e9, -1e9]])
    y = (rng.random(len(s)) < 0.3).astype(int)
    df = spark.createDataFrame([(int(b), 0, float(a)) for a, b in zip(s, y)] + [(1, 0, float("nan")), (0, 0, float("inf"))],
                               "y int, prediction int, score double")
    for r in evaluation.score_curve(df, "y", buckets=20).collect():
        assert (r.tp, r.fp) == (int(y[s >= r.threshold].sum()), int((1 - y)[s >= r.threshold].sum()))
        assert (r.positives, r.negatives) == (int(y.sum()), int((1 - y).sum()))


def test_metrics_with_one_class_only(spark):
    df = spark.createDataFrame([(0, 0, 0.2), (0, 0, 0.3)], "y int, prediction int, score double")
    row = evaluation.binary_metrics(df, "y").first()
    assert (row.accuracy, row.precision, row.recall, row.f1, row.auc) == (1.0, 0.0, 0.0, 0.0, None)


def test_class_report(scored):
    rows, df = scored
    report = {r["class"]: r for r in evaluation.class_report(df, "y").collect()}
    for cls in (0, 1):
        hits = sum(1 for _, y, s in rows if y == cls and int(s > 0.5) == cls)
        support = sum(1 for _, y, _ in rows if y == cls)
        predicted = sum(1 for _, _, s in rows if int(s > 0.5) == cls)
        assert report[cls].recall == pytest.approx(hits / support)
        assert report[cls].precision == pytest.approx(hits / predicted)


def test_summary_counts_errors_apart(make_readings):
    df = make_readings([NORMAL, OUTLIER, FIRE, (65.0, *NORMAL[1:])])
    out = scoring.score_or_error(scoring.rule_scores(df), validate.reading_errors())
    row = scoring.prediction_summary(out).first()
    assert (row.total, row.successful, row.failed, row.fire, row.no_fire) == (4, 3, 1, 1, 2)
    assert row.confidence_mean == pytest.approx(0.8)


def test_alert_levels(spark):
    df = spark.createDataFrame([(1, 0.95), (1, 0.9), (1, 0.7), (0, 0.99), (None, None)], "p int, k double")
    got = [r[0] for r in df.select(alert_level(F.col("p"), F.col("k"))).collect()]
    assert got == ["CRITICAL", "HIGH", "MEDIUM", "NONE", "NONE"]


def test_interval_metrics(spark, make_readings):
    log = make_readings([NORMAL] * 105).select(
        "timestamp", (F.col("event_id") < 5).alias("failed"), F.lit(2.0).alias("processing_ms"),
        F.lit(0).alias("alerts"), F.lit(1.0).alias("quality"))
    row = scoring.interval_metrics(log, "1 hour", 3600.0).first()
    assert (row.processed, row.failed) == (100, 5) and row.success_rate == pytest.approx(95.238, abs=0.001)


def test_keyed_scoring_equals_direct(make_readings):
    df = make_readings([NORMAL] * 30 + [(61.0, *NORMAL[1:]), (None, *NORMAL[1:])])
    keyed = scoring.score_by_key(df, ["Temperature[C]", "Humidity[%]"], scoring.rule_scores)
    direct = scoring.rule_scores(df)
    pick = lambda x: sorted(map(tuple, x.select("event_id", "prediction", "score").collect()))
    assert pick(keyed) == pick(direct)


def test_performance_report(spark):
    df = spark.createDataFrame([(True, 95.0, 0.5, 0), (False, 60.0, 6.0, 4)],
                               "healthy boolean, accuracy double, response_seconds double, drift_count int")
    good, bad = scoring.performance_report(df).orderBy(F.col("accuracy").desc()).collect()
    assert good.performance_score == pytest.approx(25 + 38 + 20 + 10) and good.alerts == []
    assert bad.performance_score == pytest.approx(24 + 2) and len(bad.alerts) == 5 and len(bad.recommendations) == 4


def test_performance_metrics(spark):
    rows = ([("a", 1, 1, 0.9, 1.0, False)] * 30 + [("b", 1, 0, 0.4, 6.0, True)] * 10
            + [("b", None, 0, 0.4, None, False)])
    df = spark.createDataFrame(rows, "place string, `Fire Alarm` int, prediction int, confidence double, "
                                     "secs double, failed boolean")
    got = {r.place: r for r in scoring.performance_metrics(df, "place", seconds="secs").collect()}
    assert tuple(got["a"])[1:] == (True, 100.0, 1.0, 1)
    assert tuple(got["b"])[1:] == (False, 0.0, 6.0, 3)
    whole = scoring.performance_metrics(df, seconds="secs").first()
    assert whole.drift_count == len(scoring.drift_report(df).first().indicators)
    assert scoring.performance_metrics(df.limit(0), "place", seconds="secs").collect() == []


def test_type_issues_by_schema(spark):
    df = spark.createDataFrame([(1, 1.5, "x"), (2, float("nan"), "2"), (None, None, None)], "i int, d double, s string")
    got = {r.channel: (r.present, r.not_numeric, r.issue) for r in quality.type_issues(df, ["i", "d", "s"]).collect()}
    assert got == {"i": (2, 0, False), "d": (2, 1, True), "s": (2, 1, True)}


def test_gate_and_best(spark):
    df = spark.createDataFrame([("a", 0.9, 0.8), ("b", 0.9, 0.7), ("c", 0.7, 0.8)], "model string, accuracy double, f1 double")
    assert [r.model for r in evaluation.promote(df).collect()] == ["a"]
    assert evaluation.best_model(df).first().model == "a"


def test_engineered_features(make_readings):
    row = features.add_features(make_readings([NORMAL])).first()
    t, h, tvoc, eco2, h2, eth, p, pm1, pm25 = NORMAL[:9]
    expected = {
        "temp_squared": t**2, "temp_log": np.log1p(t + 50), "humidity_squared": h**2, "humidity_log": np.log1p(h),
        "tvoc_eco2_ratio": tvoc / (eco2 + 1e-5), "pm_ratio": pm1 / (pm25 + 1e-5), "pm_sum": pm1 + pm25,
        "pressure_deviation": abs(p - 1013.25), "temp_humidity_interaction": t * h, "heat_index": t + 0.5 * h,
        "gas_sensor_ratio": h2 / (eth + 1e-5), "gas_sensor_sum": h2 + eth}
    for name, value in expected.items():
        assert row[name] == pytest.approx(value), name
    only = features.add_features(make_readings([NORMAL]).select(c("Temperature[C]")))
    assert only.columns == ["Temperature[C]", "temp_squared", "temp_log"]


def test_rows_have_length_one(make_readings):
    got = daily_features(make_readings([NORMAL, FIRE], step=60)).collect()
    names = [*NUMERIC_CHANNELS, "Temp_Humidity_Product", "PM_sum"]
    for r in got:
        assert sum(r[n] ** 2 for n in names) == pytest.approx(1.0)
    assert {int(r["Fire Alarm"]) for r in got} == {0, 1}


def test_top_indicators_and_insights(spark, make_readings):
    rows = [NORMAL if i % 3 else FIRE for i in range(60)]
    top = patterns.top_indicators(make_readings(rows), NUMERIC_CHANNELS, "Fire Alarm").collect()
    assert len(top) == 5 and "Fire Alarm" not in {r.channel for r in top}
    report = spark.createDataFrame([(13, 0, "TVOC[ppb]", 0.912, 25.0, 90.0, 0.05, 0.8)],
                                   "peak_hour int, peak_weekday int, indicator string, strength double, "
                                   "mean_temperature double, max_temperature double, fire_rate double, accuracy double")
    facts = {r.topic: r for r in patterns.insights(report).collect()}
    assert len(facts) == 7 and facts["peak_hour"].value == 13 and facts["indicator"].subject == "TVOC[ppb]"
    assert {t for t, r in facts.items() if r.attention} == {"max_temperature", "accuracy"}


def test_correlations_of_all_pairs(make_readings):
    rng = np.random.default_rng(2)
    rows = [tuple(float(x) for x in rng.normal(10, 2, 12)) + (int(i), int(i % 2)) for i in range(60)]
    names = [*NUMERIC_CHANNELS, "Fire Alarm"]
    for take in (13, 14):
        got = {(r.x, r.y): r.r for r in patterns.correlations(make_readings(rows), names[:take]).collect()}
        matrix = np.corrcoef(np.array([r[:take] for r in rows]).T)
        assert len(got) == take * (take - 1) // 2
        for (x, y), r in got.items():
            assert r == pytest.approx(matrix[names.index(x), names.index(y)])


def test_history_outputs(spark, make_readings, tmp_path):
    result = historical.score_history(make_readings([NORMAL, OUTLIER, FIRE, (65.0, *NORMAL[1:])]))
    historical.write_history(result, str(tmp_path / "h"))
    summary = spark.read.json(str(tmp_path / "h/summary")).first()
    assert summary.total == 4 and summary.failed == 1
    assert spark.read.json(str(tmp_path / "h/alerts")).where("sensor = 'ML'").count() == 1
    assert spark.read.json(str(tmp_path / "h/quality_issues")).count() == 1


@pytest.fixture(scope="module")
def train_rows(make_readings):
    rng = np.random.default_rng(42)
    rows = []
    for i in range(240):
        base = FIRE if i % 4 == 0 else NORMAL
        noisy = [float(v + rng.normal(0, abs(v) * 0.05 + 0.1)) for v in base[:12]]
        if i % 17 == 0:
            noisy[0] = None
        rows.append((*noisy, base[12], base[13]))
    return make_readings(rows)


def test_training_round_trip(spark, train_rows, tmp_path):
    train, test = training.split(train_rows, "event_id")
    assert train.count() + test.count() == 240 and train.join(test, "event_id").count() == 0
    model = training.fit(train, training.forest(numTrees=5, maxDepth=3), scale=False)
    row = training.evaluate(model, test, "forest").first()
    assert 0.9 <= row.accuracy <= 1.0 and 0.0 <= row.f1 <= 1.0
    training.save_model(model, str(tmp_path / "m"), "forest", spark)
    loaded, about = training.load_model(str(tmp_path / "m"), spark)
    assert about.first().model_name == "forest" and about.first().feature_columns == list(NUMERIC_CHANNELS)
    first = scoring.model_scores(model, test).orderBy("event_id").collect()
    again = scoring.model_scores(loaded, test).orderBy("event_id").collect()
    assert [r.score for r in first] == [r.score for r in again]
    for r in first:
        assert r.prediction in (0, 1) and r.probability.no_fire + r.probability.fire == pytest.approx(1.0)
    top = training.importances(model, spark).collect()
    assert len(top) == 20 and sum(r.importance for r in top) <= 1.0 + 1e-9


def test_grid_search(spark, train_rows):
    linear = training.logistic(maxIter=10)
    found = training.search(train_rows, linear, training.logistic_grid(linear, 240, (1.0,)), folds=2)
    assert training.search_results(found, spark).count() == 2
    assert training.evaluate(found.bestModel, train_rows, "logistic").first().accuracy > 0.9
    assert len(training.forest_grid(training.forest(), full=True)) == 162


def test_split_keeps_every_classs_share(spark):
    rows = [(i, 1 if i % 50 == 0 else 0) for i in range(5000)]
    df = spark.createDataFrame(rows, "event_id long, `Fire Alarm` int")
    train, test = training.split(df, "event_id")
    for label in (0, 1):
        n = df.where(c("Fire Alarm") == label).count()
        assert train.where(c("Fire Alarm") == label).count() == pytest.approx(0.8 * n, abs=2)
    assert train.count() + test.count() == 5000 and train.join(test, "event_id").isEmpty()


def test_text_labels(spark):
    df = spark.createDataFrame([("no",), ("yes",), ("no",)], "y string")
    got = training.label_index("y").fit(df).transform(df).collect()
    assert [r.label for r in got] == [0.0, 1.0, 0.0]


def test_named_cases(make_readings):
    """Accuracy over named cases with their expected prediction."""
    hot = (85.0, *NORMAL[1:])
    cases = make_readings([NORMAL, hot, FIRE]).withColumn("expected", (F.col("event_id") >= 1).cast("int"))
    row = evaluation.binary_metrics(scoring.rule_scores(cases), "expected", score=None).first()
    assert row.accuracy == pytest.approx(2 / 3) and row.precision == 1.0 and row.recall == 0.5


def test_feature_selection(make_readings):
    df = make_readings([(None, *NORMAL[1:])])
    got = features.prepare_features(df, ["PM2.5", "Temperature[C]", "Smoke"], "zero")
    assert got.columns == ["PM2.5", "Temperature[C]", "Smoke"] and tuple(got.first()) == (NORMAL[8], 0.0, 0.0)
    numeric = clean.numeric_columns(df, exclude=["event_id"])
    assert numeric == [*NUMERIC_CHANNELS, "Fire Alarm"]


def test_monitor_on_a_window(make_readings):
    out = scoring.rule_scores(make_readings([NORMAL, (65.0, *NORMAL[1:]), NORMAL]))
    row = scoring.prediction_monitor(out, "1 hour", 60.0).first()
    assert (row.total, row.fire, row.no_fire) == (3, 1, 2) and row.per_minute == pytest.approx(0.05)
    assert row.alert_distribution == {"NONE": 2, "MEDIUM": 0, "HIGH": 1, "CRITICAL": 0}


def test_a_mean_on_its_limit_raises_no_alert_in_any_order(spark):
    """Three numbers of sum 15, added as doubles, can give a little more."""
    above = next((a, b, round(15 - a - b, 2)) for a in (x / 100 for x in range(401, 600)) for b in (4.9, 5.2, 5.37)
                 if a + b + round(15 - a - b, 2) > 15)
    for order in (above, above[::-1]):
        rows = [(0, 0, False, x, 0.6 if i else 0.7) for i, x in enumerate(order)]
        df = spark.createDataFrame(rows, "`Fire Alarm` int, prediction int, failed boolean, seconds double, confidence double").coalesce(1)
        found = scoring.performance_metrics(df, seconds="seconds").first()
        assert found.response_seconds == 5.0
    low = spark.createDataFrame([(0, 0, False, 1.0, x) for x in (0.5, 0.63, 0.7, 0.68, 0.65, 0.53, 0.51)],
                                df.schema).coalesce(1)
    assert scoring.performance_metrics(low, seconds="seconds").first().drift_count == 1   # the fire rate alone


def test_split_never_shuffles_readings_by_class(spark, make_readings):
    """A class would be one task's; tables too large for Spark's size estimate had that."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        train, _ = training.split(make_readings([NORMAL, FIRE] * 20), "event_id")
        plan = train._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
