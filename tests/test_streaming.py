"""Streams replay finite files and must give what the batch operators give."""

import datetime as dt
import json
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sensorlake.catalog import streams
from sensorlake.catalog.base import tidy
from sensorlake.operators import rolling, windows
from sensorlake.operators.scoring import rule_scores
from sensorlake.sources.kafka import MESSAGE_SCHEMA, file_stream
from sensorlake.sources.readings import project_readings
from sensorlake.spec import READING_SCHEMA, REQUIRED_CHANNELS
from sensorlake.streaming import pipeline
from sensorlake.streaming import progress as progress_module
from sensorlake.streaming.current import alert_transitions, latest, open_alerts
from sensorlake.streaming.monitor import monitor_report, monitor_samples, parse_predictions, start_monitor
from sensorlake.streaming.progress import ProgressLog, progress_table, progress_totals
from sensorlake.streaming import replay as replay_module
from sensorlake.streaming.replay import closable, in_parts, parted_stream, replay
from sensorlake.streaming import stateful
from sensorlake.streaming.stateful import RollingScores, rolling_scores_stream
from tests.conftest import FIRE, NORMAL, OUTLIER


def reading(i, row=NORMAL, at=None, **more):
    body = dict(zip(REQUIRED_CHANNELS, row))
    body.update({"timestamp": f"2024-01-01T{(at or i * 20) // 3600:02d}:{(at or i * 20) // 60 % 60:02d}:"
                              f"{(at or i * 20) % 60:02d}Z", "device_id": f"sensor_{i % 3}", "location": "lab"})
    body.update(more)
    return body


def write_messages(folder, batches, start=0):
    """One file per batch, in order of modification time."""
    os.makedirs(folder, exist_ok=True)
    offset = start
    for n, batch in enumerate(batches):
        path = f"{folder}/part-{start}-{n}.json"
        with open(path, "w") as f:
            for body in batch:
                text = body if isinstance(body, str) else json.dumps(body)
                f.write(json.dumps({"value": text, "topic": "t", "partition": offset % 2, "offset": offset,
                                    "timestamp": "2024-01-01T00:00:00Z"}) + "\n")
                offset += 1
        os.utime(path, (1_700_000_000 + start + n, 1_700_000_000 + start + n))
    return folder


@pytest.fixture()
def config(tmp_path):
    return pipeline.StreamConfig(output_path=str(tmp_path / "out"), checkpoint_path=str(tmp_path / "state"),
                                 available_now=True)


def batches(n=4, size=40):
    return [[reading(b * size + i, FIRE if i % 10 == 0 else (20.0 + i, *NORMAL[1:])) for i in range(size)]
            for b in range(n)]


def test_all_queries_and_restart(spark, tmp_path, config):
    folder = write_messages(str(tmp_path / "in"), batches(2) + [["{broken", reading(500, OUTLIER, at=1600)]])
    config.console = True
    pipeline.drain(pipeline.start_all(file_stream(spark, folder, max_files=1), config))
    archive = spark.read.parquet(f"{config.output_path}/archive")
    assert archive.count() == 80 and archive.where("ds = DATE'2024-01-01'").count() == 80
    letters = spark.read.json(f"{config.output_path}/dead_letters").collect()
    assert len(letters) == 2 and ["Corrupt record"] in [r.errors for r in letters]
    found = spark.read.parquet(f"{config.output_path}/analytics/alerts")
    assert found.where("sensor = 'FIRE_ALARM'").count() > 0

    # A second start continues behind what is done.
    write_messages(folder, [[reading(200 + i) for i in range(5)]], start=1000)
    pipeline.drain(pipeline.start_all(file_stream(spark, folder, max_files=1), config))
    assert spark.read.parquet(f"{config.output_path}/archive").count() == 85


def run_windows(spark, folder, config, mode):
    good, _ = pipeline.parse(file_stream(spark, folder, max_files=1))
    out = pipeline.analytics(good, config)
    pipeline.drain([pipeline.start_analytics(out, config, mode)])
    table = spark.read.parquet(f"{config.output_path}/analytics/windows")
    newest = table.groupBy("window_start").agg(F.max("epoch").alias("epoch"))
    return table.join(newest, ["window_start", "epoch"]).drop(
        "epoch", "quality_score", "quality_issues", "data_completeness", "quality_warning")


@pytest.mark.parametrize("mode", ["update", "complete"])
def test_stream_equals_batch(spark, tmp_path, config, mode):
    folder = write_messages(str(tmp_path / "in"), batches())
    got = run_windows(spark, folder, config, mode)
    good, _ = pipeline.parse(spark.read.schema(MESSAGE_SCHEMA).json(folder))
    expected = windows.window_analytics(good).withColumns(
        {"window_start": F.col("window.start"), "window_end": F.col("window.end")}).drop("window")
    key = lambda df: sorted(map(tuple, tidy(df.select(sorted(expected.columns))).collect()), key=repr)
    assert key(got) == key(expected)
    assert got.count() > 50


def test_append_holds_open_windows_back(spark, tmp_path, config):
    folder = write_messages(str(tmp_path / "in"), batches())
    good, _ = pipeline.parse(file_stream(spark, folder, max_files=1))
    pipeline.drain([pipeline.start_analytics(pipeline.analytics(good, config), config, "append")])
    closed = spark.read.parquet(f"{config.output_path}/analytics/windows")
    last = 159 * 20
    assert 0 < closed.count() and closed.agg(F.max(F.unix_seconds("window_end"))).first()[0] % 86400 <= last - 600


def test_late_rows_are_dropped_and_counted(spark, tmp_path, config):
    late = [[reading(0, at=3600)], [reading(1, at=3700)], [reading(2, at=60)]]
    folder = write_messages(str(tmp_path / "in"), late)
    good, _ = pipeline.parse(file_stream(spark, folder, max_files=1))
    with ProgressLog(spark, str(tmp_path / "progress")) as log:
        query = pipeline.start_analytics(pipeline.analytics(good, config), config)
        pipeline.drain([query])
        log.wait([query])
    progress = progress_table(spark, str(tmp_path / "progress"))
    assert progress.agg(F.sum("late_rows")).first()[0] > 0
    assert progress.agg(F.sum("input_rows")).first()[0] == 3
    rows = spark.read.parquet(f"{config.output_path}/analytics/windows")
    assert rows.agg(F.min(F.unix_seconds("window_start") % 86400)).first()[0] > 3000


def test_repeats_vanish(spark, tmp_path, config):
    folder = write_messages(str(tmp_path / "in"), [[reading(0), reading(1)], [reading(0), reading(2)]])
    good, _ = pipeline.parse(file_stream(spark, folder, max_files=1))
    once = pipeline.deduplicate(good, ["device_id", "timestamp"], "timestamp", "10 minutes")
    pipeline.drain([pipeline.start_archive(once, config, by_device=True)])
    assert spark.read.parquet(f"{config.output_path}/archive").count() == 3


def test_scored_messages(spark, tmp_path, config):
    hot = (65.0, *NORMAL[1:])
    folder = write_messages(str(tmp_path / "in"), [[reading(0), reading(1, hot)]])
    scored = pipeline.scored_messages(file_stream(spark, folder), rule_scores)
    query = (scored.writeStream.format("parquet").option("path", f"{config.output_path}/s")
             .option("checkpointLocation", f"{config.checkpoint_path}/s").trigger(availableNow=True).start())
    pipeline.drain([query])
    rows = {r.message_id: r for r in spark.read.parquet(f"{config.output_path}/s").collect()}
    assert {k: (r.prediction, r.alert_level) for k, r in rows.items()} == {"0_0": (0, "NONE"), "1_1": (1, "HIGH")}
    assert rows["1_1"].sensor_data["Temperature[C]"] == 65.0 and rows["1_1"].stream_metadata.offset == 1


def test_rolling_scores_ignore_arrival_order(spark, make_readings, tmp_path):
    rows = [(20.0 + (i * 7 % 13), *NORMAL[1:]) for i in range(160)]
    rows[120] = (90.0, *NORMAL[1:])
    df = make_readings(rows, devices=("a", "b"), step=10)
    shuffled = df.withColumn("part", F.floor(F.col("event_id") / 40)).orderBy("part", F.xxhash64("event_id"))
    for part in range(4):
        target = tmp_path / "in" / f"p{part}"
        shuffled.where(F.col("part") == part).drop("part").coalesce(1).write.json(str(target))
        for f in target.glob("*.json"):
            os.utime(f, (1_700_000_000 + part, 1_700_000_000 + part))
    schema = "event_id long, " + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in READING_SCHEMA.fields)
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
              .json(f"{tmp_path}/in/*/*.json"))
    out = rolling_scores_stream(stream, "5 minutes", ["Temperature[C]"], size=50)
    (out.writeStream.format("parquet").outputMode("append").option("path", f"{tmp_path}/out")
     .option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start().awaitTermination())
    got = {r.row_id: r for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    expected = {r.event_id: r for r in rolling.rolling_scores(df, ["Temperature[C]"], size=50).collect()}
    assert set(got) == {i for i in expected if i * 10 < 159 * 10 - 300}
    for i, r in got.items():
        assert r.n == expected[i].n and r["mean"] == pytest.approx(expected[i]["mean"])
        assert (r.z is None) == (expected[i].z is None)
        assert r.z is None or r.z == pytest.approx(expected[i].z)


def parted(spark, df, folder, parts):
    return file_stream(spark, in_parts(df, folder, parts), df.schema, "parquet", 1)


def test_a_closed_replay_gives_every_row(spark, make_readings, tmp_path):
    """Also rows within the watermark's delay of the last, rows of one time, and devices without a name."""
    rows = [(20.0 + (i * 7 % 13), *NORMAL[1:]) for i in range(150)]
    df = make_readings(rows, devices=("a", "b", None), step=60)
    df = df.withColumn("timestamp", F.when(F.col("event_id") < 6, F.lit("2024-01-01 00:00:00").cast("timestamp"))
                       .otherwise(F.col("timestamp")))
    stream = closable(parted(spark, df, str(tmp_path / "in"), 5), str(tmp_path / "closing"))
    out = rolling_scores_stream(stream, "1 hour", ["Temperature[C]"], size=20, min_values=5)
    replay(spark, str(tmp_path / "closing"), lambda: (
        out.writeStream.format("parquet").option("path", f"{tmp_path}/out")
        .option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()))
    got = {r.row_id: r for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    expected = {r.event_id: r for r in rolling.rolling_scores(df, ["Temperature[C]"], size=20, min_values=5).collect()}
    assert len(got) == 150 and set(got) == set(expected)
    for i, r in got.items():
        assert (r.n, r["mean"], r.z) == (expected[i].n, pytest.approx(expected[i]["mean"]),
                                         expected[i].z if expected[i].z is None else pytest.approx(expected[i].z))


class Kept:
    """A list state or timer store in memory."""

    def __init__(self, rows=()):
        self.rows = list(rows)

    def exists(self):
        return bool(self.rows)

    def get(self):
        return iter(self.rows)

    def put(self, rows):
        self.rows = list(rows)

    def appendList(self, rows):
        self.rows += rows

    def clear(self):
        self.rows = []


def test_a_backlog_is_scored_in_chunks(monkeypatch):
    """No matrix is larger than a chunk, and chunks change nothing."""
    class Handle(Kept):
        def getListState(self, *_):
            return Kept()

        def listTimers(self):
            return iter(self.rows)

        def registerTimer(self, at):
            self.rows.append(at)

    class Passed:
        def getCurrentWatermarkInMs(self):
            return 4500

    rows = pd.DataFrame({"ts_us": [i * 1000 for i in range(5000)], "row_id": range(5000),
                         "value": [float(i * 37 % 101) for i in range(5000)]})
    found = []
    for chunk in (64, 10**6):
        monkeypatch.setattr(stateful, "CHUNK", chunk)
        processor = RollingScores(100, 30)
        processor.init(Handle())
        assert list(processor.handleInputRows(("a", "b"), iter([rows[:3000], rows[3000:]]), Passed())) == []
        assert processor.handle.rows == [1]
        parts = list(processor.handleExpiredTimer(("a", "b"), Passed(), None))
        assert max(map(len, parts)) <= chunk and processor.handle.rows == [1, 4501]
        assert len(processor.waiting.rows) == 500 and len(processor.tail.rows) == 99
        found.append(pd.concat(parts, ignore_index=True))
    pd.testing.assert_frame_equal(*found)
    assert found[0]["row_id"].tolist() == list(range(4500))


def test_progress_is_kept_over_more_batches_than_spark_remembers(spark, tmp_path):
    for i in range(120):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{i}.json").write_text('{"x": 1}\n' * (i % 3 + 1))
    stream = spark.readStream.schema("x long").option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    with ProgressLog(spark, str(tmp_path / "progress"), every=50) as log:
        query = (stream.writeStream.format("noop").queryName("many").option("checkpointLocation", str(tmp_path / "state"))
                 .trigger(availableNow=True).start())
        query.awaitTermination()
        log.wait([query])
    assert len(query.recentProgress) <= 100
    total = progress_totals(progress_table(spark, str(tmp_path / "progress"))).first()
    assert (total.query, total.batches, total.input_rows, total.late_rows) == ("many", 120, 240, 0)


def test_a_repeated_batch_counts_once(spark, tmp_path):
    at = [dt.datetime(2024, 1, 1, 0, 0, s) for s in range(3)]
    rows = [("q", "r1", "n", 0, at[0], 10, 1.0, 0, 0, 5), ("q", "r1", "n", 1, at[1], 7, 1.0, 0, 0, 5), ("q", "r2", "n", 1, at[2], 8, 1.0, 2, 0, 5)]
    spark.createDataFrame(rows, progress_module.REPORT).write.parquet(str(tmp_path / "p"))
    total = progress_totals(progress_table(spark, str(tmp_path / "p"))).first()
    assert (total.batches, total.input_rows, total.late_rows, total.rows_per_second) == (2, 18, 2, 1800.0)


def test_alerts_as_transitions(spark):
    """An alert is told when it is raised, changes its level or ends, and not while it stays."""
    windows_ = spark.createDataFrame([(w, w + 1, e) for w, epochs in ((0, (0, 1, 2, 3, 5)), (1, (3, 4))) for e in epochs],
                                     "window_start long, window_end long, epoch long")
    rows = [(0, "T", "HIGH", 1), (0, "T", "HIGH", 2), (0, "T", "CRITICAL", 3), (0, "H", "LOW", 0), (1, "T", "HIGH", 4)]
    alerts = spark.createDataFrame([(w, w + 1, s, v, 1.0, 0.5, e) for w, s, v, e in rows],
                                   "window_start long, window_end long, sensor string, severity string, value double, threshold double, epoch long")
    moves = {(r.window_start, r.sensor, r.epoch, r.previous, r.severity) for r in alert_transitions(windows_, alerts).collect()}
    assert moves == {(0, "T", 1, None, "HIGH"), (0, "T", 3, "HIGH", "CRITICAL"), (0, "T", 5, "CRITICAL", None),
                     (0, "H", 0, None, "LOW"), (0, "H", 1, "LOW", None), (1, "T", 4, None, "HIGH")}
    assert [(r.window_start, r.severity) for r in open_alerts(windows_, alerts).collect()] == [(1, "HIGH")]
    assert sorted((r.window_start, r.epoch) for r in latest(windows_).collect()) == [(0, 5), (1, 4)]
    assert alert_transitions(windows_, alerts.limit(0)).collect() == []


def test_prediction_monitor(spark, tmp_path, config):
    """Late, broken and incomplete messages in several micro-batches."""
    def message(i, at, **more):
        return json.dumps({"message_id": f"m{i:02d}", "timestamp": at, "prediction": 1, "confidence": 0.5, "alert_level": "HIGH", **more})

    day = "2024-01-0{}T00:00:0{}Z"
    parts = [[message(5, day.format(2, 5)), message(1, day.format(1, 1), prediction=0, alert_level=None), "{broken", "[1]"],
             [message(3, day.format(1, 3), confidence=0), message(2, day.format(1, 2), confidence=0.9), json.dumps({"prediction": 1})],
             [message(0, day.format(1, 0), confidence="x"), message(6, day.format(2, 6), alert_level="CRITICAL")]]
    folder = write_messages(str(tmp_path / "in"), parts)
    good, bad = parse_predictions(file_stream(spark, folder, max_files=1))
    for _ in range(2):  # a second start adds nothing
        pipeline.drain([start_monitor(good, config, "1 day", 3)])
    rows = {r.window.start.day: r for r in monitor_report(spark, config, 10.0).collect()}
    assert (rows[1].total, rows[1].fire, rows[1].no_fire, rows[1].per_minute) == (4, 3, 1, 0.4)
    assert rows[1].alert_distribution == {"NONE": 1, "MEDIUM": 0, "HIGH": 3, "CRITICAL": 0}
    assert (rows[1].confidence_mean, rows[1].confidence_min, rows[1].confidence_max) == (pytest.approx(0.7), 0.5, 0.9)
    assert (rows[2].total, rows[2].fire_rate, rows[2].alert_distribution["CRITICAL"]) == (2, 1.0, 1)
    first = sorted((r.window.start.day, r["sample"], r.event_id) for r in monitor_samples(spark, config, "1 day", 3).collect())
    assert first == [(1, 1, "m00"), (1, 2, "m01"), (1, 3, "m02"), (2, 1, "m05"), (2, 2, "m06")]
    query = (bad.writeStream.format("memory").queryName("bad_predictions").option("checkpointLocation", str(tmp_path / "bad"))
             .trigger(availableNow=True).start())
    query.awaitTermination()
    assert spark.table("bad_predictions").count() == 3


def test_parts_follow_the_time(spark, make_readings, tmp_path):
    df = make_readings([NORMAL] * 10, step=3600).withColumn("timestamp", F.when(F.col("event_id") != 4, F.col("timestamp")))
    in_parts(df, str(tmp_path / "p"), 3)
    files = sorted((tmp_path / "p").glob("*.parquet"), key=os.path.getmtime)
    ids = [sorted(r.event_id for r in spark.read.parquet(str(f)).collect()) for f in files]
    assert [i for i in ids if i] == [[0, 1, 2, 3], [5, 6], [4, 7, 8, 9]]
    assert sorted(sum(ids, [])) == list(range(10))
    in_parts(df.limit(0), str(tmp_path / "none"), 2)
    assert spark.read.schema(df.schema).parquet(str(tmp_path / "none")).count() == 0


def test_a_large_part_is_written_as_several_files_of_one_batch(spark, make_readings, tmp_path, monkeypatch):
    monkeypatch.setattr(replay_module, "FILE_ROWS", 1000)
    df = make_readings([NORMAL] * 9000, step=60)
    stream = parted_stream(df, str(tmp_path / "p"), 3)
    assert len(list((tmp_path / "p").glob("*.parquet"))) == 9
    batches = []
    query = (stream.writeStream.foreachBatch(lambda batch, epoch: batches.append(sorted(r.event_id for r in batch.collect())))
             .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start())
    query.awaitTermination()
    assert batches == [list(range(at, at + 3000)) for at in (0, 3000, 6000)]
    # A part without rows is one file, and so are all others then.
    gap = df.where("event_id < 3000 OR event_id >= 6000")
    parted_stream(gap, str(tmp_path / "gap"), 3)
    assert len(list((tmp_path / "gap").glob("*.parquet"))) == 3


def test_parts_of_a_stored_table_are_written_once_and_unprojected(spark, tmp_path, monkeypatch):
    """The registered replays part the events themselves; no table of readings is written before."""
    monkeypatch.setattr(replay_module, "written", lambda *_: pytest.fail("written twice"))
    monkeypatch.setattr(streams, "scratch_dir", lambda _, name: f"{tmp_path}/{name}")
    folder = "/root/testdata/sf0.001"
    stream = streams._parted(spark, folder, "p", 3)
    events = spark.read.parquet(f"{folder}/events.parquet")
    assert spark.read.parquet(f"{tmp_path}/p").columns == events.columns
    batches = []
    stream.writeStream.foreachBatch(lambda batch, epoch: batches.append(batch.collect())).option(
        "checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start().awaitTermination()
    assert len(batches) == 3
    assert all(max(r.timestamp for r in a) < min(r.timestamp for r in b) for a, b in zip(batches, batches[1:]))
    key = lambda r: r.event_id
    assert sorted(sum(batches, []), key=key) == sorted(project_readings(events).collect(), key=key)


def test_one_state_scores_all_channels_of_a_device(spark, make_readings, tmp_path):
    """Frames count present values of their channel, also over restarts of the query."""
    rows = [(20.0 + (i * 7 % 13), 40.0 + (i * 5 % 11), *NORMAL[2:]) for i in range(150)]
    df = make_readings(rows, devices=("a", "b"), step=60)
    df = df.withColumn("Temperature[C]", F.when(F.col("event_id") % 3 > 0, F.col("`Temperature[C]`")))
    names = ["Temperature[C]", "Humidity[%]", "PM2.5"]
    out = rolling_scores_stream(closable(parted(spark, df, str(tmp_path / "in"), 5), str(tmp_path / "closing")), "1 hour",
                                names, size=20, min_values=5)
    replay(spark, str(tmp_path / "closing"), lambda: (
        out.writeStream.format("parquet").option("path", f"{tmp_path}/out")
        .option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()))
    key = lambda r: (r.channel, r.row_id if "row_id" in r else r.event_id)
    got = {key(r): r for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    expected = {key(r): r for r in rolling.rolling_scores(df, names, size=20, min_values=5).collect()}
    assert len(got) == 400 and set(got) == set(expected)
    for k, r in got.items():
        assert (r.n, r["mean"], r["std"], r.z) == (
            expected[k].n, pytest.approx(expected[k]["mean"]), pytest.approx(expected[k]["std"]),
            expected[k].z if expected[k].z is None else pytest.approx(expected[k].z))
    states = spark.read.format("statestore").option("stateVarName", "tail").load(f"{tmp_path}/state")
    assert states.select("key").distinct().count() == 2
