from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from sensorlake.operators import patterns, profile
from sensorlake.session import scratch_dir
from sensorlake.sources import files, kafka, sinks
from sensorlake.spec import REQUIRED_CHANNELS, c
from tests.conftest import FIRE, NORMAL

HEADER = ",UTC," + ",".join(REQUIRED_CHANNELS)


def line(i, utc, row):
    return f"{i},{utc}," + ",".join("NULL" if v is None else str(v) for v in row)


@pytest.fixture()
def csv_dir(tmp_path):
    for n, rows in (("a", [NORMAL, (None, *NORMAL[1:])]), ("deep/b", [FIRE])):
        path = tmp_path / "in" / f"{n}.csv"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("\n".join([HEADER, *[line(i, 1654733331 + i, r) for i, r in enumerate(rows)]]) + "\n")
    return tmp_path / "in"


def test_read_csv(spark, csv_dir):
    df = files.read_reading_csv(spark, str(csv_dir / "a.csv"), label_as_text=True)
    rows = df.orderBy("UTC").collect()
    assert "_idx" not in df.columns and rows[0]["Fire Alarm"] == "0"
    assert rows[0]["Temperature[C]"] == NORMAL[0] and rows[1]["Temperature[C]"] is None
    assert df.select(F.unix_seconds("timestamp")).first()[0] == 1654733331
    assert files.csv_columns(spark, str(csv_dir / "a.csv")) == ["UTC", *REQUIRED_CHANNELS]


def test_recursive_scan_and_inventory(spark, csv_dir):
    df = files.read_reading_csv(spark, str(csv_dir), recursive=True)
    assert df.count() == 3
    raw = spark.read.option("recursiveFileLookup", "true").text(str(csv_dir))
    inv = files.file_inventory(raw, min_bytes=200)
    assert inv.count() == 2 and {r.available for r in inv.collect()} == {True}
    assert files.file_inventory(raw).where("available").count() == 0
    assert files.newest_file(inv).count() == 1


def test_corrupt_lines_are_kept(spark, tmp_path):
    bad = tmp_path / "bad.csv"
    bad.write_text("\n".join([HEADER, line(0, 1, NORMAL), "1,2,hot" + ",0" * 13]) + "\n")
    df = files.read_reading_csv(spark, str(bad), corrupt="_corrupt").cache()
    assert df.where("_corrupt IS NOT NULL").count() == 1 and df.count() == 2


def test_history_round_trip(spark, make_readings, tmp_path):
    out = str(tmp_path / "history")
    df = make_readings([NORMAL, (None, *NORMAL[1:])]).select("event_id", c("Temperature[C]"), "timestamp")
    sinks.append_history(df, out)
    sinks.append_history(df, out)
    assert "NULL" in "".join(p.read_text() for p in (tmp_path / "history").rglob("*.csv"))
    back = spark.read.options(header=True, nullValue="NULL").csv(out)
    assert back.count() == 4 and back.where("`Temperature[C]` IS NULL").count() == 2


def test_exports(spark, make_readings, tmp_path):
    df = make_readings([NORMAL, FIRE])
    sinks.export_csv(df, str(tmp_path / "c"))
    sinks.export_json(df, str(tmp_path / "j"), ["device_id"])
    sinks.write_report(df.agg(F.count(F.lit(1)).alias("n")), str(tmp_path / "r"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 2
    assert spark.read.json(str(tmp_path / "j")).count() == 2
    assert spark.read.json(str(tmp_path / "r")).first().n == 2


def test_dated_table_prunes(spark, make_readings, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_dated(make_readings([NORMAL] * 6, step=43200), path)      # three days, two rows each
    day = files.read_day(spark, path, "2024-01-03")
    assert day.count() == 2
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ds" in plan
    with pytest.raises(FileNotFoundError):
        files.read_day(spark, path, "2023-01-01")
    assert profile.recent_day(spark.read.parquet(path), "2024-01-02").count() == 2


def test_kafka_options():
    source = kafka.kafka_source_options("h:1", "t", starting="earliest", max_offsets=500)
    assert source["failOnDataLoss"] == "false" and source["startingOffsets"] == "earliest"
    assert source["maxOffsetsPerTrigger"] == "500" and source["subscribe"] == "t"
    assert kafka.kafka_source_options("h:1", "t")["startingOffsets"] == "latest"
    assert kafka.kafka_sink_options("h:1", "o", "/c") == {
        "kafka.bootstrap.servers": "h:1", "topic": "o", "checkpointLocation": "/c"}


def test_messages(make_readings):
    row = kafka.as_messages(make_readings([NORMAL]), "device_id").first()
    assert row.key == "sensor_0" and f'"Temperature[C]":{NORMAL[0]}' in row.value


def test_retention_keeps_newest(spark):
    items = [(f, i, f"2024-01-{i:02d} 00:00:00", 10) for f in ("a", "b") for i in range(1, 10 if f == "a" else 4)]
    df = spark.createDataFrame(items, "family string, item int, modified string, size int").withColumn(
        "modified", F.to_timestamp("modified"))
    plan = patterns.retention_plan(df, "family", "modified", "item", "size", "2024-02-03")
    got = {(r.family, r.item): (r.surplus, r.expired) for r in plan.collect()}
    assert {k for k, v in got.items() if v[0]} == {("a", i) for i in range(1, 5)}
    assert {k for k, v in got.items() if v[1]} == {("a", 1), ("a", 2), ("a", 3), ("b", 1), ("b", 2), ("b", 3)}
    assert patterns.retention_summary(plan, "family", "size").where("family = 'a'").first().freed == 40


def test_scratch_folder_follows_the_session(spark):
    shared = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: "/shared/ckpt/"), sparkContext=None)
    assert scratch_dir(shared, "x").startswith("/shared/ckpt/x-")
    cluster = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: default),
        sparkContext=SimpleNamespace(master="yarn", getConf=lambda: {}))
    with pytest.raises(RuntimeError):
        scratch_dir(cluster, "x")
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")
