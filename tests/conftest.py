import datetime as dt

import pytest

from sensorlake.session import build_session
from sensorlake.spec import READING_SCHEMA

BASE = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)

NORMAL = (21.3, 47.5, 120.0, 430.0, 12950.0, 19200.0, 1009.4, 3.1, 4.6, 900.0, 310.0, 75.0, 12, 0)
FIRE = (57.0, 21.0, 1800.0, 1350.0, 26500.0, 36800.0, 1004.2, 58.0, 88.0, 6100.0, 4200.0, 910.0, 240, 1)
OUTLIER = (180.0, -40.0, -250.0, 9500.0, -2500.0, 800000.0, 1900.0, -4.0, 420.0, -700.0, 90000.0,
           -300.0, -60, 0)


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", 4, spark__ui__enabled="false",
                            spark__driver__memory="6g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_readings(spark):
    """Readings from channel tuples, one per second, with ids from 0."""
    schema = "event_id long, " + ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in READING_SCHEMA.fields)

    def make(rows, devices=("sensor_0",), step=1):
        data = [(i, *row, BASE + dt.timedelta(seconds=i * step), devices[i % len(devices)], "lab")
                for i, row in enumerate(rows)]
        return spark.createDataFrame(data, schema)

    return make
