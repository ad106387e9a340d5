"""Every registered query against its SQL on the smallest tables."""

import glob
import os

import pandas as pd
import pytest

from sensorlake.catalog import ORACLES, QUERIES

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no driver tables")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def rows(df: pd.DataFrame) -> list:
    clean = lambda v: None if v is None or v is pd.NA or v != v else v
    return sorted(([clean(v) for v in r] for r in df[sorted(df.columns)].itertuples(index=False)), key=repr)


def test_names_match():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    got = QUERIES[name](spark, FOLDER).toPandas()
    if name not in ORACLES:
        assert len(got) > 0
        return
    expected = con.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    a, b = rows(got.astype(object)), rows(expected.astype(object))
    assert len(a) == len(b)
    assert a == b
