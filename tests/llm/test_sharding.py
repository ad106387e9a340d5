import zlib

import pytest
from pyspark.sql import functions as F

from sensorlake.llm.histogram import splitters
from sensorlake.llm.sharding import histogram_shards


def check(rows, n_shards):
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(0 <= s < n_shards for s in slots)
    for own in slots.values():
        assert sorted(own) == list(range(len(own)))


def test_equal_bytes_and_gapless_slots(make_docs):
    docs = make_docs([(i, "x" * (37 * i % 900)) for i in range(3000)])
    rows = histogram_shards(docs, 8, slice_bytes=20_000).collect()
    assert len(rows) == 3000
    check(rows, 8)
    total = {}
    for r in rows:
        total[r["shard"]] = total.get(r["shard"], 0) + r["size"]
    assert max(total.values()) - min(total.values()) < 2 * 900
    assert all(r["size"] == len(r["text"]) + 1 for r in rows)


def test_identical_rows_are_spread(make_docs):
    rows = histogram_shards(make_docs([(1, "same text")] * 4000), 8, slice_bytes=2000).collect()
    check(rows, 8)
    sizes = [sum(r["shard"] == s for r in rows) for s in range(8)]
    assert max(sizes) < 1.2 * min(sizes)


def test_odd_rows(odd):
    rows = histogram_shards(odd, 3).collect()
    assert len(rows) == odd.count()
    check(rows, 3)
    assert sorted(r["size"] for r in rows if r["text"] is None) == [1, 1]
    assert sorted(rows[0].asDict()) == sorted(odd.columns)  # size, shard and slot replaced
    assert {r["_key"] for r in rows} == {"x"}


def test_empty_and_single(nothing, make_docs):
    assert histogram_shards(nothing, 8).collect() == []
    assert [(r["slot"], r["size"]) for r in histogram_shards(make_docs([(1, "é")]), 8).collect()] == [(0, 3)]
    with pytest.raises(ValueError):
        histogram_shards(nothing, 0)


def test_sorted_by_a_given_key(make_docs):
    docs = make_docs([(i, "t" * 10) for i in range(1000)])
    rows = histogram_shards(docs, 4, key=F.col("doc_id").cast("double")).collect()
    rows.sort(key=lambda r: (r["shard"], r["slot"]))
    assert [r["doc_id"] for r in rows] == list(range(1000))


def test_splitters_are_exact(spark):
    points = spark.range(5000).select((F.col("id") * F.col("id") % 9973).cast("double").alias("key"),
                                      (F.col("id") % 7).alias("weight"))
    found, total, n = splitters(points, 10, 0.01)
    held = [(r["key"], r["weight"]) for r in points.collect()]
    assert (total, n) == (sum(w for _, w in held), 5000)
    for i, s in enumerate(found, start=1):
        assert s.weight == sum(w for k, w in held if k < s.key)
        assert s.rows == sum(k < s.key for k, _ in held)
        assert abs(s.weight - total * i // 10) <= max(0.01 * total / 10, 7)


def test_query_digest(spark):
    from sensorlake.llm.catalog import QUERIES

    rows = QUERIES["op4_shards"](spark, "/root/testdata/sf0.001").collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert len(rows) == len(texts)
    check(rows, 8)
    assert all(r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode()) for r in rows)


def test_no_python(make_docs):
    rows = make_docs([(i, f"text {i}") for i in range(50)]).where(F.col("doc_id") > 0)
    plan = histogram_shards(rows, 3)._jdf.queryExecution().toString()
    assert "Arrow" not in plan and "Python" not in plan
