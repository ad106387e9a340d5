import numpy as np
import pytest

import corpus_pipeline
from tests.llm.conftest import prose
from tests.llm.test_decontamination import brute as brute_leaks
from tests.llm.test_linededup import brute as brute_lines
from tests.llm.test_nearcopies import brute as brute_groups
from tests.llm.test_simhash import brute as brute_fingerprints

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage of the smallest tables was given and returned."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.written(stage(spark, docs, SF), "test")
        out[name] = (docs, after)
        docs = after
    return out


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_columns_stay(stages):
    for name in list(stages)[:-1]:
        before, after = stages[name]
        assert after.dtypes == before.dtypes and 0 < after.count() <= before.count()


def test_lines(stages):
    before, after = stages["line dedup"]
    want = [(i, t) for i, t, _, _ in brute_lines(pairs(before))]
    assert sorted(pairs(after), key=repr) == want


def test_near_copies(stages):
    before, after = stages["near dedup"]
    assert sorted(i for i, _ in pairs(after)) == sorted(set(brute_groups(pairs(before)).values()))


def test_near_copies_are_linked_by_fingerprints(spark):
    """Repeated shingles count in a fingerprint, but not in a similarity."""
    same = "one two three four five six seven " * 300
    docs = spark.createDataFrame([(i, same + prose(i, 12)) for i in range(4)] + [(9, prose(99, 80))], "doc_id long, text string")
    groups = {i: c for i, _, c in brute_fingerprints(pairs(docs))}
    assert set(groups.values()) == {0, 9} and len(set(brute_groups(pairs(docs)).values())) == 5
    assert sorted(i for i, _ in pairs(corpus_pipeline.drop_near_copies(spark, docs, SF))) == [0, 9]


def test_leaks(stages, spark):
    before, after = stages["decontamination"]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()][:8]
    docs = [(i, t) for i, t in pairs(before) if len(t or "") < 6000]
    found = {d for d, _ in brute_leaks(docs, items)}
    assert not found & {i for i, _ in pairs(after)}
    assert after.count() > 0.8 * before.count()


def test_toxic(stages, spark):
    """The smallest tables have too few toxic labels to learn from, but clean documents must stay; a larger one tells."""
    _, after = stages["toxicity"]
    kept = {i for i, _ in pairs(after)}
    marks = [(r["doc_id"], r["toxic"]) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()]
    assert np.mean([i not in kept for i, t in marks if not t]) < 0.03
    folder = SF.replace("0.001", "0.1")
    larger = corpus_pipeline.drop_toxic(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)
    kept = {r["doc_id"] for r in larger.select("doc_id").collect()}
    marks = [(r["doc_id"], r["toxic"]) for r in spark.read.parquet(f"{folder}/labels.parquet").collect()]
    assert np.mean([i not in kept for i, t in marks if t]) > 0.6
    assert np.mean([i not in kept for i, t in marks if not t]) < 0.02


def test_packing_and_run(stages, spark):
    before, after = stages["packing"]
    assert {r["doc_id"] for r in after.select("doc_id").collect()} == {i for i, _ in pairs(before)}
    order = ["sequence_id", "offset"]
    whole = corpus_pipeline.run(spark, SF)
    assert whole.orderBy(*order).collect() == after.orderBy(*order).collect()


def test_stages_take_odd_tables(odd, nothing, spark, tmp_path):
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, prose(900, 20))], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    for docs in (odd, nothing):
        for name, stage in corpus_pipeline.STAGES:
            after = corpus_pipeline.written(stage(spark, docs, str(tmp_path)), "odd")
            assert name == "packing" or after.columns == docs.columns
            docs = after if name != "packing" else docs
