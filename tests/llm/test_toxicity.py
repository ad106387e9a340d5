import numpy as np
import pytest

from sensorlake.llm.toxicity import (
    Model,
    contrasted,
    fit,
    gram_codes,
    labelled_sample,
    spread_windows,
    stretches,
    toxicity_scores,
    windows,
)
from tests.llm.conftest import CLASHES, prose

BAD = ("blockhead", "nitwit", "dunderhead", "lowlife")


def text(i: int, toxic: bool) -> str:
    words = prose(i, 40 + i % 200).split()
    if toxic:
        for j in range(4 + len(words) // 40):
            words[(7 * i + 13 * j) % len(words)] = BAD[(i + j) % len(BAD)]
    return " ".join(words)


@pytest.fixture(scope="module")
def rows():
    return [(i, text(i, i % 4 == 0), int(i % 4 == 0)) for i in range(400)]


def labels(spark, rows):
    return spark.createDataFrame([(i, 1, y, "x") for i, _, y in rows],
                                 "doc_id long, quality int, toxic int, score string")


def test_held_out_accuracy(make_docs, spark, rows):
    import zlib

    got = {r["doc_id"]: r for r in toxicity_scores(make_docs([r[:2] for r in rows]), labels(spark, rows)).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert np.mean([got[i]["predicted"] == y for i, _, y in held]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())


def test_labels_held_out_are_not_read(make_docs, spark, rows):
    import zlib

    flipped = [(i, t, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, t, y in rows]
    docs = make_docs([r[:2] for r in rows])
    assert labelled_sample(docs, labels(spark, rows)) == labelled_sample(docs, labels(spark, flipped))


def test_sample_is_bounded(make_docs, spark, rows):
    texts, y, share = labelled_sample(make_docs([r[:2] for r in rows]), labels(spark, rows), per_class=10)
    assert len(texts) == 20 and sum(y) == 10 and 0.2 < share < 0.3


def test_odd_rows(odd, nothing, make_docs, spark, rows):
    plenty = make_docs([(1000 + i, t) for i, t, _ in rows], CLASHES).unionByName(odd)
    marks = labels(spark, [(1000 + i, t, y) for i, t, y in rows] + [(5, "", 1), (5, "", 0), (None, "", 1), (9999, "", 1)])
    got = toxicity_scores(plenty, marks)
    assert sorted(got.columns) == sorted({*plenty.columns, "score", "predicted"})
    low = {r["doc_id"]: r["score"] for r in got.where("doc_id IN (1, 2, 9)").collect()}
    assert low[1] == low[2] < 0.5 and got.where("doc_id IS NULL").count() == 2
    assert toxicity_scores(nothing, marks).collect() == []
    none = toxicity_scores(odd, marks.where("toxic = 7")).collect()
    assert len(none) == odd.count() and len({r["score"] for r in none}) == 1


def test_one_class(make_docs, spark):
    got = toxicity_scores(make_docs([(1, "a"), (2, "b"), (3, None)]), labels(spark, [(1, "", 1), (2, "", 1), (3, "", 1)]))
    assert {r["predicted"] for r in got.collect()} == {1}


def test_windows_cover_the_text():
    for n in (0, 1, 26, 40, 41, 66, 67, 1000):
        parts = windows(bytes(range(256)) * 4)[:0] or windows((b"abcdefghij" * 101)[:n])
        covered = b"".join([parts[0], *[p[14:] for p in parts[1:]]])
        assert covered == (b"abcdefghij" * 101)[:n]


def test_model_travels(rows):
    import pickle

    model = fit([t for _, t, _ in rows], [y for _, _, y in rows])
    again = pickle.loads(pickle.dumps(model))
    assert isinstance(again, Model) and again.score(rows[0][1]) == model.score(rows[0][1])


def test_gains_are_differences_of_lengths(rows):
    """Each window compressed on its own with compressors made for it alone."""
    import zstandard

    from sensorlake.llm.toxicity import _compressor

    model = fit([t for _, t, _ in rows], [y for _, _, y in rows])
    for _, t, _ in rows[:12]:
        want = [len(_compressor(model.ordinary).compress(w)) - len(_compressor(model.toxic + model.ordinary).compress(w))
                for w in windows(t.encode().lower())]
        assert model.gains(t).tolist() == want
        whole = zstandard.ZstdCompressionDict(model.ordinary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        back = zstandard.ZstdDecompressor(dict_data=whole).decompress(
            _compressor(model.ordinary).compress(t.encode()), max_output_size=1 << 20)
        assert back == t.encode()


def test_contrasted_runs_equal_a_count_by_hand():
    toxic = [f"{prose(i, 20)} nitwit {prose(i + 500, 20)}".encode() for i in range(40)]
    ordinary = [prose(i + 1000, 40).encode() for i in range(80)]

    def share(texts):
        return {g: sum(g in t for t in texts) for t in texts for g in {t[i:i + 6] for i in range(len(t) - 5)}}

    t, o = share(toxic), share(ordinary)
    want = {g for g, n in t.items() if n >= 3 and (n - 2 * n ** 0.5) / 40 >= 2.5 * (o.get(g, 0) + 1) / 80}
    codes = contrasted(toxic, ordinary)
    assert set(codes.tolist()) == {int(gram_codes(g)[0]) for g in want} and b"nitwit" in want
    assert any(b"nitwit" in s for s in stretches(toxic[0], codes))
    assert stretches(b"", codes) == [] and len(contrasted([], [])) == 0


def test_training_windows_are_spread():
    long = bytes(range(97, 123)) * 1000
    parts = spread_windows(long, 50)
    assert len(parts) == 50 and parts[0] == windows(long)[0] and parts[-1] == windows(long)[-1]


def test_sample_tables(spark):
    """Held-out labels of sf0.1: recall, false alarms and the order of scores."""
    folder = "/root/testdata/sf0.1"
    marks = spark.read.parquet(f"{folder}/labels.parquet")
    scored = toxicity_scores(spark.read.parquet(f"{folder}/documents.parquet"), marks).select("doc_id", "score", "predicted")
    got = scored.join(marks.select("doc_id", "toxic"), "doc_id").where("crc32(cast(cast(doc_id as string) as binary)) % 5 = 0").toPandas()
    bad, good = got[got.toxic == 1], got[got.toxic == 0]
    auc = np.mean([(s > good.score).mean() + (s == good.score).mean() / 2 for s in bad.score])
    assert bad.predicted.mean() > 0.6 and good.predicted.mean() < 0.02 and auc > 0.9
