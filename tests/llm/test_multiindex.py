import numpy as np
from pyspark.sql import functions as F

from sensorlake.llm import multiindex
from sensorlake.llm.multiindex import Book, nearest

SQL = "vec_id long, embedding array<float>, score string, q string"


def brute(rows, k=20):
    good = [(i, np.array(v, np.float64)) for i, v in rows
            if i is not None and v is not None and len(v) == 8 and None not in v
            and np.isfinite(np.array(v, float)).all() and any(v)]
    out = {}
    for i, v in good:
        if i % 20 == 0:
            near = sorted((-float(w @ v), j) for j, w in good if j != i)[:k]
            out.setdefault(i, [j for _, j in near])
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", "x") for i, v in rows], SQL)


def search(spark, rows, **more):
    got = {}
    for r in nearest(frame(spark, rows), F.col("vec_id") % 20 == 0, 20, **more).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return {q: [v for _, v, _ in sorted(x)] for q, x in got.items()}, got


def vectors(n, seed=0, clusters=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 8)).astype(np.float32)
    if clusters:
        x = x * 0.05 + rng.normal(size=(clusters, 8)).astype(np.float32)[rng.integers(0, clusters, n)]
    return [(i, [float(v) for v in row]) for i, row in enumerate(x)]


def test_recall_and_scores(spark):
    rows = vectors(1500, clusters=40)
    got, full = search(spark, rows, recall=0.95)
    true = brute(rows)
    assert got.keys() == true.keys()
    assert np.mean([len(set(got[q]) & set(true[q])) / 20 for q in true]) >= 0.9
    held = {i: np.array(v, np.float32).astype(np.float64) for i, v in rows}
    for q, x in full.items():
        x.sort()
        assert [r for r, _, _ in x] == list(range(1, 21))
        assert all(abs(s - held[v] @ held[q]) < 1e-12 for _, v, s in x)


def test_odd_rows_and_copies(spark):
    """With the whole walk the result is exact, ties and crowded cells included."""
    one, two = [0.5] * 8, [0.25] * 4 + [-0.5] * 4
    rows = vectors(150, 3)
    rows += [(200 + i, one) for i in range(90)] + [(300 + i, two) for i in range(25)]
    rows += [(None, one), (400, None), (420, [0.0] * 8), (440, [float("nan")] * 8), (460, one[:5]),
             (480, [None, *one[1:]]), (500, [float("inf"), *one[1:]]), (520, []), (530, one), (530, one)]
    got, _ = search(spark, rows, recall=1.0)
    assert got == brute(rows)


def test_few_and_none(spark):
    got, _ = search(spark, vectors(5))
    assert got == brute(vectors(5)) and len(got[0]) == 4
    assert search(spark, [])[0] == {}
    assert search(spark, [(7, [1.0] * 8)])[0] == {}
    assert search(spark, [(20, [1.0] * 8)])[0] == {}


def test_slices_and_blocks_change_nothing(spark, monkeypatch):
    rows = vectors(400, 5)
    monkeypatch.setattr(multiindex, "SLICE", 16)
    got, _ = search(spark, rows, recall=1.0)
    assert got == brute(rows)


def test_walk_goes_by_summed_distance():
    rng = np.random.default_rng(1)
    book, q = Book(rng.normal(size=(7, 4)), rng.normal(size=(5, 4))), rng.normal(size=8)
    cells = list(book.walk(q))
    far = [-(book.first[c // 5] @ q[:4] + book.second[c % 5] @ q[4:]) for c in cells]
    assert sorted(cells) == list(range(35)) and np.all(np.diff(far) >= -1e-12)
