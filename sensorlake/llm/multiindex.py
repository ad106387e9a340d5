"""Inverted multi-index: nearest vectors by inner product.

Each vector is cut in two halves, which are quantised separately; a pair of centroids is a
cell. A query walks the cells by the sum of its distances to the two centroids, with a
heap, until it has met enough vectors, and those are ranked by their exact products. How
many are enough is measured: a few queries are compared with all vectors.

Equal vectors are merged first, so that copies cost nothing and a cell's vectors differ.
Cells are cut into slices and their queries into blocks, so that no task holds more than
``SLICE`` of each, however full a cell is.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorlake.llm.common import written

SLICE = 4096
DOUBLE = np.dtype("<f8")


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of doubles from a binary column."""
    parts = column.to_pylist()
    return np.frombuffer(b"".join(parts), DOUBLE).reshape(len(parts), -1) if parts else np.zeros((0, 0))


def usable(vectors: DataFrame, dims: int | None = None) -> DataFrame:
    """(vec_id long, vec binary of doubles, h1, h2) of the vectors that take part.

    Left out: null ids; vectors that are null, zero, of another length than ``dims``
    (default: the commonest length), or hold a null or non-finite component.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                          F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.where("vec_id IS NOT NULL AND size(embedding) > 0")
    if dims is None:
        common = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
        dims = common["d"] if common else 1
    schema = pa.schema([("vec_id", pa.int64()), ("vec", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("embedding")
            flat = np.asarray(values.flatten().to_numpy(zero_copy_only=False), DOUBLE).reshape(-1, dims)
            good = np.isfinite(flat).all(axis=1) & (flat != 0).any(axis=1)
            ids = batch.column("vec_id").to_numpy()[good]
            yield pa.record_batch([pa.array(ids), pa.array([r.tobytes() for r in flat[good]], pa.binary())],
                                  schema=schema)

    packed = rows.where(F.size("embedding") == dims).mapInArrow(run, "vec_id long, vec binary")
    return packed.withColumns({"h1": F.xxhash64("vec"), "h2": F.xxhash64(F.lit(1), "vec")})


def _kmeans(x: np.ndarray, k: int, steps: int = 12) -> np.ndarray:
    rng = np.random.default_rng(5)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(steps):
        own = _nearest(x, centres)
        n = np.bincount(own, minlength=len(centres))
        sums = np.stack([np.bincount(own, x[:, d], len(centres)) for d in range(x.shape[1])], axis=1)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres ** 2).sum(axis=1)[None] - 2 * x @ centres.T).argmin(axis=1)


class Book:
    """The centroids of both halves."""

    def __init__(self, first: np.ndarray, second: np.ndarray):
        self.first, self.second = first, second
        self.half = first.shape[1]
        self.cells = len(first) * len(second)

    def cell(self, x: np.ndarray) -> np.ndarray:
        return (_nearest(x[:, :self.half], self.first) * len(self.second)
                + _nearest(x[:, self.half:], self.second))

    def walk(self, q: np.ndarray) -> Iterator[int]:
        """Cells by summed distance; a half's distance is its negative inner product."""
        a, b = -self.first @ q[:self.half], -self.second @ q[self.half:]
        i, j = a.argsort(kind="stable"), b.argsort(kind="stable")
        a, b = a[i], b[j]
        heap, seen = [(a[0] + b[0], 0, 0)], {(0, 0)}
        while heap:
            _, s, t = heapq.heappop(heap)
            yield int(i[s] * len(j) + j[t])
            for u, v in ((s + 1, t), (s, t + 1)):
                if u < len(i) and v < len(j) and (u, v) not in seen:
                    seen.add((u, v))
                    heapq.heappush(heap, (a[u] + b[v], u, v))

    def probes(self, q: np.ndarray, counts: np.ndarray, enough: int) -> list[int]:
        """The first cells of the walk that hold ``enough`` vectors together."""
        out, met = [], 0
        for cell in self.walk(q):
            if counts[cell]:
                out.append(cell)
                met += counts[cell]
                if met >= enough:
                    break
        return out


def _spread(number: int, parts: int) -> int:
    return (number * 0x9E3779B97F4A7C15 % (1 << 64) >> 33) % int(parts)


def _top(scores: np.ndarray, ids: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each row the places of its ``k`` best, ties to smaller ids."""
    for r, row in enumerate(scores):
        if len(row) > k:
            least = np.partition(row, len(row) - k)[len(row) - k]
            some = np.flatnonzero(row >= least)
        else:
            some = np.arange(len(row))
        yield r, some[np.lexsort((ids[some], -row[some]))[:k]]


FOUND = pa.schema([("q", pa.int64()), ("rep", pa.int64()), ("score", pa.float64()), ("cell", pa.int32())])
FOUND_SQL = "q long, rep long, score double, cell int"


def _ranked(q: np.ndarray, qs: np.ndarray, ids: np.ndarray, xs: np.ndarray, cells: np.ndarray,
            k: int) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(q), 256):
        scores = qs[at:at + 256] @ xs.T
        rows = list(_top(scores, ids, k))
        place = np.concatenate([p for _, p in rows])
        owner = np.repeat([r for r, _ in rows], [len(p) for _, p in rows])
        yield pa.record_batch([pa.array(q[at + owner]), pa.array(ids[place]),
                               pa.array(scores[owner, place]), pa.array(cells[place].astype(np.int32))],
                              schema=FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("q").orderBy(F.desc("score"), "rep")
    return found.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k).drop("nth")


def _depth(index: DataFrame, asked: DataFrame, book: Book, counts: np.ndarray, k: int, n_queries: int,
           recall: float) -> int:
    """How many vectors a query has to meet for ``recall``, by brute force over ``n_queries`` queries."""
    some = asked.orderBy(F.xxhash64("q"), "q").limit(n_queries).select("q", "vec").collect()
    q = np.array([r["q"] for r in some], np.int64)
    qs = np.frombuffer(b"".join(bytes(r["vec"]) for r in some), DOUBLE).reshape(len(q), -1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _ranked(q, qs, batch.column("rep").to_numpy(), _matrix(batch.column("vec")),
                               batch.column("cell").to_numpy(), k)

    true = _best(index.select("rep", "vec", "cell").mapInArrow(run, FOUND_SQL), k).select("q", "cell").collect()
    met = {}
    for i, x in zip(q, qs):
        cells = [c for c in book.walk(x) if counts[c]]
        met[int(i)] = dict(zip(cells, np.cumsum(counts[cells])))
    needed = np.sort([met[r["q"]][r["cell"]] for r in true])
    return int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))])


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, *, recall: float = 0.97,
            sample_rows: int = 20_000, sample_queries: int = 128) -> DataFrame:
    """(query_id, rank, vec_id, score): each query row's ``k`` nearest other rows.

    The centroids are fitted on ``sample_rows`` distinct vectors (those smallest by hash)
    and the depth of the walk on ``sample_queries`` queries; every vector is indexed. The
    number of centroids grows with the fourth root of the vectors. Ties go to the smaller
    ``vec_id``; rows that repeat a ``vec_id`` are candidates of their own, but not for a
    query of the same id. See ``usable`` for rows that take no part. Other columns are
    ignored; an empty table, or one without queries, gives an empty result.
    """
    spark = vectors.sparkSession
    rows = written(usable(vectors), "vectors")
    # Of equal vectors the k + 1 smallest ids: more of them can't be in any result.
    copies = Window.partitionBy("h1", "h2").orderBy("vec_id")
    few = rows.withColumn("nth", F.row_number().over(copies)).where(F.col("nth") <= k + 1)
    distinct = written(few.groupBy("h1", "h2").agg(
        F.min("vec_id").alias("rep"), F.first("vec").alias("vec"),
        F.sort_array(F.collect_list("vec_id")).alias("ids")), "distinct-vectors")
    queries = rows.where(is_query)
    asked = written(queries.groupBy("h1", "h2").agg(F.min("vec_id").alias("q"), F.first("vec").alias("vec")),
                    "query-vectors")
    n = distinct.count()
    if not n or asked.isEmpty():
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = distinct.orderBy("h1", "h2").limit(sample_rows).select("vec").collect()
    x = np.frombuffer(b"".join(bytes(r["vec"]) for r in sample), DOUBLE).reshape(len(sample), -1)
    centroids, half = int(min(256, max(4, round(n ** 0.25)))), max(1, x.shape[1] // 2)
    book = Book(_kmeans(x[:, :half], centroids), _kmeans(x[:, half:], centroids))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = book.cell(_matrix(batch.column("vec"))) if batch.num_rows else np.zeros(0)
            yield pa.record_batch([batch.column("rep"), batch.column("vec"), pa.array(cells.astype(np.int32))],
                                  names=["rep", "vec", "cell"])

    index = written(distinct.select("rep", "vec").mapInArrow(assign, "rep long, vec binary, cell int"), "index")
    # One number for each cell, at most 256 * 256.
    counts = _by_cell(index.groupBy("cell").agg(F.count(F.lit(1)).alias("n")), book.cells)
    enough = max(4 * (k + 1), _depth(index, asked, book, counts, k, sample_queries, recall))

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(book.cells, np.int64)
        for batch in batches:
            for q in _matrix(batch.column("vec")):
                total[book.probes(q, counts, enough)] += 1
        cells = np.flatnonzero(total)
        yield pa.record_batch([pa.array(cells.astype(np.int32)), pa.array(total[cells])], names=["cell", "n"])

    asked_by_cell = _by_cell(asked.select("vec").mapInArrow(met, "cell int, n long")
                             .groupBy("cell").agg(F.sum("n").alias("n")), book.cells)
    slices, blocks = -(-counts // SLICE), -(-asked_by_cell // SLICE)
    fields = [("id", pa.int64()), ("vec", pa.binary()), ("cell", pa.int32()), ("slice", pa.int32()),
              ("block", pa.int32())]

    def dealt(ids: pa.Array, vecs: pa.Array, rows: list[tuple]) -> pa.RecordBatch:
        at = pa.array([r[0] for r in rows], pa.int64())
        numbers = [pa.array([r[c] for r in rows], pa.int32()) for c in (1, 2, 3)]
        return pa.record_batch([ids.take(at), vecs.take(at), *numbers], schema=pa.schema(fields))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 64) for i in range(0, batch.num_rows, 64)):
                rows = [(r, c, s, _spread(part.column("q")[r].as_py(), blocks[c]))
                        for r, q in enumerate(_matrix(part.column("vec")))
                        for c in book.probes(q, counts, enough) for s in range(slices[c])]
                yield dealt(part.column("q"), part.column("vec"), rows)

    def offer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells, reps = batch.column("cell").to_pylist(), batch.column("rep").to_pylist()
            rows = [(r, c, _spread(v, slices[c]), b) for r, (c, v) in enumerate(zip(cells, reps))
                    for b in range(blocks[c])]
            yield dealt(batch.column("rep"), batch.column("vec"), rows)

    def rank(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return FOUND.empty_table()
        ids = right.column("id").to_numpy()
        return pa.Table.from_batches(_ranked(
            left.column("id").to_numpy(), _matrix(left.column("vec")), ids, _matrix(right.column("vec")),
            np.zeros(len(ids)), k + 1), schema=FOUND)

    deal, keys = "id long, vec binary, cell int, slice int, block int", ("cell", "slice", "block")
    met_rows = (asked.select("q", "vec").mapInArrow(ask, deal).groupBy(*keys)
                .cogroup(index.mapInArrow(offer, deal).groupBy(*keys)).applyInArrow(rank, FOUND_SQL))
    best = _best(met_rows, k + 1)
    order = F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("far"), "vec_id")))
    lists = (best.join(distinct.select("rep", "ids"), "rep")
             .select("q", "score", F.explode("ids").alias("vec_id"))
             .groupBy("q").agg(F.slice(order, 1, k + 1).alias("found")))
    named = (queries.select("vec_id", "h1", "h2").join(asked.select("q", "h1", "h2"), ["h1", "h2"])
             .select(F.col("vec_id").alias("query_id"), "q"))
    others = F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return (named.join(lists, "q").select("query_id", F.posexplode(others).alias("pos", "x"))
            .select("query_id", (F.col("pos") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"),
                    (-F.col("x.far")).alias("score")))


def _by_cell(counted: DataFrame, cells: int) -> np.ndarray:
    out = np.zeros(cells, np.int64)
    for r in counted.collect():
        out[r["cell"]] = r["n"]
    return out
