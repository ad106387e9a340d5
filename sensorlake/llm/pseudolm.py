"""Masked pseudo-likelihood: how well a window network guesses each word from both sides.

Words are hashed to 64 * 64 codes. The network sees two words on either side, never the
word itself, and gives the code's log-probability in two steps (upper, then lower half).
Its biases start from the counts of all words. It is trained in numpy where the data
are: every task starts from the common weights,
learns from masked words of its documents and returns its weights, which are averaged by
the words they were learned from. Every round takes every document; the masked places move
on by one each round, so that every place is learned from once. A document's score is the sum of the conditional log-probabilities of all its words.

Many words share a code. ``word_likelihood`` adds to a code's log-probability that of the
word among the words of its code, from counts over the whole corpus that stay a table; the
``COMMON`` commonest words are looked up in every task, all others are joined. It splits each
text twice: for codes and counts, and for scores and shares.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from sensorlake.llm.common import bounded_batches, columns_of, fresh, pieces_of, without, written

HALF = 64
CODES = HALF * HALF
EDGE = CODES  # stands beside the first and last word
CODE = "<u2"  # as written
SIDE = 2
DIMS, HIDDEN = 12, 24
# Words scored at once.
BATCH = 1024
# Words to a step of learning.
STEP = 2048
# Scores below this need no shift before their exponentials are added.
SAFE = 40
SHAPES = (("embed", (CODES + 1, DIMS)), ("mix", (2 * SIDE * DIMS, HIDDEN)), ("mix_bias", (HIDDEN,)),
          ("upper", (HIDDEN, HALF)), ("upper_bias", (HALF,)),
          ("lower", (HALF, HIDDEN, HALF)), ("lower_bias", (HALF, HALF)))
SIZES = [int(np.prod(s)) for _, s in SHAPES]
# Weights travel in rows of so many numbers.
CHUNK = 4096
# Words whose log-probabilities go to every task (1 MB).
COMMON = 1 << 16
# A task starts a new vocabulary beyond so many words.
MOST_WORDS = 500_000


class _Codes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        code = self[word] = zlib.crc32(word.encode("utf-8", "surrogatepass")) % CODES
        return code


def codes_of(text: str | None, known: dict) -> np.ndarray:
    words = (text or "").lower().split()
    return np.fromiter(map(known.__getitem__, words), np.int64, len(words))


class _Vocabulary:
    """Numbers of the words that a task has met, with each word's code and 64-bit hash."""

    def __init__(self):
        self.known: dict[str, int] = defaultdict(count().__next__)
        self.codes, self.keys = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def __len__(self) -> int:
        return len(self.known)

    def numbers(self, texts: pa.Array) -> list[np.ndarray]:
        number, out = self.known.__getitem__, []
        for text in texts:
            words = (text.as_py() or "").lower().split()
            out.append(np.fromiter(map(number, words), np.int32, len(words)))
        # The last words are the new ones, latest first.
        new = [w.encode("utf-8", "surrogatepass")
               for w in islice(reversed(self.known), len(self.known) - len(self.codes))][::-1]
        codes = np.fromiter(map(zlib.crc32, new), np.int64, len(new)) % CODES
        keys = np.fromiter(map(xxhash.xxh64_intdigest, new), np.uint64, len(new)) ^ np.uint64(1 << 63)
        self.codes = np.concatenate([self.codes, codes])
        self.keys = np.concatenate([self.keys, keys.view(np.int64)])
        return out


def initial(seed: int = 11) -> np.ndarray:
    rng = np.random.default_rng(seed)
    parts = [rng.normal(0, 0.1 if len(s) > 1 and "bias" not in n else 0.0, s) for n, s in SHAPES]
    return np.concatenate([p.ravel() for p in parts]).astype(np.float32)


def with_frequencies(flat: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``flat`` with biases that give every code its frequency, whatever its neighbours."""
    flat = flat.copy()
    w = views(flat)
    smooth = (counts + 0.1).reshape(HALF, HALF)
    upper = smooth.sum(axis=1)
    w["upper_bias"][:] = np.log(upper / upper.sum())
    w["lower_bias"][:] = np.log(smooth / upper[:, None])
    return flat


def views(flat: np.ndarray) -> dict[str, np.ndarray]:
    ends = np.cumsum(SIZES)
    return {n: flat[e - k:e].reshape(s) for (n, s), k, e in zip(SHAPES, SIZES, ends)}


def laid_out(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All codes with ``SIDE`` edges between documents, the words' places, and their documents."""
    edge = np.full(SIDE, EDGE)
    line = np.concatenate([edge, *[x for d in docs for x in (d, edge)]])
    place = np.flatnonzero(line != EDGE)
    return line, place, np.repeat(np.arange(len(docs)), [len(d) for d in docs])


def masked_places(place: np.ndarray, owner: np.ndarray, r: int, rounds: int) -> np.ndarray:
    """Of every document each ``rounds``-th place, counted from ``r``; the rounds share out all places."""
    within = np.arange(len(place)) - np.searchsorted(owner, owner)
    return place[within % rounds == r]


def _around(line: np.ndarray, place: np.ndarray) -> np.ndarray:
    return np.stack([line[place + o] for o in range(-SIDE, SIDE + 1) if o], axis=1)


def _hidden(w: dict, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x = w["embed"].take(context, axis=0).reshape(len(context), -1)
    return x, np.tanh(x @ w["mix"] + w["mix_bias"])


def _by_upper(line: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
    """``part`` in order of the words' upper halves, both halves, and (half, its rows) of those that occur."""
    high = line[part] // HALF
    part = part[np.argsort(high.astype(np.int8), kind="stable")]
    high, low = np.divmod(line[part], HALF)
    ends = np.searchsorted(high, np.arange(HALF + 1)).tolist()
    return part, high, low, [(k, slice(a, b)) for k, (a, b) in enumerate(zip(ends, ends[1:])) if a < b]


def _softmax(z: np.ndarray) -> np.ndarray:
    """The softmax of each row, in place."""
    # Exponentials of such numbers neither overflow nor vanish; single rows are looked through only beyond them.
    if not -SAFE < z.min() <= z.max() < SAFE:
        z -= z.max(axis=1, keepdims=True)
    np.exp(z, out=z)
    z /= (z @ np.ones(z.shape[1], z.dtype))[:, None]
    return z


def _log_sums(z: np.ndarray) -> np.ndarray:
    """Logarithms of the summed exponentials of each column; ``z`` is used up."""
    if -SAFE < z.min() <= z.max() < SAFE:
        return np.log(np.exp(z, out=z).sum(axis=0))
    top = z.max(axis=0)
    z -= top
    np.exp(z, out=z)
    return top + np.log(z.sum(axis=0))


def log_probabilities(w: dict, line: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Log-probability of the word at each place given its neighbours.

    Words of one upper half are scored together, as columns: both halves' scores are one product.
    """
    out = np.empty(len(line))
    part, _, low, groups = _by_upper(line, place)
    for k, rows in groups:
        both = np.concatenate([w["upper"], w["lower"][k]], axis=1).T
        bias = np.concatenate([w["upper_bias"], w["lower_bias"][k]])[:, None]
        for at in range(rows.start, rows.stop, BATCH):
            here = slice(at, min(at + BATCH, rows.stop))
            _, h = _hidden(w, _around(line, part[here]))
            z = both @ h.T
            z += bias
            found = z[k] + z[HALF + low[here], np.arange(len(h))]
            out[part[here]] = found - _log_sums(z[:HALF]) - _log_sums(z[HALF:])
    return out[place]


def learn(flat: np.ndarray, squares: np.ndarray, line: np.ndarray, place: np.ndarray, rate: float) -> None:
    """AdaGrad steps over the masked ``place``s, in place."""
    w, grad = views(flat), np.empty_like(flat)
    g, step = views(grad), np.empty_like(flat)
    # Biases are the last row of their weights, for a neuron that is always 1.
    lower, g_lower = (np.empty((HALF, HIDDEN + 1, HALF), flat.dtype) for _ in range(2))
    for at in range(0, len(place), STEP):
        part, high, low, groups = _by_upper(line, place[at:at + STEP])
        context, own = _around(line, part), np.arange(len(part))
        x, hidden = _hidden(w, context)
        h = np.ones((len(part), HIDDEN + 1), flat.dtype)
        h[:, :-1] = hidden
        p = _softmax(hidden @ w["upper"] + w["upper_bias"])
        p[own, high] -= 1
        both = h.T @ p
        g["upper"][:], g["upper_bias"][:] = both[:-1], both[-1]
        lower[:, :-1], lower[:, -1] = w["lower"], w["lower_bias"]
        q = np.empty((len(part), HALF), flat.dtype)
        for k, rows in groups:
            np.dot(h[rows], lower[k], out=q[rows])
        _softmax(q)[own, low] -= 1
        g_lower[:] = 0
        back = np.empty_like(hidden)
        for k, rows in groups:
            np.dot(h[rows].T, q[rows], out=g_lower[k])
            np.dot(q[rows], w["lower"][k].T, out=back[rows])
        g["lower"][:], g["lower_bias"][:] = g_lower[:, :-1], g_lower[:, -1]
        back += p @ w["upper"].T
        back *= 1 - hidden * hidden
        g["mix"][:], g["mix_bias"][:] = x.T @ back, back.sum(axis=0)
        dx = (w["mix"] @ back.T).reshape(2 * SIDE, DIMS, -1)
        seen = context.T.ravel()
        for d in range(DIMS):
            g["embed"][:, d] = np.bincount(seen, dx[:, d].ravel(), CODES + 1)
        grad *= 1 / len(part)
        np.multiply(grad, grad, out=step)
        squares += step
        np.sqrt(squares, out=step)
        np.divide(grad, step, out=step)
        step *= rate
        flat -= step


def _rows(flat: np.ndarray, words: int, salt: int) -> Iterator[dict]:
    for n, at in enumerate(range(0, len(flat), CHUNK)):
        yield {"chunk": n, "salt": salt, "words": words, "sums": (flat[at:at + CHUNK].astype("<f8") * words).tobytes()}


SUMS = "chunk int, salt int, words long, sums binary"
SUMS_ARROW = pa.schema([("chunk", pa.int32()), ("salt", pa.int32()), ("words", pa.int64()),
                        ("sums", pa.binary())])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each chunk: sums over the rows of a partition, however many."""
    sums: dict[int, np.ndarray] = {}
    words: dict[int, int] = {}
    for batch in batches:
        for row in batch.to_pylist():
            own = np.frombuffer(row["sums"], "<f8")
            sums[row["chunk"]] = sums.get(row["chunk"], 0) + own
            words[row["chunk"]] = words.get(row["chunk"], 0) + row["words"]
    rows = [{"chunk": c, "salt": 0, "words": words[c], "sums": sums[c].tobytes()} for c in sums]
    yield pa.RecordBatch.from_pylist(rows, schema=SUMS_ARROW)


def trained_weights(docs: DataFrame, *, rounds: int = 3, rate: float = 0.2) -> np.ndarray:
    """Weights learned from every word of ``docs``, whose codes are written once and read in every round."""
    return _learned(written(coded(docs), "codes"), rounds=rounds, rate=rate)


def _learned(lines: DataFrame, *, rounds: int, rate: float = 0.2) -> np.ndarray:
    """Weights learned from ``codes`` of a written table: each round masks one in ``rounds`` of every document.

    Weights are summed in two levels of partitions; ``len(weights)`` numbers reach the driver, once a round.
    """
    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(CODES)
        for batch in batches:
            for x in batch.column("codes"):
                seen += np.bincount(np.frombuffer(x.as_py(), CODE), minlength=CODES)
        yield pa.RecordBatch.from_pylist(list(_rows(seen, 1, int(seen.sum()) % 61)), schema=SUMS_ARROW)

    total = _summed(lines.mapInArrow(tally, SUMS))
    flat = with_frequencies(initial(), total[0]) if total else initial()
    for r in range(rounds):
        start, step = flat, rate / (1 + r)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, squares, words = start.copy(), np.full(len(start), 1e-4, np.float32), 0
            salt = 0
            for batch in batches:
                for piece in pieces_of(batch, "codes", 1 << 20):
                    line, place, owner = laid_out(
                        [np.frombuffer(x.as_py(), CODE).astype(np.int64) for x in piece.column("codes")])
                    mask = masked_places(place, owner, r, rounds)
                    learn(own, squares, line, mask, step)
                    words += len(mask)
                    salt = (salt * 31 + len(place)) % 61
            if words:
                yield pa.RecordBatch.from_pylist(list(_rows(own, words, salt)), schema=SUMS_ARROW)

        total = _summed(lines.mapInArrow(run, SUMS))
        if total:
            flat = (total[0] / total[1]).astype(np.float32)
    return flat


def coded(docs: DataFrame) -> DataFrame:
    """(codes binary): the word codes of every text, two bytes each; null and blank texts have none."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Codes()
        for batch in batches:
            for piece in pieces_of(batch):
                yield pa.record_batch([pa.array([codes_of(t.as_py(), known).astype(CODE).tobytes()
                                                 for t in piece.column("text")], pa.binary())], names=["codes"])

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "codes binary")


def _summed(local: DataFrame) -> tuple[np.ndarray, int] | None:
    """Sums of the tasks' numbers and of their words, added up in two levels of partitions."""
    halfway = local.repartition("chunk", "salt").mapInArrow(_added, SUMS)
    found = sorted(halfway.repartition("chunk").mapInArrow(_added, SUMS).collect(), key=lambda x: x["chunk"])
    if not found:
        return None
    return np.concatenate([np.frombuffer(x["sums"], "<f8") for x in found]), found[0]["words"]


def pseudo_likelihood(docs: DataFrame, *, rounds: int = 3) -> DataFrame:
    """``docs`` with ``n_words`` long, ``log_likelihood`` and ``mean_log_prob`` double.

    The network is trained on the same ``docs``. Null, empty and blank texts have no words,
    likelihood 0 and a null mean. Columns of ``docs`` named like a result column are
    replaced; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(trained_weights(docs, rounds=rounds))
    rows = without(docs, "n_words", "log_likelihood", "mean_log_prob")
    out = rows.selectExpr("*", "0L AS n_words", "0D AS log_likelihood",
                          "CAST(NULL AS double) AS mean_log_prob").schema
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, known = views(shared.value), _Codes()
        for batch in batches:
            for piece in pieces_of(batch, most_bytes=2 << 20):
                docs_codes = [codes_of(t.as_py(), known) for t in piece.column("text")]
                line, place, owner = laid_out(docs_codes)
                total = np.bincount(owner, log_probabilities(w, line, place), len(docs_codes))
                n = np.array([len(d) for d in docs_codes])
                yield pa.RecordBatch.from_arrays(
                    [*[c.cast(f.type) for c, f in zip(piece.columns, arrow)], pa.array(n, pa.int64()),
                     pa.array(total, pa.float64()),
                     pa.array([t / k if k else None for t, k in zip(total, n)], pa.float64())], schema=arrow)

    return rows.mapInArrow(run, out)


def counted(docs: DataFrame) -> DataFrame:
    """(codes binary, word long, code int, n long): the codes of every text, and a task's counts of words, in rows apart."""
    bounded_batches(docs.sparkSession)
    names = ["codes", "word", "code", "n"]
    types = [pa.binary(), pa.int64(), pa.int32(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen = _Vocabulary(), np.zeros(0, np.int64)

        def counts() -> pa.RecordBatch:
            return pa.record_batch([pa.nulls(len(seen), types[0]), pa.array(known.keys),
                                    pa.array(known.codes.astype(np.int32)), pa.array(seen)], names=names)

        for batch in batches:
            for piece in pieces_of(batch):
                if len(known) > MOST_WORDS:
                    yield counts()
                    known, seen = _Vocabulary(), np.zeros(0, np.int64)
                texts = known.numbers(piece.column("text"))
                code, more = known.codes.astype(CODE), np.zeros(len(known), np.int64)
                more[:len(seen)] = seen
                seen = more + np.bincount(np.concatenate(texts), minlength=len(known))
                yield pa.record_batch([pa.array([code[x].tobytes() for x in texts], types[0]),
                                       *[pa.nulls(len(texts), t) for t in types[1:]]], names=names)
        if len(known):
            yield counts()

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "codes binary, word long, code int, n long")


def word_log_shares(lines: DataFrame) -> DataFrame:
    """(word long, n long, log_share double) of every word ``counted``: its share of the places of its code."""
    words = written(lines.where("word IS NOT NULL").groupBy("word", "code").agg(F.sum("n").alias("n")), "words")
    codes = words.groupBy("code").agg(F.sum("n").alias("total"))
    return words.join(F.broadcast(codes), "code").select(   # at most CODES rows
        "word", "n", F.log(F.col("n") / F.col("total")).alias("log_share"))


def word_likelihood(docs: DataFrame, *, rounds: int = 3) -> DataFrame:
    """``docs`` less ``text``, with the columns of ``pseudo_likelihood`` for words instead of their codes."""
    spark = docs.sparkSession
    lines = written(counted(docs), "codes")
    weights = spark.sparkContext.broadcast(_learned(lines.where("codes IS NOT NULL").select("codes"), rounds=rounds))
    shares = written(word_log_shares(lines), "word-shares")
    top = shares.orderBy(F.desc("n"), "word").limit(COMMON).select("word", "log_share").toArrow()
    common = spark.sparkContext.broadcast(
        dict(zip(top.column("word").to_pylist(), top.column("log_share").to_pylist())))
    rows = without(docs, "n_words", "log_likelihood", "mean_log_prob", "text")
    row, text, rare, n_rare, own, share = fresh(rows, "_row", "_text", "_rare", "_n_rare", "_own", "_share")
    kept = len(rows.columns) + 1
    given = without(docs, "n_words", "log_likelihood", "mean_log_prob").select(
        *columns_of(rows), F.monotonically_increasing_id().alias(row), F.col("text").cast("string").alias(text))
    out = given.selectExpr("* EXCEPT (" + text + ")", "0L AS n_words", "0D AS log_likelihood",
                           f"array(0L) AS {rare}", f"array(0L) AS {n_rare}").schema
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, share_of, known, found = views(weights.value), common.value, _Vocabulary(), np.zeros(0)
        for batch in batches:
            for piece in pieces_of(batch, text, 2 << 20):
                if len(known) > MOST_WORDS:
                    known, found = _Vocabulary(), np.zeros(0)
                texts = known.numbers(piece.column(text))
                code, key = known.codes, known.keys
                # Not a number: a word that is joined.
                found = np.concatenate([found, [share_of.get(k, np.nan) for k in key[len(found):].tolist()]])
                line, place, owner = laid_out([code[x] for x in texts])
                every = np.concatenate(texts).astype(np.int64)
                added = found[every]
                joined = np.isnan(added)
                added[joined] = 0
                total = np.bincount(owner, log_probabilities(w, line, place) + added, len(texts))
                pairs, n = np.unique(owner[joined] * len(known) + every[joined], return_counts=True)
                ends = pa.array(np.searchsorted(pairs, np.arange(len(texts) + 1) * len(known)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [*[c.cast(f.type) for c, f in zip(piece.columns[:kept], arrow)],
                     pa.array([len(x) for x in texts], pa.int64()), pa.array(total, pa.float64()),
                     *[pa.ListArray.from_arrays(ends, pa.array(x, pa.int64())).cast(f.type)
                       for x, f in ((key[pairs % max(1, len(known))], arrow.field(rare)), (n, arrow.field(n_rare)))]], schema=arrow)

    scored = written(given.mapInArrow(run, out), "scores")
    parts = scored.select(F.col(row).alias(own), F.inline(F.arrays_zip(
        F.col(rare).alias("word"), F.col(n_rare).alias("times"))).alias("word", "times"))
    joined = parts.join(shares.select("word", "log_share"), "word").groupBy(own).agg(
        F.sum(F.col("times") * F.col("log_share")).alias(share))
    total = F.col("log_likelihood") + F.coalesce(share, F.lit(0.0))
    return (scored.join(joined, F.col(row) == F.col(own), "left").withColumn("log_likelihood", total)
            .withColumn("mean_log_prob", F.when(F.col("n_words") > 0, F.col("log_likelihood") / F.col("n_words")))
            .drop(row, rare, n_rare, own, share))
