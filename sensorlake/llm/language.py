"""Language identification: averaged hashed subword embeddings and a linear softmax.

Subwords are byte runs of two to five bytes of the lower-cased text, in which everything
that is no letter became a single space; they are hashed to a fixed number of rows. The
model is trained by stochastic gradient descent in numpy on a bounded sample. On rows left
out of that, a temperature is fitted and a rejection threshold is set for a wanted
precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from sensorlake.llm.common import bounded_batches, pieces_of, without

UNKNOWN = "und"
BUCKETS = 1 << 14
RUNS = (2, 3, 4, 5)
LETTER = regex.compile(r"\p{L}")
# Bytes that are no ASCII letter and no part of a longer character become spaces.
SPACED = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))
# A text's runs are counted in parts of so many bytes.
PART = 1 << 20


def subwords(text: str) -> np.ndarray:
    """Occurrences by bucket of the text's byte runs."""
    data = b" " + b" ".join(text.lower().encode().translate(SPACED).split()) + b" "
    counts = np.zeros(BUCKETS, np.int64)
    for at in range(0, len(data), PART):
        codes = np.frombuffer(data[at:at + PART + max(RUNS) - 1], np.uint8).astype(np.uint64)
        own = min(PART, len(data) - at)
        for n in RUNS:
            size = min(own, len(codes) - n + 1)
            if size < 1:
                continue
            h = np.full(size, n, np.uint64)
            for i in range(n):
                h = h * np.uint64(0x100000001B3) + codes[i:i + size]
            h *= np.uint64(0x9E3779B97F4A7C15)
            counts += np.bincount((h >> np.uint64(50)).astype(np.int64), minlength=BUCKETS)
    return counts


@dataclass(frozen=True)
class Model:
    """``table`` holds each bucket's class scores (embeddings times output weights)."""

    langs: tuple[str, ...]
    table: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def logits(self, text: str) -> np.ndarray:
        counts = subwords(text)
        return (counts @ self.table) / max(1, counts.sum()) + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.langs or not LETTER.search(text):
            return UNKNOWN, 0.0
        z = self.logits(text) / self.temperature
        p = np.exp(z - z.max())
        best = int(p.argmax())
        return self.langs[best], float(p[best] / p.sum())


def _examples(texts: list[str], labels: np.ndarray, rng: np.random.Generator):
    """(buckets, shares, label) of whole texts and of short cuts from each."""
    for text, label in zip(texts, labels):
        cuts = [text]
        for size in (25, 60, 200):
            if len(text) > 2 * size:
                at = int(rng.integers(0, len(text) - size))
                cuts.append(text[at:at + size])
        for cut in cuts:
            counts = subwords(cut)
            buckets = np.flatnonzero(counts)
            if len(buckets):
                yield buckets, (counts[buckets] / counts.sum()).astype(np.float32), int(label)


def train(texts: list[str], langs: list[str], *, dims: int = 16, epochs: int = 6, batch: int = 64,
          rate: float = 8.0, precision: float = 0.99, seed: int = 7) -> Model:
    """Model of the sample; every fifth row calibrates it instead of training it."""
    names = tuple(sorted(set(langs)))
    y = np.array([names.index(x) for x in langs], dtype=np.int64)
    if len(names) < 2:
        return Model(names, np.zeros((BUCKETS, len(names))), np.zeros(len(names)))
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(texts))
    held, used = order[::5], np.setdiff1d(order, order[::5])
    rows = list(_examples([texts[i] for i in used], y[used], rng))
    e = rng.normal(0, 0.1, (BUCKETS, dims)).astype(np.float32)
    w, b = rng.normal(0, 0.1, (dims, len(names))).astype(np.float32), np.zeros(len(names), np.float32)
    steps, at = epochs * -(-len(rows) // batch), 0
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(len(rows)), -(-len(rows) // batch)):
            _step(e, w, b, [rows[i] for i in part], rate * (1 - at / steps))
            at += 1
    model = Model(names, (e @ w).astype(np.float64), b.astype(np.float64))
    checks = [(model.logits(cut), y[i]) for i in held for cut in (texts[i], texts[i][:60])
              if LETTER.search(cut)]
    if not checks:
        return model
    z, right = np.array([c[0] for c in checks]), np.array([c[1] for c in checks])
    temperature = min(np.geomspace(0.1, 10, 41), key=lambda t: _loss(z / t, right))
    return Model(names, model.table, model.bias, float(temperature),
                 _threshold(z / temperature, right, precision))


def _step(e: np.ndarray, w: np.ndarray, b: np.ndarray, rows: list, rate: float) -> None:
    buckets = np.concatenate([r[0] for r in rows])
    shares = np.concatenate([r[1] for r in rows])
    ends = np.cumsum([len(r[0]) for r in rows])
    owner = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    hidden = np.add.reduceat(e[buckets] * shares[:, None], np.concatenate([[0], ends[:-1]]), axis=0)
    p = _softmax(hidden @ w + b)
    p[np.arange(len(rows)), [r[2] for r in rows]] -= 1
    p /= len(rows)
    back = p @ w.T
    w -= rate * hidden.T @ p
    b -= rate * p.sum(axis=0)
    distinct, slot = np.unique(buckets, return_inverse=True)
    for d in range(e.shape[1]):
        e[distinct, d] -= rate * np.bincount(slot, shares * back[owner, d], len(distinct))


def _softmax(z: np.ndarray) -> np.ndarray:
    p = np.exp(z - z.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def _loss(z: np.ndarray, y: np.ndarray) -> float:
    return float(-np.log(_softmax(z)[np.arange(len(y)), y] + 1e-12).mean())


def _threshold(z: np.ndarray, y: np.ndarray, precision: float) -> float:
    """Smallest score above which the calibration rows reach ``precision``."""
    p = _softmax(z)
    score, good = p.max(axis=1), p.argmax(axis=1) == y
    order = np.argsort(-score, kind="stable")
    reached = np.flatnonzero(np.cumsum(good[order]) / np.arange(1, len(y) + 1) >= precision)
    return float(score[order][reached[-1]]) if len(reached) else 1.0


def labelled_sample(docs: DataFrame, held_out: Column, *, per_lang: int = 600,
                    most_bytes: int = 50_000) -> tuple[list[str], list[str]]:
    """Texts and languages: of each language the ``per_lang`` rows smallest by hash of id.

    Only rows with a language, not held out and of up to ``most_bytes`` are drawn; no more
    than ``per_lang * most_bytes`` per language comes to the driver.
    """
    usable = docs.where("lang IS NOT NULL AND doc_id IS NOT NULL").where(~held_out).where(
        F.octet_length("text").between(1, most_bytes)).select(
        F.col("doc_id").cast("long").alias("_id"), F.col("lang").cast("string").alias("_lang"),
        F.col("text").cast("string").alias("text"))
    first = Window.partitionBy("_lang").orderBy(F.xxhash64("_id"), "_id")
    drawn = usable.select("_id", "_lang").withColumn("_nth", F.row_number().over(first)).where(
        F.col("_nth") <= per_lang).select("_id", "_lang").distinct()
    rows = usable.join(F.broadcast(drawn), ["_id", "_lang"]).groupBy("_id", "_lang").agg(
        F.min("text").alias("text")).collect()
    rows = sorted((r for r in rows if LETTER.search(r["text"])), key=lambda r: (r["_id"], r["_lang"]))
    return [r["text"] for r in rows], [r["_lang"] for r in rows]


def identify(docs: DataFrame, held_out: Column, *, per_lang: int = 600) -> DataFrame:
    """``docs`` with ``lang_pred`` string, ``score`` double and ``rejected`` boolean.

    Learned from ``lang`` of the rows that are not ``held_out``; a prediction reads the text
    only. A null text and one without a letter get ``und``, score 0 and ``rejected``; so do
    all rows if no row can be learned from. With one language to learn, that is everyone's.
    Columns of ``docs`` named like a result column are replaced; an empty table gives an
    empty result.
    """
    bounded_batches(docs.sparkSession)
    model = train(*labelled_sample(docs, held_out, per_lang=per_lang))
    rows = without(docs, "lang_pred", "score", "rejected")
    out = rows.selectExpr("*", "'' AS lang_pred", "0D AS score", "true AS rejected").schema
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces_of(batch):
                found = [model.predict(t.as_py()) for t in piece.column("text")]
                yield pa.RecordBatch.from_arrays(
                    [*[c.cast(f.type) for c, f in zip(piece.columns, arrow)],
                     pa.array([x[0] for x in found], pa.string()),
                     pa.array([x[1] for x in found], pa.float64()),
                     pa.array([x[0] == UNKNOWN or x[1] < model.threshold for x in found], pa.bool_())],
                    schema=arrow)

    return rows.mapInArrow(run, out)
