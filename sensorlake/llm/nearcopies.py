"""Near copies by exact similarity: blocks of min-wise fingerprints, Hamming check, Jaccard.

Texts are sets of five-word shingles. A fingerprint of ``BLOCKS`` x ``ROWS`` min-wise values
is split into blocks of ``ROWS`` values; texts meet under every block that they share. A pair
of similarity 0.8 shares a block with probability 0.8 ** 5, so that all 32 blocks miss it
3 times in a million. (Sums of signs, as in ``simhash``, differ in a seventh of their bits at
that similarity: blocks that such pairs share are too short to tell texts apart.) The lowest
bits of the values give a 160-bit fingerprint, whose Hamming distance drops unlike pairs
before their texts are read; so does a parity of the shingles in each of ``PARITIES`` classes,
whose distance is never more than the number of shingles that only one of two texts has. It
tells texts of up to some thousand words apart that are just less similar than asked, and loses
no pair. The exact Jaccard similarity decides.

Copies are merged before. Each text is compared with the first of each of its blocks, and what
is linked becomes a component; then, in blocks that hold several components, the texts
outside the block's largest one are compared with all others. A group of thousands of near
copies thus costs one comparison a text, and no pair that shares a block goes unseen.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.common import bounded_batches, pieces_of, written
from sensorlake.llm.components import components
from sensorlake.llm.simhash import keep_first, shingle_hashes

BLOCKS, ROWS = 32, 5
VALUES = BLOCKS * ROWS
# Bits differ with probability 0.1 at similarity 0.8: 16 of 160, deviation 3.8. More than this
# many happens once in ten million such pairs.
FARTHEST = 37
BITS = ("b0", "b1", "b2")
# Classes of shingles whose parities are kept, 64 in a long.
PARITIES = 1024
ODD = tuple(f"p{i}" for i in range(PARITIES // 64))
# Shingles minimised at a time: the products stay in a core's cache.
CHUNK = 512
# Shingle sets that a task keeps for its next pairs.
KEPT = 64


def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(64)
    draw = rng.integers(0, 1 << 63, (2, VALUES, 1), dtype=np.uint64)
    return draw[0], draw[1] * np.uint64(2) + np.uint64(1)


MASKS, FACTORS = _multipliers()


def shingle_set(text: str | None, width: int = 5) -> np.ndarray:
    """Distinct shingle hashes of the ASCII-lower-cased words, ascending; none without words."""
    parts = list(shingle_hashes((text or "").encode().lower().split(), width))
    return np.unique(np.concatenate(parts)) if parts else np.empty(0, np.uint64)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two ascending sets; 1 of two empty ones."""
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def minima(shingles: np.ndarray) -> np.ndarray:
    """The smallest of the shingles under each of ``VALUES`` orders."""
    low = np.full(VALUES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), CHUNK):
        np.minimum(low, ((shingles[at:at + CHUNK] ^ MASKS) * FACTORS).min(axis=1), out=low)
    return low


def block_keys(low: np.ndarray) -> list[int]:
    """A signed 64-bit key for each block, which names the block and holds its values."""
    return [xxhash.xxh64_intdigest(part.tobytes(), seed=n) - (1 << 63)
            for n, part in enumerate(low.astype("<u8").reshape(BLOCKS, ROWS))]


def bits_of(low: np.ndarray) -> np.ndarray:
    """One bit of each value, in three longs."""
    mixed = low >> np.uint64(17)
    bits = np.zeros(64 * len(BITS), np.uint8)
    bits[:VALUES] = mixed & np.uint64(1)
    return np.packbits(bits, bitorder="little").view("<i8")


def parities(shingles: np.ndarray) -> np.ndarray:
    """Whether the number of shingles in each class is odd, in ``PARITIES`` / 64 longs."""
    counts = np.bincount((shingles % np.uint64(PARITIES)).astype(np.int64), minlength=PARITIES)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").view("<i8")


def sketches(docs: DataFrame, width: int = 5) -> DataFrame:
    """(doc_id, th, set, n, keys, b0 to b2, p0 to p15) of every row: ``th`` its text's hash, ``set`` its shingle set's."""
    bounded_batches(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("set", pa.int64()), ("n", pa.int64()),
                        ("keys", pa.list_(pa.int64())), *[(b, pa.int64()) for b in BITS + ODD]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces_of(batch):
                found = []
                for t in piece.column("text"):
                    shingles = shingle_set(t.as_py(), width)
                    low = minima(shingles)
                    found.append((xxhash.xxh64_intdigest(shingles.tobytes()) - (1 << 63), len(shingles),
                                  block_keys(low), *bits_of(low).tolist(), *parities(shingles).tolist()))
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), piece.column("th"),
                     *[pa.array([f[i] for f in found], schema.field(i + 2).type) for i in range(len(schema) - 2)]], schema=schema)

    return _hashed(docs).select("doc_id", "th", "text").mapInArrow(
        run, "doc_id long, th long, set long, n long, keys array<long>, " + ", ".join(f"{b} long" for b in BITS + ODD))


def _hashed(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"))


def _alike(similar: float) -> Column:
    """Whether sketches ``x`` and ``y`` may belong to sets of that similarity."""
    def apart(bits: tuple[str, ...]) -> Column:
        return reduce(lambda p, q: p + q, [F.bit_count(F.col(f"x.{b}").bitwiseXOR(F.col(f"y.{b}"))) for b in bits])

    # Of a + b shingles at most this part is in one of the sets only: J = (a + b - d) / (a + b + d).
    most = (F.col("x.n") + F.col("y.n")) * ((1 - similar) / (1 + similar)) + 1e-9
    return ((apart(BITS) <= FARTHEST) & (F.col("x.n") >= F.col("y.n") * similar - 1e-9)
            & (F.col("y.n") >= F.col("x.n") * similar - 1e-9) & (apart(ODD) <= most))


def verified(pairs: DataFrame, docs: DataFrame, width: int, similar: float) -> DataFrame:
    """Those of ``pairs`` (a, b: text hashes) whose texts are at least ``similar``."""
    wanted = pairs.select(F.col("a").alias("th")).unionByName(pairs.select(F.col("b").alias("th"))).distinct()
    texts = written(_hashed(docs).select("th", "text").join(wanted, "th", "left_semi")
                    .groupBy("th").agg(F.min("text").alias("text")), "paired-texts")
    both = pairs.join(texts.withColumnsRenamed({"th": "a", "text": "ta"}), "a").join(
        texts.withColumnsRenamed({"th": "b", "text": "tb"}), "b").select("a", "b", "ta", "tb")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: OrderedDict[int, np.ndarray] = OrderedDict()

        def shingles(th: int, text: str | None) -> np.ndarray:
            if th not in kept:
                if len(kept) >= KEPT:
                    kept.popitem(last=False)
                kept[th] = shingle_set(text, width)
            kept.move_to_end(th)
            return kept[th]

        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            good = [similarity(shingles(x, s.as_py()), shingles(y, t.as_py())) >= similar - 1e-12
                    for x, y, s, t in zip(a, b, batch.column("ta"), batch.column("tb"))]
            yield pa.record_batch([pa.array([v for v, g in zip(c, good) if g], pa.int64()) for c in (a, b)],
                                  schema=schema)

    return both.mapInArrow(run, "a long, b long")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def similar_documents(docs: DataFrame, *, width: int = 5, similar: float = 0.8) -> DataFrame:
    """(doc_id, component_id long): the smallest ``doc_id`` reachable over texts at least ``similar``.

    Null, empty and wordless texts have the empty set and are copies of each other; texts of
    fewer than ``width`` words are one shingle. Rows without ``doc_id`` are kept and linked,
    but give no component its name (null if it has no other). Repeated rows are repeated in
    the result; other columns are ignored; an empty table gives an empty result. Blocks are
    laid out for ``similar`` from 0.8 on.
    """
    every = written(sketches(docs, width), "sketches")
    distinct = written(every.groupBy("set").agg(
        F.min("th").alias("rep"), F.min("doc_id").alias("first"),
        F.first(F.struct("n", "keys", *BITS, *ODD)).alias("s")).select("set", "rep", "first", "s.*"), "sets")
    marks = distinct.select("rep", "n", *BITS, *ODD)
    keyed = distinct.where("n > 0").select("rep", F.explode("keys").alias("key"))
    heads = keyed.groupBy("key").agg(F.min("rep").alias("head"), F.count(F.lit(1)).alias("members")).where("members > 1")
    shared = written(keyed.join(heads, "key").select("key", "rep", "head"), "shared-blocks")

    stars = shared.where("rep <> head").select(F.col("head").alias("a"), F.col("rep").alias("b")).distinct()
    near = (stars.join(marks.alias("x"), F.col("a") == F.col("x.rep"))
            .join(marks.alias("y"), F.col("b") == F.col("y.rep")).where(_alike(similar)).select("a", "b"))
    links = written(verified(written(near, "stars-to-verify"), docs, width, similar), "star-links")
    roots = components(links)

    placed = written(shared.join(roots.select(F.col("node").alias("rep"), "root"), "rep", "left")
                     .select("key", "rep", F.coalesce("root", "rep").alias("root")), "placed")
    sizes = placed.groupBy("key", "root").agg(F.count(F.lit(1)).alias("k"))
    largest = sizes.groupBy("key").agg(F.max_by("root", F.struct("k", "root")).alias("main"),
                                       F.count(F.lit(1)).alias("parts")).where("parts > 1")
    mixed = written(placed.join(largest.drop("parts"), "key").join(marks, "rep"), "mixed-blocks")
    others = mixed.where("root <> main").alias("x").join(
        mixed.alias("y"), (F.col("x.key") == F.col("y.key")) & (F.col("x.root") != F.col("y.root")) & _alike(similar))
    rest = _ordered(others.select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")))
    more = verified(written(rest, "rest-to-verify"), docs, width, similar)

    rooted = components(links.unionByName(written(more, "more-links"))).withColumnsRenamed({"node": "rep"})
    linked = rooted.join(distinct.select("rep", "first", "set"), "rep")
    names = linked.groupBy("root").agg(F.min("first").alias("name"))
    named = linked.join(names, "root").select("set", "name")
    classes = distinct.join(named, "set", "left").select("set", F.coalesce("name", "first").alias("component_id"))
    return every.select("doc_id", "set").join(classes, "set").select("doc_id", "component_id")


def one_of_similar(docs: DataFrame, *, width: int = 5, similar: float = 0.8) -> DataFrame:
    """``docs`` less every document that is not the first (smallest ``doc_id``) of its component.

    Odd rows as in ``similar_documents`` and ``keep_first``.
    """
    return keep_first(docs, written(similar_documents(docs, width=width, similar=similar), "similar-classes"))
