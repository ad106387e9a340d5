"""SimHash near-duplicates: pigeonhole blocks, join on blocks, verify the distance.

A 64-bit fingerprint has four blocks of 16 bits. Two fingerprints with at most two
differing bits agree in at least two blocks, so that they meet under one of the six
block pairs (32-bit keys). Equal fingerprints are merged before; a key then holds few
fingerprints, which are compared with each other. Keys with more than ``SMALL`` take
another exact way: fingerprints at most two bits apart have a common neighbour at most
one bit from either, and all that share a neighbour are linked, so that one link to
the smallest of them says everything. No group is ever compared pair by pair beyond
``SMALL``, and no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.common import bounded_batches, columns_of, fresh, pieces_of, written
from sensorlake.llm.components import components

SEED = 42
SMALL = 64
BLOCK = 16
# Shingles hashed at a time, so that a very long text needs no more memory than others.
CHUNK = 1 << 16


def shingle_hashes(words: list[bytes], width: int) -> Iterator[np.ndarray]:
    """XXH64 of every run of ``width`` words, space-joined; all words if they are fewer."""
    digest = partial(xxhash.xxh64_intdigest, seed=SEED)
    if words and len(words) < width:
        yield np.array([digest(b" ".join(words))], dtype=np.uint64)
        return
    for at in range(0, len(words) - width + 1, CHUNK):
        part = words[at:at + CHUNK + width - 1]
        runs = zip(*[part[i:] for i in range(width)])
        yield np.fromiter(map(digest, map(b" ".join, runs)), np.uint64, len(part) - width + 1)


def fingerprint(text: str | None, width: int) -> int:
    """SimHash of the ASCII-lower-cased words; 0 without words."""
    words = (text or "").encode().lower().split()
    ones, n = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(words, width):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id long, fp long) of every row; null and wordless texts have fingerprint 0."""
    bounded_batches(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces_of(batch):
                fps = np.array([fingerprint(t.as_py(), width) for t in piece.column("text")],
                               dtype=np.uint64)
                yield pa.record_batch([piece.column("doc_id"), pa.array(fps.view(np.int64))],
                                      schema=schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def _block(i: int) -> Column:
    return F.shiftrightunsigned("fp", i * BLOCK).bitwiseAND(F.lit((1 << BLOCK) - 1))


def block_keys() -> Column:
    """The six block pairs of ``fp``, each a long that names the pair and holds its bits."""
    pairs = [(i, j) for i in range(4) for j in range(i)]
    return F.array(*[F.shiftleft(F.lit(n).cast("long"), 2 * BLOCK)
                     + F.shiftleft(_block(i), BLOCK) + _block(j) for n, (i, j) in enumerate(pairs)])


def links(distinct: DataFrame) -> DataFrame:
    """Edges (a, b) that connect all of ``distinct`` (fp) at most two bits apart."""
    keyed = distinct.select("fp", F.explode(block_keys()).alias("key"))
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = written(keyed.join(sizes, "key").select("key", "fp", "n"), "blocks")
    groups = shared.where(F.col("n") <= SMALL).groupBy("key").agg(F.collect_list("fp").alias("fps"))
    close = groups.select(F.explode("fps").alias("a"), "fps").select("a", F.explode(F.filter(
        "fps", lambda x: (x > F.col("a")) & (F.bit_count(x.bitwiseXOR(F.col("a"))) <= 2))).alias("b"))
    crowded = shared.where(F.col("n") > SMALL).select("fp").distinct()
    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(64)])
    near = crowded.select("fp", F.explode(flips).alias("bit")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("bit")).alias("centre"))
    # At most 65 fingerprints lie within one bit of a centre.
    stars = near.groupBy("centre").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
    starred = stars.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a <> b")
    return close.unionByName(starred).distinct()


def near_duplicates(docs: DataFrame, *, width: int = 3) -> DataFrame:
    """(doc_id, fp long, component_id long): the smallest ``doc_id`` reachable over links.

    Links join fingerprints at most two bits apart. Null and wordless texts have
    fingerprint 0 and are linked like any other. Rows without ``doc_id`` are kept and
    linked, but give no component its name (which is null if it has no other). Repeated
    rows are repeated in the result; other columns are ignored; an empty table gives an
    empty result.
    """
    fps = written(fingerprints(docs, width), "fingerprints")
    distinct = written(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    rooted = components(links(distinct.select("fp"))).withColumnsRenamed({"node": "fp"})
    linked = rooted.join(distinct, "fp")
    names = linked.groupBy("root").agg(F.min("first").alias("name"))
    named = linked.join(names, "root").select("fp", "name")
    classes = distinct.join(named, "fp", "left").select(
        "fp", F.coalesce("name", "first").alias("component_id"))
    return fps.join(classes, "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, *, width: int = 3) -> DataFrame:
    """``docs`` less every document that is not the first (smallest ``doc_id``) of its component."""
    return keep_first(docs, written(near_duplicates(docs, width=width), "classes"))


def keep_first(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """``docs`` less those whose ``component_id`` in ``classes`` (doc_id, component_id) is another id.

    Rows without ``doc_id`` stay. Of rows that repeat one ``doc_id`` the one with the
    smallest text hash stays.
    """
    (id_,) = fresh(docs, "_id")
    named = F.col("doc_id").alias(id_)
    gone = classes.where("doc_id <> component_id").select(named).distinct()
    same = docs["doc_id"].cast("long") == F.col(id_)
    rest = docs.join(gone, same, "left_anti")
    repeated = written(classes.where("doc_id = component_id").groupBy("doc_id").count()
                       .where("count > 1").select(named), "repeated-ids")
    if repeated.isEmpty():
        return rest
    one = (rest.join(repeated, same, "left_semi").groupBy(F.col("doc_id").alias(id_))
           .agg(F.min_by(F.struct(*columns_of(docs)), F.xxhash64("text")).alias("row")).select("row.*"))
    return rest.join(repeated, same, "left_anti").unionByName(one)
