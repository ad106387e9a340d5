"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

The word n-grams of all test items are looked up in every document, through a bitmap of
fixed size first and an exact join after. The n-grams of a copied stretch all name the same
start of the item; the one that the corpus holds least often is the stretch's seed, and
starts are tried from the rarest seed on. (A stretch whose only n-gram is a common one
still has that as its seed: edited copies may have no other.) Around every start that has
enough of the item's words to do better than the best so far, document and item are
aligned word by word, which scores edited copies, too. A document's text is moved and split
once, before the items that it shares seeds with.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.common import bounded_batches, fresh, pieces_of, written

WORD = re.compile(r"\w+")
GRAM = 3
# Bits of the bitmaps that go to every task (2 MB).
BITS = 24
MATCH, MISMATCH, GAP = 2, -1, -1
# Items whose words a task keeps.
MOST_ITEMS = 2000
ODD = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9]


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


def word_hashes(text: str | None, known: dict) -> np.ndarray:
    words = WORD.findall((text or "").lower())
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def gram_hashes(words: np.ndarray, size: int = GRAM) -> np.ndarray:
    """One hash for each run of ``size`` words, as signed numbers."""
    n = max(0, len(words) - size + 1)
    out = np.full(n, size, np.uint64)
    for i in range(size):
        out = (out ^ (out >> np.uint64(29))) * np.uint64(ODD[i % 3]) + words[i:i + n]
    out = (out ^ (out >> np.uint64(32))) * np.uint64(ODD[0])
    return (out ^ (out >> np.uint64(29))).view(np.int64)


def bitmap(df: DataFrame, column: str) -> np.ndarray:
    """Bits set at the low ``BITS`` of a hash column; of fixed size whatever the rows."""
    low = f"({column} & {(1 << BITS) - 1}L)"
    words = df.groupBy(F.expr(f"shiftright({low}, 5)").alias("at")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast({low} & 31L AS int))")).alias("bits")).toArrow()
    out = np.zeros(1 << (BITS - 5), np.uint32)
    out[words.column("at").to_numpy()] = words.column("bits").to_numpy().astype(np.uint32)
    return out


def marked(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes may be in the bitmap."""
    at = hashes.view(np.uint64) & np.uint64((1 << BITS) - 1)
    return (bits[(at >> np.uint64(5)).astype(np.int64)] >> (at & np.uint64(31)).astype(np.uint32)) & 1 == 1


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment: score, and the passage's words from start to end (exclusive)."""
    m, n = len(item), len(passage)
    h = np.zeros((m + 1, n + 1), np.int32)
    ramp = np.arange(n + 1, dtype=np.int32) * -GAP
    for i in range(m):
        diagonal = h[i, :-1] + np.where(passage == item[i], MATCH, MISMATCH)
        best = np.maximum(np.maximum(diagonal, h[i, 1:] + GAP), 0)
        # A gap along the passage costs the same per word, so that a running maximum finds it.
        h[i + 1, 1:] = np.maximum.accumulate(best + ramp[1:]) - ramp[1:]
    score = int(h.max())
    if not score:
        return 0, 0, 0
    i, j = map(int, np.unravel_index(h.argmax(), h.shape))
    end = j
    while h[i, j] > 0:
        if h[i, j] == h[i - 1, j - 1] + (MATCH if item[i - 1] == passage[j - 1] else MISMATCH):
            i, j = i - 1, j - 1
        elif h[i, j] == h[i - 1, j] + GAP:
            i -= 1
        else:
            j -= 1
    return score, j, end


def best_alignment(item: np.ndarray, doc: np.ndarray, starts: list[tuple[int, int]],
                   least: float = 0.0) -> tuple[float, int, int]:
    """The best of the alignments around where the item would start, as a share of the full score.

    ``starts``: (how often the corpus holds the seed, start). Of equal scores the earliest
    place counts. Stretches that hold less than the share ``least`` of the item's words, or
    less than the best so far, cannot score more and are not aligned.
    """
    slack, spans = len(item) // 4 + 4, []
    for n, s in sorted(starts, key=itemgetter(1)):
        lo, hi = max(0, s - slack), min(len(doc), s + len(item) + slack)
        if spans and lo <= spans[-1][2]:
            spans[-1][2] = max(spans[-1][2], hi)
            spans[-1][0] = min(spans[-1][0], n)
        else:
            spans.append([n, lo, hi])
    best = (0.0, 0, 0)
    for _, lo, hi in sorted(spans):
        if np.isin(item, doc[lo:hi]).mean() < max(least, best[0]):
            continue
        score, start, end = align(item, doc[lo:hi])
        share = score / (MATCH * len(item))
        if share > best[0] or share == best[0] and lo + start < best[1]:
            best = (share, lo + start, lo + end)
    return best


ITEM_GRAMS = "ikey long, size int, pos int, gram long"
HITS = "doc_id long, tid long, pos int, gram long"
LEAKS = "doc_id long, item_id long, score double, start_word int, end_word int"


def _item_grams(items: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Hashes()
        for batch in batches:
            for key, text in zip(batch.column("ikey").to_pylist(), batch.column("text").to_pylist()):
                words = word_hashes(text, known)
                size = min(GRAM, len(words))
                grams = gram_hashes(words, size) if size else np.zeros(0, np.int64)
                n = len(grams)
                yield pa.record_batch(
                    [pa.array(np.full(n, key)), pa.array(np.full(n, size, np.int32)),
                     pa.array(np.arange(n, dtype=np.int32)), pa.array(grams)],
                    names=["ikey", "size", "pos", "gram"])

    return items.select("ikey", "text").mapInArrow(run, ITEM_GRAMS)


def _hits(docs: DataFrame, bits: np.ndarray, sizes: list[int]) -> DataFrame:
    """Every place of every document whose n-gram may be an item's."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, own = _Hashes(), shared.value
        for batch in batches:
            for piece in pieces_of(batch):
                rows: list[list[np.ndarray]] = [[], [], [], []]
                for doc, tid, text in zip(*[piece.column(c) for c in ("doc_id", "tid", "text")]):
                    words = word_hashes(text.as_py(), known)
                    for size in sizes:
                        grams = gram_hashes(words, size)
                        pos = np.flatnonzero(marked(own, grams))
                        if len(pos):
                            for r, v in zip(rows, (np.full(len(pos), doc.as_py()), np.full(len(pos), tid.as_py()),
                                                   pos.astype(np.int32), grams[pos])):
                                r.append(v)
                if rows[0]:
                    yield pa.record_batch([pa.array(np.concatenate(r)) for r in rows],
                                          names=["doc_id", "tid", "pos", "gram"])

    return docs.select("doc_id", "tid", "text").mapInArrow(run, HITS)


def leaks(docs: DataFrame, benchmark: DataFrame, *, threshold: float = 0.5,
          least_words: int = 8) -> DataFrame:
    """(doc_id, item_id, score, start_word, end_word) of documents that hold an item, or an edited copy.

    ``score`` is the alignment's share of a full match, 1 for a verbatim copy; words are
    counted from 0. Reported from ``threshold`` on; items of fewer than ``least_words``
    words are reported only in full. Null and wordless texts match nothing, and rows
    without ``doc_id`` or ``item_id`` are left out. Repeated rows give one result, and of
    texts that share an id the best; other columns are ignored; empty tables give an
    empty result.
    """
    bounded_batches(docs.sparkSession)
    items = written(benchmark.where("item_id IS NOT NULL").select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
        .distinct().withColumn("ikey", F.xxhash64("item_id", "text")), "items")
    texts = docs.where("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.xxhash64("text").alias("tid"))
    grams = written(_item_grams(items), "item-grams")
    sizes = [r["size"] for r in grams.select("size").distinct().collect()]  # at most GRAM
    hits = written(_hits(texts, bitmap(grams, "gram"), sizes), "hits")
    held = grams.join(hits.groupBy("gram").agg(F.count(F.lit(1)).alias("n")), "gram")
    met = hits.join(held.select("ikey", "gram", F.col("pos").alias("ipos"), "n"), "gram")
    seeds = met.groupBy("doc_id", "tid", "ikey", (F.col("pos") - F.col("ipos")).alias("start")).agg(F.min("n").alias("n"))
    pairs = written(seeds.groupBy("doc_id", "tid", "ikey").agg(
        F.collect_list(F.struct("n", "start")).alias("starts")), "pairs")
    shared = docs.sparkSession.sparkContext.broadcast(
        bitmap(pairs.select(F.xxhash64("doc_id", "tid").alias("h")), "h"))

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(marked(shared.value, batch.column("h").to_numpy()))).drop_columns(["h"])

    some = (texts.select("doc_id", "tid", "text", F.xxhash64("doc_id", "tid").alias("h"))
            .mapInArrow(seen, "doc_id long, tid long, text string"))
    # Each document's text, then the items to align with it.
    asked = pairs.join(items.select("ikey", "item_id", "text"), "ikey")
    sides = asked.select("doc_id", "tid", "item_id", "text", "starts").unionByName(
        some.withColumns({"item_id": F.lit(None).cast("long"), "starts": F.lit(None).cast(pairs.schema["starts"].dataType)}))
    dealt = sides.repartition("doc_id", "tid").sortWithinPartitions("doc_id", "tid", F.col("item_id").asc_nulls_first())

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, here, doc, splits = _Hashes(), None, None, {}
        for batch in (piece for whole in batches for piece in pieces_of(whole)):
            rows = []
            for r in batch.to_pylist():
                key = r["doc_id"], r["tid"]
                if r["item_id"] is None:
                    # Split only when an item asks for it; a row repeated once more is the same text.
                    here, doc = (key, r["text"]), None
                    continue
                if here is None or here[0] != key:
                    continue
                if doc is None:
                    doc = word_hashes(here[1], known)
                if r["text"] not in splits:
                    if len(splits) > MOST_ITEMS:
                        splits.clear()
                    splits[r["text"]] = word_hashes(r["text"], known)
                item = splits[r["text"]]
                least = threshold if len(item) >= least_words else 1.0
                share, start, end = best_alignment(item, doc, [(x["n"], x["start"]) for x in r["starts"]], least)
                if share >= least:
                    rows.append((r["doc_id"], r["item_id"], share, start, end))
            yield pa.record_batch([pa.array([r[i] for r in rows], t) for i, t in enumerate(
                (pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32()))],
                names=["doc_id", "item_id", "score", "start_word", "end_word"])

    aligned = dealt.select("doc_id", "tid", "item_id", "text", "starts").mapInArrow(score, LEAKS)
    best = F.max(F.struct("score", (-F.col("start_word")).alias("at"), "end_word")).alias("x")
    return aligned.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", "x.score", (-F.col("x.at")).alias("start_word"), "x.end_word")


def without_leaks(docs: DataFrame, benchmark: DataFrame, *, threshold: float = 0.5) -> DataFrame:
    """``docs`` less the documents that ``leaks`` reports."""
    (gone_,) = fresh(docs, "_gone")
    found = leaks(docs, benchmark, threshold=threshold)
    gone = written(found.select(F.col("doc_id").alias(gone_)).distinct(), "leaking")
    return docs.join(gone, docs["doc_id"].cast("long") == F.col(gone_), "left_anti")
