"""Spelling variants: words one edit apart, found by Gram matrices of letter counts.

The squared distance of the letter counts of two words is at most one after an inserted or
deleted letter and at most two after a replaced one. One matrix product gives it for all
pairs of two blocks of words, and pairs at most two apart have their edits verified.

Blocks are cut so that few of them meet. Letters fall into groups; a word's cell is its
length with its number of letters in each group. One edit moves a word to a cell that is
known beforehand (one group more or less by one, or one letter from a group to another),
so that a block meets only blocks of its own cell and of those next to it, and no pair is
lost. Cells with more than ``BLOCK`` words are split by hash into several blocks, each of
which meets all blocks of the cells around. Every unordered pair meets once. Blocks that
come to meet another are compared some thousand words at a time; per word and comparison
one partial result leaves the task, not the pairs.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.common import bounded_batches, pieces_of, written

# Counted letters: a to z, and the code points from U+00C0 on in 20 classes (which can only
# bring words nearer to each other, so that no pair is lost).
CLASSES = 20
LETTERS = 26 + CLASSES
BLOCK = 512
# Blocks that a task compares with the others around.
PER_TASK = 64
# Words compared with a block at a time.
TOGETHER = 4096
# Words counted in a task before the counts are handed on.
MOST_KEPT = 200_000
# Squared counts of shorter words are exact in single precision.
EXACT = 2048
# Pairs verified at a time, and most cells of a product or of a block's letters.
VERIFIED = 1 << 18
CELLS = 1 << 22


def runs_of(text: str, least: int) -> Counter:
    """How often each run of at least ``least`` letters occurs, A to Z lower-cased."""
    found = re.findall(rf"[A-Za-zÀ-ÿ]{{{least},}}", text.encode("utf-8", "surrogatepass").lower()
                       .decode("utf-8", "surrogatepass"))
    return Counter(found)


def altered(run: str, name_crc: int, every: int) -> str:
    """``run`` less one code point if ``every`` divides the CRC-32 of ``<name>:<run>``."""
    h = zlib.crc32(run.encode(), name_crc)
    if every and h % every == 0:
        at = h % len(run)
        return run[:at] + run[at + 1:]
    return run


def word_counts(docs: DataFrame, *, least: int = 7, every: int = 0) -> DataFrame:
    """(word, n long): runs of letters of at least ``least`` code points over all texts.

    With ``every`` given, runs whose CRC with their document's id it divides lose a code point,
    which makes misspellings to be found again. Null texts hold no words; a row without
    ``doc_id`` has the empty name.
    """
    bounded_batches(docs.sparkSession)
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def flushed(counts: dict) -> pa.RecordBatch:
        return pa.record_batch([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        for batch in batches:
            for piece in pieces_of(batch):
                for name, text in zip(piece.column("name").to_pylist(), piece.column("text")):
                    text = text.as_py()
                    if not text:
                        continue
                    crc = zlib.crc32(f"{name}:".encode())
                    for word, n in runs_of(text, least).items():
                        word = altered(word, crc, every)
                        if len(word) >= least:
                            counts[word] = counts.get(word, 0) + n
                    if len(counts) > MOST_KEPT:
                        yield flushed(counts)
                        counts = {}
        yield flushed(counts)

    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("name"),
                       F.col("text").cast("string").alias("text"))
    return (rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")))


def letter_index(codes: np.ndarray) -> np.ndarray:
    codes = codes.astype(np.int64)
    return np.where(codes < 128, codes - 97, 26 + codes % CLASSES)


def group_of_letters(groups: int) -> np.ndarray:
    """Letter groups of nearly equal weight, dealt in turn by usual frequency."""
    # Letters by their frequency in English.
    usual = "etaoinsrhldcumfpgwybvkxjqz"
    at = np.arange(LETTERS) % groups
    for i, letter in enumerate(usual):
        # To and fro, so that no group has all the more frequent ones.
        step = i % (2 * groups)
        at[ord(letter) - 97] = step if step < groups else 2 * groups - 1 - step
    return at


def cells_of(words: list[str], groups: int) -> list[str]:
    """A word's cell, written as its letters per group with commas between."""
    at = group_of_letters(groups)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    codes = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
    owner = np.repeat(np.arange(len(words)), lengths)
    counts = np.bincount(owner * groups + at[letter_index(codes)], minlength=len(words) * groups)
    return [",".join(map(str, row)) for row in counts.reshape(-1, groups).tolist()]


def around(cell: Column, groups: int) -> Column:
    """The cells whose blocks a block of ``cell`` is sent to: its own, half of those of its
    length (a letter moved from a group to a later one) and those of one letter less."""
    def moved(change: dict[int, int]) -> Column:
        fits = F.lit(True)
        for i, by in change.items():
            if by < 0:
                fits = fits & (cell[i] > 0)
        return F.when(fits, F.array(*[cell[i] + F.lit(change.get(i, 0)) for i in range(groups)]))

    changes = [{}, *[{i: -1, j: 1} for i in range(groups) for j in range(i + 1, groups)], *[{i: -1} for i in range(groups)]]
    return F.filter(F.array(*[moved(c) for c in changes]), lambda x: x.isNotNull())


def one_edit(longer: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Which rows of code points are exactly one edit apart; ``other`` is as wide or one narrower."""
    if longer.shape[1] == other.shape[1]:
        return (longer != other).sum(axis=1) == 1
    width = other.shape[1]
    same_head = np.logical_and.accumulate(longer[:, :width] == other, axis=1).sum(axis=1)
    same_tail = np.logical_and.accumulate((longer[:, 1:] == other)[:, ::-1], axis=1).sum(axis=1)
    return same_head + same_tail >= width


class Words:
    """Words of one length with their code points, and ``n`` of each."""

    def __init__(self, body: str, width: int, n: np.ndarray):
        self.body, self.width, self.n = body, width, n
        self.codes = np.frombuffer(body.encode("latin-1"), np.uint8).reshape(-1, width)

    def __len__(self) -> int:
        return len(self.n)

    def letters(self, left: bool) -> np.ndarray:
        """Letter counts, with two columns more by which left times right is the squared distance."""
        size = len(self)
        places = np.repeat(np.arange(size) * LETTERS, self.width) + letter_index(self.codes.ravel())
        counts = np.bincount(places, minlength=size * LETTERS).reshape(size, LETTERS)
        counts = counts.astype(np.float32 if self.width < EXACT else np.float64)
        norms, ones = (counts ** 2).sum(axis=1)[:, None], np.ones((size, 1), counts.dtype)
        return np.hstack([counts, norms, ones] if left else [-2 * counts, ones, norms])

    def __getitem__(self, places: np.ndarray) -> list[str]:
        width, body = self.width, self.body
        return [body[i:i + width] for i in (places * width).tolist()]


def near_pairs(a: Words, b: Words, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, j): words i of ``a`` and j of ``b`` exactly one edit apart; ``a`` is not the shorter.

    ``right`` is ``b.letters(False)``. With ``a`` and ``b`` the same every pair comes once.
    """
    found_i, found_j = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    left, step = a.letters(True), max(1, CELLS // max(1, len(b)))
    most = max(1, min(VERIFIED, 4 * CELLS // a.width))
    for start in range(0, len(a), step):
        distance = left[start:start + step] @ right.T
        i, j = np.divmod(np.flatnonzero(distance.ravel() < 2.5), len(b))
        i = i + start
        if a is b:
            i, j = i[i < j], j[i < j]
        for at in range(0, len(i), most):
            part = slice(at, at + most)
            ok = one_edit(a.codes[i[part]], b.codes[j[part]])
            found_i.append(i[part][ok])
            found_j.append(j[part][ok])
    return np.concatenate(found_i), np.concatenate(found_j)


def best_of(mine: np.ndarray, partner: np.ndarray, own: Words, other: Words) -> tuple[list, list, list, list]:
    """Per word of ``own`` with partners: the word, their number, and the commonest one's n and word."""
    if not len(mine):
        return [], [], [], []
    # Among equally common partners the smallest word: one-edit neighbours of a length compare like their codes.
    names = np.argsort(np.argsort(np.array(other[np.unique(partner)], dtype=object)))
    rank = np.zeros(len(other), np.int64)
    rank[np.unique(partner)] = names
    order = np.lexsort((rank[partner], -other.n[partner], mine))
    mine, partner = mine[order], partner[order]
    first = np.flatnonzero(np.r_[True, mine[1:] != mine[:-1]])
    counts = np.diff(np.r_[first, len(mine)])
    return own[mine[first]], counts.tolist(), other.n[partner[first]].tolist(), other[partner[first]]


def compare(home: Words, others: Iterator[Words]) -> Iterator[tuple[list, list, list, list]]:
    """Partial results of ``home`` against itself and ``others`` (as long, or longer by one)."""
    right = home.letters(False)
    i, j = near_pairs(home, home, right)
    yield best_of(np.concatenate([i, j]), np.concatenate([j, i]), home, home)
    waiting: dict[int, list[Words]] = {}

    def met(blocks: list[Words]) -> Iterator[tuple[list, list, list, list]]:
        guests = Words("".join(b.body for b in blocks), blocks[0].width, np.concatenate([b.n for b in blocks]))
        i, j = near_pairs(guests, home, right)
        yield best_of(i, j, guests, home)
        yield best_of(j, i, home, guests)

    for block in others:
        blocks = waiting.setdefault(block.width, [])
        blocks.append(block)
        if sum(map(len, blocks)) * block.width >= TOGETHER * min(block.width, 64):
            yield from met(waiting.pop(block.width))
    for blocks in waiting.values():
        yield from met(blocks)


def groups_for(n: int) -> int:
    """Letter groups that leave cells of some hundred words: finer as the vocabulary grows."""
    return max(2, round(math.log2(max(n, 2)) / 4.5))


def near_words(words: DataFrame, *, groups: int | None = None) -> DataFrame:
    """(word, n_near long, best_n long, best string) of every word that has a word one edit away.

    ``words`` holds distinct (word, n) of letters up to U+00FF; ``best`` is the near word of the
    largest ``n``, the smallest in code-point order among equals. ``groups`` sets how finely
    words are parted (from their number if not given); results do not depend on it.
    """
    groups = groups or groups_for(words.count())

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces_of(batch, "word"):
                cells = cells_of(piece.column("word").to_pylist(), groups)
                yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(cells, pa.string())], ["word", "n", "cell"])

    located = written(words.select("word", "n").mapInArrow(placed, "word string, n long, cell string"), "cells")
    # Long words make smaller blocks, so that a block's letters stay bounded.
    per_block = F.greatest(F.lit(1), F.least(F.lit(BLOCK), F.floor(F.lit(CELLS) / F.max(F.length("word")))))
    sizes = written(located.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / per_block).alias("n_blocks")), "cell-sizes")
    members = F.collect_list(F.struct("word", "n"))
    # A block's words follow each other in one string; all have the length that their cell adds up to.
    blocks = written(
        located.join(sizes, "cell").groupBy("cell", F.pmod(F.xxhash64("word"), F.col("n_blocks")).alias("block"))
        .agg(members.alias("m")).select("cell", "block", F.length(F.col("m.word")[0]).alias("width"),
                                        F.array_join("m.word", "").alias("body"), F.col("m.n").alias("ns")), "word-blocks")
    next_to = F.explode(around(F.split("cell", ",").cast("array<int>"), groups))
    sent = blocks.select("cell", "block", next_to.alias("near")).withColumn("target", F.concat_ws(",", "near")).drop("near")
    targets = blocks.select(F.col("cell").alias("target"), F.col("block").alias("target_block"))
    meetings = sent.join(targets, "target").where("cell <> target OR block <= target_block")
    own = (F.col("cell") == F.col("target")) & (F.col("block") == F.col("target_block"))
    carried = meetings.join(blocks, ["cell", "block"]).select("target", "target_block", own.alias("own"), "width", "body", "ns")
    # A given number of tasks: little data is no little work, so that Spark should not merge them by size.
    tasks = max(-(-blocks.count() // PER_TASK), int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = carried.repartition(tasks, "target", "target_block").sortWithinPartitions("target", "target_block", F.desc("own"))
    schema = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, Words]]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("target", "target_block", "width", "body")]
            ns = batch.column("ns")
            for k, (target, part, width, body) in enumerate(zip(*columns)):
                yield (target, part), Words(body, width, ns[k].values.to_numpy())

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []
        for _, rows in groupby(rows_of(batches), key=lambda row: row[0]):
            # A block's own row comes first of those sent to it.
            for partial in compare(next(rows)[1], (block for _, block in rows)):
                waiting.append(partial)
            if sum(len(p[0]) for p in waiting) >= TOGETHER:
                yield joined(waiting)
                waiting = []
        yield joined(waiting)

    def joined(partials: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array([x for p in partials for x in p[c]], f.type) for c, f in enumerate(schema)],
                               schema=schema)

    found = dealt.mapInArrow(compared, "word string, n_near long, best_n long, best string")
    # The largest n, then the smallest word: by code points, which UTF-8 keeps in order.
    most = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("best")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), most.alias("_most")).select(
        "word", "n_near", (-F.col("_most.less")).alias("best_n"), F.col("_most.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) by following ``forms`` (word, form) to the last; chains hold no circle.

    Pointers are doubled until none changes, one written table a round.
    """
    state = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = state.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = written(state.join(ahead, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        state = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return state


def spelling_variants(docs: DataFrame, *, least: int = 7, seen: int = 2, every: int = 0, ratio: int = 10,
                      groups: int | None = None) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of all words of at least ``least`` letters seen ``seen`` times.

    ``form`` is a word's commonest near word if it is at least ``ratio`` times as common, else
    null; ``root`` is the last form reached. Null, empty and wordless texts add nothing,
    repeated rows count again, other columns are ignored; an empty table gives an empty result.
    """
    words = written(word_counts(docs, least=least, every=every).where(F.col("n") >= seen), "words")
    near = near_words(words, groups=groups)
    common = F.col("best_n") >= ratio * F.col("n")
    formed = written(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(common, F.col("best")).alias("form"),
        F.when(common, F.col("best_n")).alias("form_n")), "forms")
    last = roots(formed.where("form IS NOT NULL").select("word", "form"))
    return formed.join(last, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
