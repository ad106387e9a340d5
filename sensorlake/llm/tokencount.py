"""Token counts under a unigram model, sharing work between common prefixes.

The pieces are those of a public vocabulary file; a piece's log-probability follows from
its rank by Zipf's law, so that nothing is trained. A pre-token's best segmentation is
found by forward scores: the best score of each of its prefixes. The distinct pre-tokens
of a batch form a trie, which is walked depth first (in sorted order): a node's forward
score is computed once for all pre-tokens below it, and the counts are stored at the
terminals. The open path is all of the trie that is in memory.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from sensorlake.llm.common import bounded_batches, pieces_of, without

SPACE = "▁"
# Terminals kept between batches, in characters.
MOST_KEPT = 16 << 20


@dataclass(frozen=True)
class Vocabulary:
    """Log-probabilities of pieces; ``byte`` is that of a byte of a character outside them."""

    pieces: dict[str, float]
    byte: float
    longest: int


def zipf_vocabulary(path: str) -> Vocabulary:
    """The normal pieces of a sentencepiece file, log-probability by rank; bytes come last."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())
             if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    n = len(names) + 256
    whole = math.log(sum(1 / (r + 2) for r in range(n)))
    return Vocabulary({p: -math.log(r + 2) - whole for r, p in enumerate(names)},
                      -math.log(n + 1) - whole, max(map(len, names), default=1))


def segment_all(words: Iterable[str], vocabulary: Vocabulary) -> Iterator[tuple[str, int, float]]:
    """(word, tokens, score) of sorted distinct ``words``; ties take the fewer tokens."""
    pieces, byte, longest = vocabulary.pieces, vocabulary.byte, vocabulary.longest
    before, scores, counts = SPACE, [0.0], [0]
    for word in words:
        text = SPACE + word
        shared, most = 0, min(len(text), len(scores) - 1)
        while shared < most and text[shared] == before[shared]:
            shared += 1
        del scores[shared + 1:], counts[shared + 1:]
        for end in range(shared + 1, len(text) + 1):
            width = len(text[end - 1].encode("utf-8", "surrogatepass"))
            best, tokens = scores[end - 1] + width * byte, counts[end - 1] + width
            for start in range(max(0, end - longest), end):
                own = pieces.get(text[start:end])
                if own is not None:
                    score = scores[start] + own
                    if score > best or score == best and counts[start] < tokens:
                        best, tokens = score, counts[start] + 1
            scores.append(best)
            counts.append(tokens)
        before = text
        yield word, counts[-1], scores[-1]


class Terminals:
    """Counts and scores by pre-token, kept between batches up to a bounded size."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.tokens, self.scores = np.zeros(0, np.int64), np.zeros(0)
        self.kept = 0

    def add(self, texts: list[list[str]]) -> None:
        if self.kept > MOST_KEPT:
            self.clear()
        fresh = sorted({w for words in texts for w in words if w not in self.place})
        found = list(segment_all(fresh, self.vocabulary))
        self.place.update(zip(fresh, range(len(self.tokens), len(self.tokens) + len(fresh))))
        self.tokens = np.append(self.tokens, np.array([t for _, t, _ in found], np.int64))
        self.scores = np.append(self.scores, np.array([s for _, _, s in found], float))
        self.kept += sum(map(len, fresh)) + 8 * len(fresh)

    def count(self, words: list[str]) -> tuple[int, int, float]:
        at = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
        return len(words), int(self.tokens[at].sum()), float(self.scores[at].sum())


def token_counts(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``docs`` with ``n_pretokens``, ``n_tokens`` (long) and ``log_score`` (double).

    Pre-tokens are the words between white space, each opened by the space mark. Null and
    empty texts have no tokens and score 0. Columns of ``docs`` named like a result column
    are replaced; an empty table gives an empty result.
    """
    bounded_batches(docs.sparkSession)
    # As large as its file, and sent as plain values.
    shared = docs.sparkSession.sparkContext.broadcast(
        (vocabulary.pieces, vocabulary.byte, vocabulary.longest))
    rows = without(docs, "n_pretokens", "n_tokens", "log_score")
    out = rows.selectExpr("*", "0L AS n_pretokens", "0L AS n_tokens", "0D AS log_score").schema
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Terminals(Vocabulary(*shared.value))
        for batch in batches:
            for piece in pieces_of(batch):
                texts = [(t.as_py() or "").split() for t in piece.column("text")]
                known.add(texts)
                found = [known.count(words) for words in texts]
                yield pa.RecordBatch.from_arrays(
                    [*[c.cast(f.type) for c, f in zip(piece.columns, arrow)],
                     *[pa.array([x[i] for x in found], arrow.field(len(arrow) - 3 + i).type)
                       for i in range(3)]], schema=arrow)

    return rows.withColumn("text", F.col("text").cast("string")).mapInArrow(run, out)
