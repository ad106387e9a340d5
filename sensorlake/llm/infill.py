"""Fill-in-the-middle: a text cut in three and put in another order, so that the middle comes last.

A text is a sequence of units (a run of ASCII letters, or any other character). One
``fullmatch`` of the repeated unit keeps every repetition: ``ends(1)`` lists where each
unit ends, so that its length is the number of units and two of its entries are the cuts.
Texts longer than ``PART`` are matched part by part, cut where a unit ends, and the parts
that hold a cut are matched once more, so that memory stays bounded.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from sensorlake.llm.common import bounded_batches, fresh, pieces_of, without

UNITS = regex.compile(r"([A-Za-z]+|[^A-Za-z])*")
LETTERS = regex.compile(r"[A-Za-z]*")
# Characters matched at a time: about 25 MB of captures.
PART = 1 << 17
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
RESULT = "n long, form string, prefix_chars long, middle_chars long, output string"


def parts(text: str, size: int = PART) -> Iterator[tuple[int, int]]:
    """Ranges of about ``size`` characters, ending where a unit ends."""
    start = 0
    while start < len(text):
        stop = min(start + size, len(text))
        if LETTERS.fullmatch(text, stop - 1, stop):
            stop = LETTERS.match(text, stop).end()
        yield start, stop
        start = stop


def unit_ends(text: str, start: int, stop: int) -> list[int]:
    return UNITS.fullmatch(text, start, stop).ends(1)


def cuts(text: str, h1: int, h2: int, size: int = PART) -> tuple[int, int, int]:
    """(number of units n, offsets after the smaller and the larger of h1 % (n+1) and h2 % (n+1))."""
    if len(text) <= size:
        ends = unit_ends(text, 0, len(text))
        n = len(ends)
        a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
        return n, ends[a - 1] if a else 0, ends[b - 1] if b else 0
    ranges = list(parts(text, size))
    counts = [len(unit_ends(text, *r)) for r in ranges]
    n = sum(counts)

    def offset(units: int) -> int:
        for (start, stop), count in zip(ranges, counts):
            if units <= count:
                return unit_ends(text, start, stop)[units - 1] if units else start
            units -= count
        return len(text)

    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    return n, offset(a), offset(b)


def transform(name: str, text: str | None, *, seed: int = 1, plain: int = 10, spm: int = 20) -> tuple:
    """(n, form, prefix_chars, middle_chars, output) of one text, drawn by ``seed`` and ``name``."""
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))
    n, a, b = cuts(text, h1, h2)
    if not text or h3 % 100 >= 100 - plain or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    if h4 % 100 < spm:
        return n, "spm", a, b - a, f"{SUFFIX}{text[b:]}{PREFIX}{text[:a]}{MIDDLE}{text[a:b]}"
    return n, "psm", a, b - a, f"{PREFIX}{text[:a]}{SUFFIX}{text[b:]}{MIDDLE}{text[a:b]}"


def fill_in_middle(docs: DataFrame, *, seed: int = 1, plain: int = 10, spm: int = 20) -> DataFrame:
    """``docs`` with ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    ``plain`` percent of the texts keep their order, ``spm`` percent of the others open with
    the suffix, the rest with the prefix. A null text counts as empty; empty texts and those
    that hold a mark are plain, with null lengths. A row without ``doc_id`` is drawn by the
    empty name. Repeated rows are repeated with one result; columns of ``docs`` named like a
    result column are replaced; an empty table gives an empty result.
    """
    bounded_batches(docs.sparkSession)
    names = [c.split()[0] for c in RESULT.split(", ")]
    rows = without(docs, *names)
    (name_,) = fresh(rows, "_name")
    out = rows.selectExpr("*", *[f"CAST(NULL AS {c.split()[1]}) AS {c.split()[0]}" for c in RESULT.split(", ")]).schema
    arrow = to_arrow_schema(out)
    own = len(rows.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces_of(batch):
                found = [transform(name.as_py(), text.as_py(), seed=seed, plain=plain, spm=spm)
                         for name, text in zip(piece.column(name_), piece.column("text"))]
                yield pa.RecordBatch.from_arrays(
                    [*[c.cast(f.type) for c, f in zip(piece.columns[:own], arrow)],
                     *[pa.array(values, f.type) for values, f in
                       zip(zip(*found) if found else [()] * len(names), list(arrow)[own:])]], schema=arrow)

    named = rows.withColumns({"text": F.col("text").cast("string"),
                              name_: F.coalesce(F.col("doc_id").cast("string"), F.lit(""))})
    return named.mapInArrow(run, out)


def restored(output: str = "output", form: str = "form") -> Column:
    """The text again, from the output and its form."""
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    return (F.when(F.col(form) == "psm", F.concat(part[1], part[3], part[2]))
            .when(F.col(form) == "spm", F.concat(part[2], part[3], part[1])).otherwise(F.col(output)))
