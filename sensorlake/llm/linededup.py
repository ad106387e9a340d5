"""Removal of lines that many documents share.

Only 128-bit line hashes move, never lines. The hashes are range-partitioned and sorted
by document and position; the first occurrence of a line in each document is streamed
off the sorted rows, and one small count per hash says which lines repeat. The result
per document is a bitmap of the lines that stay. A very common line is spread over
several ranges, since the ranges are those of (hash, document).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorlake.llm.common import fresh, without, written

# Fixed by definition: the characters stripped from both ends of a line.
WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """White space stripped at both ends, A-Z lower-cased and no other letter."""
    bare = F.btrim(line, F.lit(WHITE))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def _lines() -> Column:
    return F.split(F.coalesce(F.col("text"), F.lit("")), "\n", -1)


def line_hashes(docs: DataFrame, min_chars: int = 20) -> DataFrame:
    """(doc_id, text_id, pos, h1, h2) of every line whose key has ``min_chars`` code points."""
    lines = docs.where("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_id"),
        F.posexplode(_lines()).alias("pos", "line"))
    keyed = lines.select("doc_id", "text_id", "pos", line_key(F.col("line")).alias("key"))
    return keyed.where(F.char_length("key") >= min_chars).select(
        "doc_id", "text_id", "pos", F.xxhash64("key").alias("h1"),
        F.xxhash64(F.lit(1), F.col("key")).alias("h2"))


def keep_bitmaps(docs: DataFrame, *, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """(doc_id, text_id, n_dropped, keep) of the documents that lose a line.

    Bit i % 64 of word i // 64 of ``keep`` (array of long) tells whether line i stays;
    words after the last are all ones, and so are documents that are not listed. A line
    goes if at least ``min_docs`` documents hold its key and a larger ``doc_id`` does.

    Rows without ``doc_id`` take no part: they neither count nor lose lines. Rows that
    share a ``doc_id`` count as one document; ``text_id`` (hash of the text) tells their
    bitmaps apart. Null and empty texts have one empty line, which is too short to go.
    Other columns are ignored; an empty table gives no rows.
    """
    lines = written(line_hashes(docs, min_chars), "line-hashes")
    # ~doc_id ascends as doc_id descends, so that a hash's first row is its largest document.
    ordered = (lines.select("h1", "h2", F.bitwise_not("doc_id").alias("later"), "pos")
               .repartitionByRange("h1", "h2", "later")
               .sortWithinPartitions("h1", "h2", "later", "pos"))
    in_doc = Window.partitionBy("h1", "h2", "later").orderBy("pos")
    firsts = ordered.withColumn("nth", F.row_number().over(in_doc)).where("nth = 1")
    repeated = (firsts.groupBy("h1", "h2")
                .agg(F.count(F.lit(1)).alias("docs"), F.min("later").alias("first"))
                .where(F.col("docs") >= min_docs)
                .select("h1", "h2", F.bitwise_not("first").alias("owner")))
    dropped = lines.join(repeated, ["h1", "h2"]).where("doc_id < owner")
    words = (dropped.groupBy("doc_id", "text_id", F.expr("pos div 64").cast("int").alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, pos % 64)")).alias("bits")))
    # A document has a word for 64 of its lines, so that a list is as bounded as its text.
    listed = words.groupBy("doc_id", "text_id").agg(
        F.sum(F.bit_count("bits")).cast("long").alias("n_dropped"),
        F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("bits"))
    keep = F.expr("transform(sequence(0, array_max(map_keys(bits))), "
                  "w -> ~coalesce(try_element_at(bits, w), 0L))")
    return listed.select("doc_id", "text_id", "n_dropped", keep.alias("keep"))


def drop_repeated_lines(docs: DataFrame, *, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``docs`` with the kept text and ``n_lines``, ``n_dropped`` (long).

    A text that loses nothing stays as it is (null stays null). Columns of ``docs`` named
    ``n_lines`` or ``n_dropped`` are replaced; see ``keep_bitmaps`` for the other cases.
    """
    rows = without(docs, "n_lines", "n_dropped")
    id_, text_, n_, keep_ = fresh(rows, "_id", "_text_id", "_n", "_keep")
    bitmaps = keep_bitmaps(docs, min_chars=min_chars, min_docs=min_docs).toDF(id_, text_, n_, keep_)
    found = rows.join(bitmaps.hint("shuffle_hash"), (rows["doc_id"].cast("long") == bitmaps[id_])
                      & (F.xxhash64(rows["text"]) == bitmaps[text_]), "left")
    kept = F.expr("array_join(filter(split(text, '\\n', -1), (line, i) -> "
                  f"(shiftright(coalesce(get({keep_}, i div 64), -1L), i % 64) & 1L) = 1L), '\\n')")
    text = F.when(F.col(keep_).isNull(), F.col("text")).otherwise(kept).alias("text")
    return found.select(
        *[text if c.lower() == "text" else F.col(f"`{c}`") for c in rows.columns],
        F.size(_lines()).cast("long").alias("n_lines"),
        F.coalesce(n_, F.lit(0)).cast("long").alias("n_dropped"))
