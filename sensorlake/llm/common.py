"""Helpers that the text operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.session import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Hand rows to Python workers in batches of some megabytes, however long the texts are."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below ``spark.checkpoint.dir`` and read it back.

    Cuts lineage, so that a lost executor costs a re-read and not the work before it.
    """
    path = scratch_dir(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` less the columns (in any case) that an operator is about to add."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, each lengthened until no column of ``df`` is called so."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def columns_of(df: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in df.columns]


def doc_crc(doc_id: str = "doc_id") -> Column:
    """CRC-32 of the id as text, by which documents are held out."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary"))


def pieces_of(batch: pa.RecordBatch, text: str = "text",
              most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that a piece's texts stay near ``most_bytes`` (one row at least)."""
    sizes = [0 if v is None else v for v in _byte_lengths(batch.column(text))]
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if total and total + size > most_bytes:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < batch.num_rows:
        yield batch.slice(start)


def _byte_lengths(column: pa.Array) -> list:
    import pyarrow.compute as pc

    return pc.binary_length(column).to_pylist()
