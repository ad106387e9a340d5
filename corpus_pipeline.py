"""From raw documents to packed training sequences, in five stages.

Every stage takes ``(spark, docs, sf_dir)``, works on all that the stage before kept and is
written as Parquet before the next one reads it. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.llm.common import table, written
from sensorlake.llm.decontamination import without_leaks
from sensorlake.llm.linededup import drop_repeated_lines
from sensorlake.llm.nearcopies import one_of_similar
from sensorlake.llm.packing import pack
from sensorlake.llm.simhash import one_of_each
from sensorlake.llm.toxicity import toxicity_scores

WORDS = "word_bpe_49k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose windows an ordinary dictionary compresses as well as a toxic one."""
    scored = toxicity_scores(docs, table(spark, sf_dir, "labels"))
    return scored.where("predicted = 0").select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that others repeat; ``n_chars`` follows a changed text.

    A document that loses all lines stays, empty; the next stage keeps one of those.
    """
    kept = drop_repeated_lines(docs)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.when(
            F.col("n_dropped") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return kept.select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that ``op3_simhash`` links, then of each five-word similarity of at least 0.8.

    Fingerprints come first: they merge large groups before any two texts are compared.
    """
    return one_of_similar(one_of_each(docs, width=3), width=5, similar=0.8)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences of 2048 tokens, with their token ids."""
    return pack(docs, public_tokenizers.path(WORDS))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_lines),
    ("near dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("packing", packed),
]

# The stages need trained dictionaries, fingerprints and alignments: not SQL. Tests compare
# each with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
