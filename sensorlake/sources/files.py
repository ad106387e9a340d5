"""Batch sources: reading CSVs, dated tables, folders and the file inventory."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlake.functions.columns import finite_numbers
from sensorlake.operators.profile import recent_day, require_rows
from sensorlake.spec import ALARM, CSV_SCHEMA, NULL_MARKER, READING_SCHEMA, c


def read_reading_csv(spark: SparkSession, path: str | Sequence[str], *, label_as_text: bool = False,
                     recursive: bool = False, corrupt: str | None = None) -> DataFrame:
    """Reading CSVs with an index column; event time comes from epoch seconds.

    The schema is given, so nothing is read twice. ``corrupt`` names a column that
    keeps lines which do not fit; without it such cells become NULL. NaN is missing, too.
    """
    schema = T.StructType(CSV_SCHEMA.fields + (
        [T.StructField(corrupt, T.StringType())] if corrupt else []))
    options = {"header": True, "nullValue": NULL_MARKER, "mode": "PERMISSIVE",
               "recursiveFileLookup": recursive, "enforceSchema": True}
    if corrupt:
        options["columnNameOfCorruptRecord"] = corrupt
    df = finite_numbers(spark.read.options(**options).schema(schema).csv(path))
    df = df.withColumn("timestamp", F.timestamp_seconds("UTC")).drop("_idx")
    return df.withColumn(ALARM, c(ALARM).cast("string")) if label_as_text else df


def read_plain_csv(spark: SparkSession, path: str | Sequence[str],
                   schema: T.StructType = READING_SCHEMA, recursive: bool = False) -> DataFrame:
    """Reading CSVs without index column."""
    return finite_numbers(spark.read.options(
        header=True, nullValue=NULL_MARKER, mode="PERMISSIVE",
        recursiveFileLookup=recursive).schema(schema).csv(path))


def read_day(spark: SparkSession, table_path: str, run_date: str, ds: str = "ds") -> DataFrame:
    """The day before ``run_date`` from a table partitioned by date; fails if it is empty."""
    day = recent_day(spark.read.parquet(table_path), run_date, ds)
    return require_rows(day, f"{table_path} for the day before {run_date}")


def csv_columns(spark: SparkSession, path: str) -> list[str]:
    """Header names without the leading index column; only the first line is read."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path).columns[1:]


def file_inventory(df: DataFrame, min_bytes: int = 1024) -> DataFrame:
    """Files behind a DataFrame: path, size, modification time, rows, whether large enough.

    Needs a DataFrame straight from a file source. Order by ``modified`` to get the
    newest first.
    """
    meta = df.select(F.col("_metadata.file_path").alias("path"),
                     F.col("_metadata.file_size").alias("size"),
                     F.col("_metadata.file_modification_time").alias("modified"))
    return meta.groupBy("path").agg(
        F.max("size").alias("size"), F.max("modified").alias("modified"),
        F.count(F.lit(1)).alias("rows"),
    ).withColumn("available", F.col("size") >= min_bytes)


def newest_file(inventory: DataFrame) -> DataFrame:
    return inventory.agg(F.max_by("path", F.struct("modified", "path")).alias("path"),
                         F.max("modified").alias("modified"))
