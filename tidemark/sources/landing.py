"""Landed text files as rows with file metadata and load time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FILE_METADATA = ("file_path", "file_name", "file_size", "file_modification_time")


def raw_columns(etl_timestamp: Column | None = None) -> list[Column]:
    """The raw table's columns over a text scan."""
    loaded = F.current_timestamp() if etl_timestamp is None else etl_timestamp
    return [
        loaded.alias("etl_timestamp"),
        F.col("value").alias("data"),
        *[F.col(f"_metadata.{name}").alias(name) for name in FILE_METADATA],
    ]


def scan_landing(spark: SparkSession, path: str, etl_timestamp: Column | None = None) -> DataFrame:
    """One row per text line of every file under ``path``."""
    return spark.read.option("recursiveFileLookup", "true").text(path).select(*raw_columns(etl_timestamp))


def peek_with_file(df: DataFrame, n: int = 10, order_by: Sequence[str] = ()) -> DataFrame:
    """``n`` rows with the file each came from: the first by ``order_by``, or any."""
    rows = df.select("*", F.col("_metadata.file_path").alias("file_path"))
    return (rows.orderBy(*order_by) if order_by else rows).limit(n)
