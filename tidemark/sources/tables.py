"""Tables in layered namespaces."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LAYERS = ("raw", "processed", "features", "models")
SERIES_COLUMNS = ("coin_id", "timestamp", "vs_currency", "price")
# Partitions that are chosen one by one; beyond, all in the range they span are.
PARTITIONS_LISTED = 1_000


def layer_name(prefix: str, layer: str) -> str:
    """Database of a layer; the prefix separates environments such as dev and prd."""
    return f"{prefix}_{layer}" if prefix else layer


def create_layers(spark: SparkSession, prefix: str = "") -> list[str]:
    names = [layer_name(prefix, layer) for layer in LAYERS]
    for name in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")
    return names


def load_source(
    spark: SparkSession, table: str, columns: Sequence[str] | None = SERIES_COLUMNS
) -> DataFrame:
    """A table scan that reads the listed columns only."""
    df = spark.table(table)
    return df if columns is None else df.select(*columns)


def save_table(
    df: DataFrame,
    table: str,
    comment: str | None = None,
    partition_by: Sequence[str] = (),
    path: str | None = None,
) -> DataFrame:
    """Create the table or replace it, contents and schema, and read it back."""
    writer = df.write.format("parquet").mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    spark = df.sparkSession
    if comment:
        quoted = comment.replace("\\", "\\\\").replace("'", "\\'")
        name = ".".join(f"`{part}`" for part in table.split("."))
        spark.sql(f"COMMENT ON TABLE {name} IS '{quoted}'")
    return spark.table(table)


def replace_from_query(spark: SparkSession, table: str, query: str, comment: str | None = None) -> DataFrame:
    """Create or replace ``table`` from a SQL query."""
    return save_table(spark.sql(query), table, comment)


def row_count(df: DataFrame) -> DataFrame:
    """The number of rows, as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def path_exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def touched(stored: DataFrame, column: str, values: DataFrame, limit: int = PARTITIONS_LISTED) -> DataFrame:
    """Partitions of ``stored`` whose ``column`` is among ``values``, chosen before anything is read.

    Few values are listed, so that other partitions are never opened; beyond ``limit`` it is the range they span.
    """
    distinct = values.select(column).distinct()
    found = [row[0] for row in distinct.limit(limit + 1).collect()]
    if len(found) > limit:
        low, high = distinct.agg(F.min(column), F.max(column)).first()
        return stored.filter(F.col(column).between(low, high))
    return stored.filter(F.col(column).isin(found))
