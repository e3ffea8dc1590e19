"""Incremental landing: only files that no earlier run has taken."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql import types as T

from tidemark.sources.landing import raw_columns

TEXT = T.StructType([T.StructField("value", T.StringType())])


def landing_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """The raw table's rows as files arrive under ``path``; no state is kept."""
    reader = spark.readStream.format("text").schema(TEXT).option("recursiveFileLookup", "true")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    return reader.load(path).select(*raw_columns())


def land_new_files(
    spark: SparkSession, path: str, target: str, checkpoint: str, files_per_batch: int | None = None
) -> StreamingQuery:
    """Append the rows of new files to the Parquet folder ``target``, then stop.

    ``checkpoint`` remembers the files taken; with the file sink each is written once.
    """
    return (
        landing_stream(spark, path, files_per_batch).writeStream.format("parquet").outputMode("append")
        .option("path", target).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
