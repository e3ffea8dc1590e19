"""Keyed incremental ingest: a run parses the files that no earlier run has taken, and adds the points it has not seen.

The file source's checkpoint remembers files. What has been seen is the table itself: its rows are stored by the day of the
point, and a run looks up its keys only in the days that its own points touch, so a run costs what its files and
those days hold, whatever the age of the table. A point with another price at the same time is a key of its own, that is, a
correction, and is added.

Each micro-batch writes one ``batch=`` folder. A batch that is run again after a failure replaces its folder and does not see its
own rows, so a restart adds nothing twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.dedup import CHART_KEY, OHLC_KEY
from tidemark.operators.parse import parse_chart, parse_ohlc
from tidemark.session import materialize, scratch_scope
from tidemark.sources.tables import path_exists, touched
from tidemark.streaming.landing import landing_stream

DAY_MS = 86_400_000
BATCH, DAY = "batch", "day"


def unseen(rows: DataFrame, stored: DataFrame, key: Sequence[str]) -> DataFrame:
    """``rows`` whose key is not in ``stored``; a missing part of a key is a value like any other."""
    names = [f"_seen_{k}" for k in key]
    seen = stored.select(*[F.col(k).alias(n) for k, n in zip(key, names)])
    match: Column = F.lit(True)
    for k, n in zip(key, names):
        match = match & F.col(k).eqNullSafe(F.col(n))
    return rows.join(seen, match, "left_anti")


def add_batch(raw: DataFrame, batch: int, target: str, parse: Callable[[DataFrame], DataFrame], key: Sequence[str]) -> None:
    """Parse the raw rows of one micro-batch and write those of its points that ``target`` does not hold."""
    spark = raw.sparkSession
    with scratch_scope(spark):
        day = F.floor(F.col("timestamp_unix_ms") / DAY_MS).cast("int").alias(DAY)
        rows = materialize(parse(raw).select("*", day), "parsed")
        if path_exists(spark, target):
            before = spark.read.parquet(target).filter(F.col(BATCH) != batch)
            rows = materialize(unseen(rows, touched(before, DAY, rows), key), "unseen")
        if rows.isEmpty():
            return
        # Rows of a day lie together; adaptive execution splits a day that holds too many.
        rows.hint("rebalance", DAY).write.mode("overwrite").partitionBy(DAY).parquet(f"{target}/{BATCH}={batch}")


def ingest_new(
    spark: SparkSession, path: str, target: str, checkpoint: str, parse: Callable[[DataFrame], DataFrame],
    key: Sequence[str], files_per_batch: int | None = None,
) -> StreamingQuery:
    """Take all files that arrived under ``path`` since the last run, then stop."""
    return (
        landing_stream(spark, path, files_per_batch).writeStream
        .foreachBatch(lambda raw, batch: add_batch(raw, batch, target, parse, key))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def ingest_chart(
    spark: SparkSession, path: str, target: str, checkpoint: str, files_per_batch: int | None = None
) -> StreamingQuery:
    """Chart points by (series, millisecond, price). Market cap and volume come from the point's own file,
    which is always taken whole."""
    return ingest_new(spark, path, target, checkpoint, parse_chart, CHART_KEY, files_per_batch)


def ingest_ohlc(
    spark: SparkSession, path: str, target: str, checkpoint: str, files_per_batch: int | None = None
) -> StreamingQuery:
    """OHLC records by (series, millisecond, four prices)."""
    return ingest_new(spark, path, target, checkpoint, parse_ohlc, OHLC_KEY, files_per_batch)


def ingested(spark: SparkSession, target: str) -> DataFrame:
    """The table's rows with the ``batch`` that added each."""
    return spark.read.parquet(target).drop(DAY)
