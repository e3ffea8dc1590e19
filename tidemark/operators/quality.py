"""Data-quality reports: parsing, coverage, missing values, duplicates, cadence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import limited
from tidemark.functions.timestamps import parse_text
from tidemark.operators.ordering import GROUP_COLS
from tidemark.operators.series import EXPECTED_MINUTES


def parse_timestamps(df: DataFrame, text_col: str = "timestamp") -> DataFrame:
    """Keep the text as ``timestamp_raw`` and put the parsed value in ``timestamp``."""
    return df.withColumnRenamed(text_col, "timestamp_raw").withColumn(
        "timestamp", parse_text(F.col("timestamp_raw")))


def timestamp_parse_report(df: DataFrame) -> DataFrame:
    """Rows, missing text, and text that did not parse."""
    failed = F.col("timestamp_raw").isNotNull() & F.col("timestamp").isNull()
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("timestamp_raw").isNull()).alias("null_raw_timestamp"),
        F.count_if(failed).alias("failed_timestamp_parses"),
    )


def coverage(
    df: DataFrame, by: Sequence[str] = GROUP_COLS, time_col: str = "timestamp", distinct: bool = True,
    limit: int | None = None,
) -> DataFrame:
    """Rows, distinct timestamps, first and last timestamp per series."""
    columns = [F.count(F.lit(1)).alias("observations")]
    if distinct:
        columns.append(F.count_distinct(time_col).alias("unique_timestamps"))
    columns += [F.min(time_col).alias("start_timestamp"), F.max(time_col).alias("end_timestamp")]
    return limited(df.groupBy(*by).agg(*columns).orderBy(*by), limit)


def null_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The number of NULLs in each listed column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def duplicate_keys(df: DataFrame, keys: Sequence[str] = (*GROUP_COLS, "timestamp")) -> DataFrame:
    """Keys held by more than one row, with their number of rows."""
    return df.groupBy(*keys).count().filter(F.col("count") > 1)


def cadence_summary(
    intervals: DataFrame, by: Sequence[str] = GROUP_COLS, expected: float | None = EXPECTED_MINUTES,
    limit: int | None = None,
) -> DataFrame:
    """Number, mean, median, smallest and largest interval, and how many exceed the cadence."""
    minutes = F.col("interval_minutes")
    columns = [
        F.count(F.lit(1)).alias("intervals"),
        F.avg(minutes).alias("mean_minutes"),
        F.percentile_approx(minutes, 0.5).alias("median_minutes"),
        F.min(minutes).alias("min_minutes"),
        F.max(minutes).alias("max_minutes"),
    ]
    if expected is not None:
        columns.append(F.count_if(minutes > expected).alias("intervals_above_expected"))
    return limited(intervals.filter(minutes.isNotNull()).groupBy(*by).agg(*columns).orderBy(*by), limit)


def interval_frequency(
    intervals: DataFrame, by: Sequence[str] = GROUP_COLS, limit: int | None = None
) -> DataFrame:
    """How often each interval occurs, most frequent first within a coin."""
    counts = intervals.filter(F.col("interval_minutes").isNotNull()).groupBy(*by, "interval_minutes").count()
    return limited(counts.orderBy(by[0], F.desc("count"), *by[1:], "interval_minutes"), limit)
