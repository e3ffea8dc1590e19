"""A series at a regular cadence: the last known values as of each step."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from tidemark.operators.ordering import SeriesLayout, series_stats, with_lookback
from tidemark.operators.series import EXPECTED_MINUTES

MICROS = 60_000_000
# Steps of a gap that one row is cut into before they become rows.
STEPS_AT_ONCE = 4_096


def regular_grid(
    df: DataFrame, layout: SeriesLayout, values: Sequence[str] = ("price",), minutes: int = EXPECTED_MINUTES,
    time_col: str = "timestamp",
) -> DataFrame:
    """``grid_timestamp``, the ``values`` as of it and ``micros_old``, from a series' first step to its last row.

    Steps are whole multiples of the cadence since 1970. Each row looks back at the row before it and gives the steps from there
    to itself, so no row is joined with another one, whatever the gap; of rows at one time the last counts. A gap
    is cut into stretches first, so that no array is longer than STEPS_AT_ONCE or than the number of stretches. Rows
    without a time have no place on the grid.
    """
    group, step = list(layout.group_cols), minutes * MICROS
    at = F.unix_micros(F.col(time_col).cast("timestamp"))
    rows = df.filter(F.col(time_col).isNotNull()).withColumn("_micros", at)
    # The last row's own time is a step that no later row gives.
    rows = series_stats(rows, {"_end": F.max("_micros")}, layout)

    def look_back(frame: DataFrame, window: WindowSpec) -> DataFrame:
        return frame.withColumns({
            "_previous": F.lag("_micros").over(window), **{f"_last_{v}": F.lag(v).over(window) for v in values}})

    looked = with_lookback(rows, layout, 1, look_back)
    gap = looked.filter(F.col("_previous").isNotNull()).select(
        *group, F.col("_previous").alias("_seen"), *[F.col(f"_last_{v}").alias(v) for v in values],
        _ceil("_previous", step).alias("_low"), (_ceil("_micros", step) - 1).alias("_high"))
    latest = looked.filter((F.col("_micros") == F.col("_end")) & (F.pmod("_micros", F.lit(step)) == 0))
    order = F.struct(*layout.order_cols)
    last = latest.groupBy(*group).agg(F.max(F.struct(order.alias("o"), "_micros", *values)).alias("l")).select(
        *group, F.col("l._micros").alias("_seen"), *[F.col(f"l.{v}").alias(v) for v in values],
        F.expr(f"l._micros div {step}").alias("_low"), F.expr(f"l._micros div {step}").alias("_high"))
    stretches = gap.unionByName(last).filter(F.col("_low") <= F.col("_high")).withColumn(
        "_stretch", F.explode(F.sequence(F.floor(F.col("_low") / STEPS_AT_ONCE), F.floor(F.col("_high") / STEPS_AT_ONCE))))
    steps = stretches.withColumn("_step", F.explode(F.sequence(
        F.greatest("_low", F.col("_stretch") * STEPS_AT_ONCE), F.least("_high", (F.col("_stretch") + 1) * STEPS_AT_ONCE - 1))))
    return steps.select(
        *group, F.timestamp_micros(F.col("_step") * step).cast("timestamp_ntz").alias("grid_timestamp"), *values,
        (F.col("_step") * step - F.col("_seen")).alias("micros_old"))


def _ceil(column: str, step: int) -> Column:
    """The first multiple of ``step`` that is not before ``column``, in steps; whole numbers only."""
    whole, rest = F.expr(f"{column} div {step}"), F.pmod(F.col(column), F.lit(step))
    below = (F.col(column) - rest) / step
    return (F.when(rest == 0, whole).otherwise(below.cast("long") + 1)).cast("long")
