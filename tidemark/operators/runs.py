"""Run rules of control charts, and drift between the residuals of the two sides of the split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.operators.features import TEST, TRAIN
from tidemark.operators.ordering import (
    BLOCK, GROUP_COLS, INDEX, SeriesLayout, join_series, number_rows, running_total, series_stats, with_lookback,
)
from tidemark.session import materialize

# Fixed values: (points beyond, of so many, deviations) on one side, and points in a row on one side of the mean.
NEAR_RULES = {"two_of_three": (2, 3, 2), "four_of_five": (4, 5, 1)}
SIDE_RUN = 8
RULES = ("beyond_3_sigma", *NEAR_RULES, "eight_on_side")
RUN_ORDER = ("timestamp", "price", "residual")
# Terms of the Kolmogorov series, and where it is 1 to all digits.
TERMS, SMALL_LAMBDA = 100, 0.2


def side_of_mean() -> Column:
    """1 above the residual mean, -1 below, 0 on it or without a residual."""
    return F.coalesce(F.signum(F.col("residual") - F.col("residual_mean")), F.lit(0.0)).cast("int")


def last_index(df: DataFrame, layout: SeriesLayout, mark: Column, name: str) -> DataFrame:
    """Add the index of the last row up to each row on which ``mark`` holds, for rows with a series index.

    Short series: one window. Long ones: a window in each block, and the last marked index of all blocks before it.
    """
    group = list(layout.group_cols)
    here = F.max(F.when(mark, F.col(INDEX)))
    if not layout.blocked:
        return df.withColumn(name, here.over(Window.partitionBy(*group).orderBy(INDEX)))
    size = layout.rows_per_block
    stored = materialize(df, "marks").withColumn(BLOCK, F.floor(F.col(INDEX) / size).cast("long"))
    earlier = Window.partitionBy(*group).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    carried = stored.groupBy(*group, BLOCK).agg(here.alias("_last")).select(
        *group, BLOCK, F.max("_last").over(earlier).alias("_carried"))
    small = layout.fits_broadcast(carried, layout.series + layout.rows // size)
    inside = stored.withColumn("_inside", here.over(Window.partitionBy(*group, BLOCK).orderBy(INDEX)))
    return join_series(inside, carried, [*group, BLOCK], small=small).withColumn(
        name, F.coalesce("_inside", "_carried")).drop("_inside", "_carried", BLOCK)


def control_runs(forecasts: DataFrame, layout: SeriesLayout) -> DataFrame:
    """Forecasts with ``side_run`` (points in a row on this side of the mean, up to here) and the rules each point breaks.

    A point breaks ``two_of_three`` if it is the second or third of two among three points in a row that lie beyond 2
    deviations on one side; likewise the others. ``layout`` gives the series and their total order.
    """
    by_order = layout.ordered_by(*RUN_ORDER) if tuple(layout.order_cols) != RUN_ORDER else layout
    away = F.col("residual") - F.col("residual_mean")
    longest = max(of for _, of, _ in NEAR_RULES.values())

    def near(frame: DataFrame, window: WindowSpec) -> DataFrame:
        columns = {"_before": F.lag("_side").over(window)}
        for name, (points, of, deviations) in NEAR_RULES.items():
            trailing = window.rowsBetween(-(of - 1), 0)
            for sign, label in ((1, "above"), (-1, "below")):
                beyond = F.when(F.coalesce(sign * away > deviations * F.col("residual_std"), F.lit(False)), 1).otherwise(0)
                columns[f"_{name}_{label}"] = (beyond == 1) & (F.sum(beyond).over(trailing) >= points)
        return frame.withColumns(columns)

    looked = with_lookback(forecasts.withColumn("_side", side_of_mean()), by_order, longest - 1, near, keep_index=True)
    if INDEX not in looked.columns:
        looked = number_rows(looked, by_order)
    begins = F.col("_before").isNull() | (F.col("_before") != F.col("_side"))
    placed = last_index(looked, by_order, begins, "_begin")
    run = F.when(F.col("_side") != 0, F.col(INDEX) - F.col("_begin") + 1).otherwise(F.lit(0).cast("long"))
    flags = {name: F.col(f"_{name}_above") | F.col(f"_{name}_below") for name in NEAR_RULES}
    return placed.withColumn("side_run", run).select(
        *forecasts.columns, "side_run",
        F.coalesce(F.abs(away) > 3 * F.col("residual_std"), F.lit(False)).alias("beyond_3_sigma"),
        *[flag.alias(name) for name, flag in flags.items()], (F.col("side_run") >= SIDE_RUN).alias("eight_on_side"))


def run_summary(runs: DataFrame, by: Sequence[str] = (*GROUP_COLS, "dataset_type")) -> DataFrame:
    """Points that break each rule, and the longest run on one side."""
    return runs.groupBy(*by).agg(
        F.count(F.lit(1)).alias("observations"), *[F.count_if(F.col(rule)).alias(rule) for rule in RULES],
        F.max("side_run").alias("longest_side_run"))


def two_sample_p_value(statistic: Column, n: Column, m: Column) -> Column:
    """Kolmogorov's p-value with the usual correction for finite samples."""
    root = F.sqrt(n * m / (n + m))
    lam = (root + 0.12 + 0.11 / root) * statistic
    terms = F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), F.lit(0.0),
                        lambda total, k: total + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2 * k * k * lam * lam))
    return F.when(lam < SMALL_LAMBDA, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2 * terms)))


def drift(forecasts: DataFrame, layout: SeriesLayout, value: str = "residual", alpha: float = 0.05) -> DataFrame:
    """The two-sample Kolmogorov-Smirnov test of ``value`` between the training and the test rows of each series.

    Equal values are counted first. In their order, each adds its share of the training rows and takes its share of
    the test rows; the greatest distance of that running sum from 0 is the statistic. One ordered pass, by the route
    for long series where values are too many for one task. A series without one of the sides has NULLs.
    """
    group = list(layout.group_cols)
    counted = forecasts.filter(F.col(value).isNotNull()).groupBy(*group, value).agg(
        F.count_if(F.col("dataset_type") == TRAIN).alias("_train"), F.count_if(F.col("dataset_type") == TEST).alias("_test"))
    by_value = layout.ordered_by(value)
    sized = series_stats(counted, {"n_train": F.sum("_train"), "n_test": F.sum("_test")}, by_value)
    step = (F.coalesce(F.try_divide(F.col("_train"), F.col("n_train")), F.lit(0.0))
            - F.coalesce(F.try_divide(F.col("_test"), F.col("n_test")), F.lit(0.0)))
    summed = running_total(number_rows(sized, by_value), by_value, step, "_gap", "_rest")
    found = summed.groupBy(*group).agg(
        F.first("n_train").alias("n_train"), F.first("n_test").alias("n_test"), F.max(F.abs("_gap")).alias("_d"))
    both = (F.col("n_train") > 0) & (F.col("n_test") > 0)
    tested = found.withColumn("ks_statistic", F.when(both, F.col("_d"))).withColumn(
        "p_value", F.when(both, two_sample_p_value(F.col("ks_statistic"), F.col("n_train"), F.col("n_test"))))
    return tested.select(*group, "n_train", "n_test", "ks_statistic", "p_value", (F.col("p_value") < alpha).alias("drift"))
