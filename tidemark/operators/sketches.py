"""Quantiles from stored sketches, one a series and day, merged when they are read.

``percentile_approx`` starts from the rows each time. A KLL sketch of ``k`` has a bounded size, merges with others, and its
quantiles have ranks within ``rank_error(k)`` of the asked one, however many sketches went into it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordering import GROUP_COLS, join_series

ACCURACY = 400
QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def rank_error(k: int = ACCURACY) -> float:
    """Twice the sketch's published error at 99 % confidence, which a sketch misses about once in four million times."""
    return 2 * 2.296 / k ** 0.9723


def daily_sketches(
    df: DataFrame, value: str, day: Column, by: Sequence[str] = GROUP_COLS, k: int = ACCURACY
) -> DataFrame:
    """``day, n, sketch`` of the values that are present; a table to store, of which a load writes its own days."""
    return df.filter(F.col(value).isNotNull()).groupBy(*by, day.alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(k)).alias("sketch"))


def merged(sketches: DataFrame, by: Sequence[str] = GROUP_COLS, k: int = ACCURACY) -> DataFrame:
    """One sketch for each key of ``by``, of any days; sketches of several loads of a day merge too."""
    return sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))


def quantiles(sketches: DataFrame, wanted: Mapping[str, float] = QUARTILES) -> DataFrame:
    """The wanted quantiles of each sketch as columns."""
    return sketches.select(
        *[c for c in sketches.columns if c != "sketch"],
        *[F.kll_sketch_get_quantile_double("sketch", F.lit(float(q))).alias(name) for name, q in wanted.items()])


def rank_distance(df: DataFrame, value: str, found: DataFrame, wanted: Mapping[str, float] = QUARTILES,
                  by: Sequence[str] = GROUP_COLS) -> DataFrame:
    """For each quantile of ``found``, how far its exact rank in ``df`` is from the asked one: one pass, for checking.

    A value that occurs often has a range of ranks; the distance is to the nearest of them.
    """
    rows = join_series(df.filter(F.col(value).isNotNull()).select(*by, value), found.select(*by, *wanted), list(by))
    parts = []
    for name in wanted:
        parts += [F.avg((F.col(value) < F.col(name)).cast("double")).alias(f"_{name}_from"),
                  F.avg((F.col(value) <= F.col(name)).cast("double")).alias(f"_{name}_to")]
    ranked = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *parts)
    return ranked.select(*by, "n", *[
        F.greatest(F.lit(0.0), F.col(f"_{name}_from") - q, q - F.col(f"_{name}_to")).alias(name) for name, q in wanted.items()])
