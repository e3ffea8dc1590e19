"""Counts, means and centred cross-products that can be stored, merged and turned into scaling, models and limits.

A part is one row: ``n``, ``means`` (one a variable) and ``products``, the sums of centred products of variables i <= j in
row order. Parts merge exactly: products of the merged mean are those of the parts plus ``n`` times the product of the
distances of their means. No squares of raw values are added up, so large means do not cost digits.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.statistics import solve_centred
from tidemark.operators.monitoring import with_lines
from tidemark.operators.ordering import GROUP_COLS, join_series


def pairs(k: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(k) for j in range(i, k)]


def part_moments(rows: DataFrame, variables: Sequence[str], by: Sequence[str] = GROUP_COLS) -> DataFrame:
    """One part for each key of ``by``, of rows in which all variables are present."""
    rows = rows.dropna(subset=list(variables))
    product = [F.covar_pop(variables[i], variables[j]) * F.count(F.lit(1)) for i, j in pairs(len(variables))]
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.avg(v) for v in variables]).alias("means"), F.array(*product).alias("products"))


def merge_moments(parts: DataFrame, by: Sequence[str] = GROUP_COLS) -> DataFrame:
    """Parts of the same key as one part. Any number of parts merges in one aggregation, and the result merges again."""
    size = parts.select(F.size("means").alias("k")).filter("k > 0").first()
    k = size["k"] if size else 0
    parts = parts.filter(F.col("n") > 0)
    weighted = [F.sum(F.get("means", F.lit(i)) * F.col("n")) / F.sum("n") for i in range(k)]
    whole = parts.groupBy(*by).agg(F.array(*weighted).alias("_whole"))
    apart = join_series(parts, whole, list(by)).withColumn(
        "_apart", F.zip_with("means", "_whole", lambda part, all_: part - all_))

    def between(i: int, j: int) -> Column:
        return F.sum(F.get("products", F.lit(at[i, j])) + F.col("n") * F.get("_apart", F.lit(i)) * F.get("_apart", F.lit(j)))

    at = {pair: place for place, pair in enumerate(pairs(k))}
    return apart.groupBy(*by).agg(
        F.sum("n").alias("n"), F.first("_whole").alias("means"), F.array(*[between(i, j) for i, j in pairs(k)]).alias("products"))


def _product(k: int, i: int, j: int) -> Column:
    return F.get("products", F.lit(pairs(k).index((min(i, j), max(i, j)))))


def scaling_from(moments: DataFrame, features: Sequence[str], by: Sequence[str] = GROUP_COLS) -> DataFrame:
    """Mean and sample deviation of each feature; the variables are the features and the label."""
    k = len(features) + 1
    columns = []
    for i, name in enumerate(features):
        columns += [F.get("means", F.lit(i)).alias(f"{name}_mean"),
                    F.when(F.col("n") > 1, F.sqrt(_product(k, i, i) / (F.col("n") - 1))).alias(f"{name}_std")]
    return moments.select(*by, *columns)


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _solve(cross: pd.Series, target: pd.Series, means: pd.Series, label_mean: pd.Series) -> pd.Series:
    return solve_centred(cross, target, means, label_mean)


def fit_from(moments: DataFrame, features: Sequence[str], by: Sequence[str] = GROUP_COLS) -> DataFrame:
    """Least squares on the scaled features: ``train_rows, intercept, coefficients`` and the residuals' moments.

    A feature without spread scales to 0 everywhere, as it does in rows.
    """
    count, k = len(features), len(features) + 1
    n = F.col("n")

    def scaled(total: Column, *which: int) -> Column:
        for i in which:
            deviation = F.sqrt(_product(k, i, i) / (n - 1))
            total = F.when((n > 1) & (deviation > 0), total / deviation).otherwise(F.lit(0.0))
        return total

    cross = [scaled(_product(k, i, j) / n, i, j) for i in range(count) for j in range(count)]
    target = [scaled(_product(k, i, count) / n, i) for i in range(count)]
    solved = moments.select(
        *by, "n", (_product(k, count, count) / n).alias("_label"), F.array(*cross).alias("_cross"), F.array(*target).alias("_target"),
        F.get("means", F.lit(count)).alias("_mean"))
    solved = solved.withColumn("_solution", _solve("_cross", "_target", F.array(*[F.lit(0.0)] * count), F.col("_mean")))
    slope = [F.get("_solution", F.lit(i + 1)) for i in range(count)]
    # Variance of what the model leaves, from the same moments.
    left = F.col("_label")
    for i in range(count):
        left = left - 2 * slope[i] * F.get("_target", F.lit(i))
        for j in range(count):
            left = left + slope[i] * slope[j] * F.get("_cross", F.lit(i * count + j))
    return solved.select(
        *by, F.col("n").alias("train_rows"), F.get("_solution", F.lit(0)).alias("intercept"),
        F.slice("_solution", 2, count).alias("coefficients"), F.lit(0.0).alias("residual_mean"),
        F.when(n > 1, F.sqrt(F.greatest(left, F.lit(0.0)) * n / (n - 1))).alias("residual_std"))


def limits_from(fitted: DataFrame, by: Sequence[str] = GROUP_COLS) -> DataFrame:
    """Control lines of the training residuals, without reading them: with an intercept their mean is 0."""
    return with_lines(fitted.select(*by, "residual_mean", "residual_std"))
