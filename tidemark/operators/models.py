"""One linear model per series, fitted for all series in one grouped job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.statistics import solve_centred
from tidemark.operators.features import TEST, TRAIN, test_rows, train_rows
from tidemark.operators.monitoring import FORECAST_COLUMNS, add_limits, control_limits
from tidemark.operators.ordering import GROUP_COLS, SeriesLayout, attach_stats
from tidemark.operators.series import LAGS, lag_names

MODEL_TYPE = "linear_regression"


def scaled_names(value: str = "price", lags: Sequence[int] = LAGS) -> list[str]:
    return [f"{n}_scaled" for n in lag_names(value, lags)]


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _solve(cross: pd.Series, target: pd.Series, means: pd.Series, label_mean: pd.Series) -> pd.Series:
    return solve_centred(cross, target, means, label_mean)


def fit_models(
    train: DataFrame, features: Sequence[str], label: str = "price", by: Sequence[str] = GROUP_COLS
) -> DataFrame:
    """Ordinary least squares per series: ``intercept`` and ``coefficients``.

    The rows reduce to centred second moments in one aggregation with partial sums, so a
    series of any length costs one small record; only that record reaches Python, which
    solves the few-by-few system (minimum norm where columns are dependent).
    """
    names = list(features)
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    moments = train.filter(F.col(label).isNotNull()).groupBy(*by).agg(
        F.count(F.lit(1)).alias("train_rows"),
        F.avg(label).alias("_label_mean"),
        *[F.avg(n).alias(f"_mean_{i}") for i, n in enumerate(names)],
        *[F.covar_pop(names[i], names[j]).alias(f"_cross_{i}_{j}") for i, j in pairs],
        *[F.covar_pop(n, label).alias(f"_target_{i}") for i, n in enumerate(names)],
    )
    k = range(len(names))
    cross = F.array(*[F.col(f"_cross_{min(i, j)}_{max(i, j)}") for i in k for j in k])
    solved = moments.select(
        *by, "train_rows",
        _solve(cross, F.array(*[f"_target_{i}" for i in k]),
               F.array(*[f"_mean_{i}" for i in k]), F.col("_label_mean")).alias("_solution"),
    )
    return solved.select(
        *by, "train_rows", F.get("_solution", F.lit(0)).alias("intercept"),
        F.slice("_solution", 2, len(names)).alias("coefficients"))


def predict(
    rows: DataFrame, models: DataFrame, features: Sequence[str], layout: SeriesLayout, label: str = "price"
) -> DataFrame:
    """``prediction`` and ``residual`` of every row from its series' model."""
    slopes = {f"_slope_{i}": F.get("coefficients", F.lit(i)) for i in range(len(features))}
    columns = [F.col("intercept").alias("_intercept"), *[c.alias(n) for n, c in slopes.items()]]
    scored = attach_stats(rows, models.select(*layout.group_cols, *columns), layout)
    prediction = F.col("_intercept")
    for slope, name in zip(slopes, features):
        prediction = prediction + F.col(slope) * F.col(name)
    return (
        scored.withColumn("prediction", prediction)
        .withColumn("residual", F.col(label) - F.col("prediction"))
        .drop("_intercept", *slopes)
    )


def series_status(features: DataFrame, by: Sequence[str] = GROUP_COLS) -> DataFrame:
    """Train and test rows per series and whether a model can be fitted and tested."""
    counts = features.groupBy(*by).agg(
        F.count_if(F.col("dataset_type") == TRAIN).alias("train_rows"),
        F.count_if(F.col("dataset_type") == TEST).alias("test_rows"),
    )
    return counts.withColumn(
        "status",
        F.when(F.col("train_rows") == 0, "no_train").when(F.col("test_rows") == 0, "no_test").otherwise("ok"))


def require_complete(status: DataFrame) -> None:
    """Raise if a series has no training or no test rows."""
    bad = status.filter(F.col("status") != "ok").first()
    if bad is not None:
        raise ValueError(f"{bad['status']} rows for {bad['coin_id']}/{bad['vs_currency']}")


def score_all(
    features: DataFrame, layout: SeriesLayout, value: str = "price", lags: Sequence[int] = LAGS
) -> tuple[DataFrame, DataFrame]:
    """Models of all series that have training rows, and predictions of all rows; rows of a
    series without a model get NULL (``series_status`` names such series)."""
    names = scaled_names(value, lags)
    models = fit_models(train_rows(features), names, value, layout.group_cols)
    predictions = predict(features, models, names, layout, value)
    return models, predictions


def forecasts(predictions: DataFrame, layout: SeriesLayout) -> DataFrame:
    """Train and test predictions with the control limits of the training residuals."""
    limits = control_limits(train_rows(predictions), layout.group_cols)
    return add_limits(predictions, limits, layout).select(*FORECAST_COLUMNS)


def regression_metrics(
    predictions: DataFrame, by: Sequence[str] = GROUP_COLS, label: str = "price"
) -> DataFrame:
    """RMSE, MAE and R2 per series in one pass; R2 is NULL for a constant label."""
    squared = F.avg(F.col("residual") * F.col("residual"))
    return predictions.groupBy(*by).agg(
        F.sqrt(squared).alias("rmse"),
        F.avg(F.abs("residual")).alias("mae"),
        (1 - F.try_divide(squared, F.var_pop(label))).alias("r2"),
    )


def model_performance(
    predictions: DataFrame, model_base: str = "models", label: str = "price"
) -> DataFrame:
    """One row per series: row counts, metrics of the test rows, and the model's path."""
    by = list(GROUP_COLS)
    test = F.col("dataset_type") == TEST
    residual = F.when(test, F.col("residual"))
    squared = F.avg(residual * residual)
    return predictions.groupBy(*by).agg(
        F.count_if(F.col("dataset_type") == TRAIN).alias("train_rows"),
        F.count_if(test).alias("test_rows"),
        F.sqrt(squared).alias("rmse"),
        F.avg(F.abs(residual)).alias("mae"),
        (1 - F.try_divide(squared, F.var_pop(F.when(test, F.col(label))))).alias("r2"),
    ).select(
        *by, F.lit(MODEL_TYPE).alias("model_type"), "train_rows", "test_rows", "rmse", "mae", "r2",
        F.concat_ws("", F.lit(f"{model_base}/"), F.col("coin_id"), F.lit("_"), F.col("vs_currency"),
                    F.lit(f"_{MODEL_TYPE}")).alias("model_path"),
    )


def single_model(
    features: DataFrame, layout: SeriesLayout, key: Mapping[str, str],
    value: str = "price", lags: Sequence[int] = LAGS, path: str | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Coefficients, forecasts and test metrics of one series, by the grouped fit over its rows alone.

    ``key`` gives the series' columns, e.g. coin and currency. ``path`` stores the coefficients, replacing what
    is there. A series that lacks a side of the split is an error.
    """
    rows = features
    for column, wanted in key.items():
        rows = rows.filter(F.col(column).eqNullSafe(F.lit(wanted)))
    state = series_status(rows, list(key)).first()
    if state is None or state["status"] != "ok":
        raise ValueError(f"{'/'.join(map(str, key.values()))}: {state['status'] if state else 'no rows'}")
    fitted, predictions = score_all(rows, layout, value, lags)
    if path is not None:
        fitted.write.mode("overwrite").parquet(path)
    return fitted, forecasts(predictions, layout), regression_metrics(test_rows(predictions), list(key), value)
