"""Lag features, chronological split and leak-free scaling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordering import GROUP_COLS, SeriesLayout, running_total, series_stats
from tidemark.operators.series import LAGS, add_lags, lag_names

TRAIN_RATIO = 0.80
TRAIN, TEST = "train", "test"


def lag_features(
    df: DataFrame, layout: SeriesLayout, value: str = "price", lags: Sequence[int] = LAGS, keep_index: bool = False
) -> DataFrame:
    """Lag columns, and only the rows whose every lag is present."""
    lagged = add_lags(df, layout, value, lags, keep_index=keep_index)
    return lagged.dropna(subset=lag_names(value, lags))


def tag_split(indexed: DataFrame, layout: SeriesLayout, ratio: float = TRAIN_RATIO) -> DataFrame:
    """``dataset_type``: the first ``floor(n * ratio)`` rows of a series train, the rest test.

    ``indexed`` carries the series index; lags are made before the split so that the
    first test rows may look back into training rows.
    """
    placed = running_total(indexed, layout, F.lit(1), "_position", "_total")
    is_train = F.col("_position") <= F.floor(F.col("_total") * F.lit(ratio)).cast("long")
    return placed.withColumn(
        "dataset_type", F.when(is_train, F.lit(TRAIN)).otherwise(F.lit(TEST))).drop("_position", "_total")


def train_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col("dataset_type") == TRAIN)


def test_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col("dataset_type") == TEST)


def split_features(
    df: DataFrame, layout: SeriesLayout, value: str = "price",
    lags: Sequence[int] = LAGS, ratio: float = TRAIN_RATIO,
) -> DataFrame:
    """Complete lag rows with their side of the split."""
    return tag_split(lag_features(df, layout, value, lags, keep_index=True), layout, ratio)


def scaling_stats(
    train: DataFrame, features: Sequence[str], by: Sequence[str] = GROUP_COLS
) -> DataFrame:
    """Mean and sample deviation of each feature; give it training rows only."""
    columns = []
    for name in features:
        columns += [F.avg(name).alias(f"{name}_mean"), F.stddev_samp(name).alias(f"{name}_std")]
    return train.groupBy(*by).agg(*columns)


def standardize(df: DataFrame, features: Sequence[str], layout: SeriesLayout) -> tuple[DataFrame, list[str]]:
    """``(x - mean) / std`` of a split table with its training statistics; 0 where there is no spread."""
    train, stats, scaled = F.col("dataset_type") == TRAIN, {}, {}
    for name in features:
        seen, std = F.when(train, F.col(name)), F.col(f"{name}_std")
        stats |= {f"{name}_mean": F.avg(seen), f"{name}_std": F.stddev_samp(seen)}
        scaled[f"{name}_scaled"] = F.when(std.isNull() | (std == 0), F.lit(0.0)).otherwise(
            F.try_divide(F.col(name) - F.col(f"{name}_mean"), std))
    return series_stats(df, stats, layout).withColumns(scaled), list(scaled)


def assemble(df: DataFrame, scaled: Sequence[str], output: str = "features") -> DataFrame:
    """The scaled columns as one vector column."""
    return VectorAssembler(inputCols=list(scaled), outputCol=output).transform(df)


def build_features(
    df: DataFrame, layout: SeriesLayout, value: str = "price",
    lags: Sequence[int] = LAGS, ratio: float = TRAIN_RATIO, vector: bool = False,
) -> DataFrame:
    """The feature table: series, time, value, lags, scaled lags, ``dataset_type``.

    Both sides of the split live in one frame, so the lag work is done once and a split
    is a filter. ``vector=True`` adds the assembled vector.
    """
    names = lag_names(value, lags)
    tagged = split_features(df, layout, value, lags, ratio)
    scaled, scaled_names = standardize(tagged, names, layout)
    extra = []
    if vector:
        scaled = assemble(scaled, scaled_names)
        extra = ["features"]
    keys = [c for c in (*layout.group_cols, "timestamp", *layout.order_cols, value) if c in df.columns]
    return scaled.select(*dict.fromkeys(keys), *names, *scaled_names, *extra, "dataset_type")


def select_final(df: DataFrame, value: str = "price", lags: Sequence[int] = LAGS) -> DataFrame:
    """The stored column list of a train or test table."""
    names = lag_names(value, lags)
    vector = ["features"] if "features" in df.columns else []
    return df.select("coin_id", "timestamp", "vs_currency", value,
                     *names, *[f"{n}_scaled" for n in names], *vector)
