"""The data behind the dashboards."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.dedup import keep_one
from tidemark.operators.monitoring import is_beyond_limits

DASH_KEY = ("coin_id", "timestamp")
CONTROL_CHART_COLUMNS = (
    "coin_id", "timestamp", "vs_currency", "dataset_type", "residual", "residual_mean",
    "lower_1_sigma", "upper_1_sigma", "lower_2_sigma", "upper_2_sigma", "lcl", "ucl")


def _as_timestamp(df: DataFrame) -> DataFrame:
    if dict(df.dtypes)["timestamp"] != "string":
        return df
    return df.withColumn("timestamp", F.col("timestamp").try_cast("timestamp"))


def selected(
    df: DataFrame, coins: Iterable[str] | None = None, start: object | None = None, end: object | None = None
) -> DataFrame:
    """Dashboard filters: chosen coins, and an inclusive time range."""
    for condition in filter_conditions(coins, start, end).values():
        df = df.filter(condition)
    return df


def filter_conditions(
    coins: Iterable[str] | None = None, start: object | None = None, end: object | None = None
) -> dict[str, Column]:
    """The conditions a selection puts on each column."""
    conditions: dict[str, Column] = {}
    if coins is not None:
        conditions["coin_id"] = F.col("coin_id").isin(list(coins))
    if start is not None or end is not None:
        time = F.lit(True)
        if start is not None:
            time = time & (F.col("timestamp") >= F.lit(start))
        if end is not None:
            time = time & (F.col("timestamp") <= F.lit(end))
        conditions["timestamp"] = time
    return conditions


def ohlc_dataset(
    df: DataFrame, keys: Sequence[str] = DASH_KEY, keep: str = "first", sort: bool = True
) -> DataFrame:
    """One candle per coin and time, the earliest load, with its rank column."""
    rows = _as_timestamp(df).filter(F.col("timestamp").isNotNull()).select(
        "coin_id", "timestamp", "open_price", "high_price", "low_price", "close_price", "vs_currency", "etl_timestamp")
    kept = keep_one(rows, keys, ("etl_timestamp",), keep, rank_col="rn")
    return kept.orderBy("timestamp", "coin_id") if sort else kept


def history_dataset(
    df: DataFrame, keys: Sequence[str] = DASH_KEY, keep: str = "last", sort: bool = True
) -> DataFrame:
    """One price row per coin and time, the latest load, with its rank column."""
    rows = _as_timestamp(df).filter(F.col("timestamp").isNotNull()).select(
        "coin_id", "timestamp", "price", "market_cap", "total_volume", "vs_currency", "etl_timestamp")
    kept = keep_one(rows, keys, ("etl_timestamp",), keep, rank_col="rn").drop("etl_timestamp")
    return kept.orderBy("timestamp", "coin_id") if sort else kept


def candles(ohlc: DataFrame) -> DataFrame:
    """Candlestick feed; a candle is up when it closes at or above its opening."""
    return ohlc.select(
        "coin_id", "timestamp", "open_price", "high_price", "low_price", "close_price",
        F.when(F.col("open_price") <= F.col("close_price"), "up").otherwise("down").alias("direction"))


def price_cards(history: DataFrame, tie: Sequence[str] = ("coin_id", "vs_currency", "price")) -> DataFrame:
    """Latest, average, lowest and highest price of the rows shown."""
    return history.agg(
        F.max_by("price", F.struct("timestamp", *tie)).alias("current_price"),
        F.avg("price").alias("average_price"),
        F.min("price").alias("minimum_price"),
        F.max("price").alias("maximum_price"),
    )


def line_series(history: DataFrame, value: str, name: str) -> DataFrame:
    """Sum of a value by timestamp, in time order."""
    return history.groupBy("timestamp").agg(F.sum(value).alias(name)).orderBy("timestamp")


def filter_facet(
    df: DataFrame, column: str, coins: Iterable[str] | None = None,
    start: object | None = None, end: object | None = None,
) -> DataFrame:
    """Each value of a filter column with the rows the other filters leave it."""
    others = [c for name, c in filter_conditions(coins, start, end).items() if name != column]
    passes = F.lit(True)
    for condition in others:
        passes = passes & condition
    return df.groupBy(column).agg(F.count_if(passes).alias(f"{column}_associativity"))


def control_chart(forecasts: DataFrame) -> DataFrame:
    return forecasts.select(*CONTROL_CHART_COLUMNS).orderBy("timestamp", "coin_id", "vs_currency")


def control_cards(forecasts: DataFrame) -> DataFrame:
    """Number of rows and of rows beyond the control limits."""
    return forecasts.agg(
        F.count(F.lit(1)).alias("total_observations"),
        F.count_if(is_beyond_limits()).alias("out_of_control_points"),
    )
