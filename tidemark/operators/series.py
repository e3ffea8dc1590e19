"""Lags, returns, intervals, rolling statistics and plain views of series."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from tidemark.functions.columns import limited
from tidemark.functions.timestamps import minutes_between
from tidemark.operators.ordering import GROUP_COLS, SeriesLayout, with_lookback

# Fixed values of the workload.
LAGS = (1, 2, 3, 6, 12)
ROLLING_ROWS = 12
EXPECTED_MINUTES = 5


def lag_names(value: str, lags: Sequence[int] = LAGS) -> list[str]:
    return [f"{value}_lag_{k}" for k in lags]


def add_lags(
    df: DataFrame,
    layout: SeriesLayout,
    value: str = "price",
    lags: Sequence[int] = LAGS,
    prefix: str | None = None,
    keep_index: bool = False,
) -> DataFrame:
    """Values of ``value`` the given numbers of rows (not of minutes) earlier."""
    names = lag_names(prefix or value, lags)

    def columns(frame: DataFrame, window: WindowSpec) -> DataFrame:
        return frame.withColumns({n: F.lag(value, k).over(window) for n, k in zip(names, lags)})

    return with_lookback(df, layout, max(lags), columns, keep_index)


def add_returns(df: DataFrame, layout: SeriesLayout, value: str = "price") -> DataFrame:
    """Previous value, change and percent return; NULL where the previous value is zero."""

    def columns(frame: DataFrame, window: WindowSpec) -> DataFrame:
        return _returns(frame, F.lag(value).over(window), value)

    return with_lookback(df, layout, 1, columns)


def _returns(frame: DataFrame, previous: Column, value: str) -> DataFrame:
    return frame.withColumn(f"previous_{value}", previous).withColumns({
        f"{value}_change": F.col(value) - F.col(f"previous_{value}"),
        "return_pct": (F.try_divide(F.col(value), F.col(f"previous_{value}")) - 1) * 100,
    })


def add_intervals(df: DataFrame, layout: SeriesLayout, time_col: str = "timestamp") -> DataFrame:
    """Previous timestamp and the minutes since it, over rows that have a timestamp."""

    def columns(frame: DataFrame, window: WindowSpec) -> DataFrame:
        return frame.withColumn(f"previous_{time_col}", F.lag(time_col).over(window)).withColumn(
            "interval_minutes", minutes_between(F.col(time_col), F.col(f"previous_{time_col}")))

    return with_lookback(df.filter(F.col(time_col).isNotNull()), layout, 1, columns)


def time_gaps(intervals: DataFrame, expected: float = EXPECTED_MINUTES, limit: int | None = None) -> DataFrame:
    """Intervals above the expected cadence, largest first."""
    gaps = intervals.filter(F.col("interval_minutes") > expected).select(
        *GROUP_COLS, "previous_timestamp", "timestamp", "interval_minutes")
    return limited(gaps.orderBy(F.desc("interval_minutes"), *GROUP_COLS, "timestamp"), limit)


def add_rolling_price(
    df: DataFrame, layout: SeriesLayout, rows: int = ROLLING_ROWS, value: str = "price"
) -> DataFrame:
    """Trailing mean and sample deviation of ``value`` over the last ``rows`` rows."""

    def columns(frame: DataFrame, window: WindowSpec) -> DataFrame:
        trailing = window.rowsBetween(-(rows - 1), 0)
        return frame.withColumns({
            f"rolling_{value}_mean": F.avg(value).over(trailing),
            f"rolling_{value}_std": F.stddev_samp(value).over(trailing),
        })

    return with_lookback(df, layout, rows - 1, columns)


def add_rolling_volatility(
    df: DataFrame, layout: SeriesLayout, rows: int = ROLLING_ROWS, value: str = "price"
) -> DataFrame:
    """Returns and their trailing sample deviation."""

    def columns(frame: DataFrame, window: WindowSpec) -> DataFrame:
        with_returns = _returns(frame, F.lag(value).over(window), value)
        return with_returns.withColumn(
            "rolling_return_std", F.stddev_samp("return_pct").over(window.rowsBetween(-(rows - 1), 0)))

    return with_lookback(df, layout, rows, columns)


def filter_series(df: DataFrame, coin_id: str, vs_currency: str = "usd") -> DataFrame:
    """One series."""
    return df.filter((F.col("coin_id") == coin_id) & (F.col("vs_currency") == vs_currency))


def series_list(df: DataFrame, where: str | None = None, columns: Sequence[str] = ("coin_id", "vs_currency")) -> DataFrame:
    """Distinct series in order, optionally of the rows that pass a SQL condition."""
    rows = df.filter(where) if where else df
    return rows.select(*columns).distinct().orderBy(*columns)


def series_view(
    df: DataFrame,
    columns: Sequence[str],
    series: Iterable[str] | None = None,
    not_null: Sequence[str] = (),
    order_by: Sequence[str] = ("timestamp",),
    limit: int | None = None,
) -> DataFrame:
    """The feed of a chart: some columns, some series, in order (ties by the other columns)."""
    rows = df if series is None else df.filter(F.col("coin_id").isin(list(series)))
    if not_null:
        rows = rows.dropna(subset=list(not_null))
    rows = rows.select(*columns)
    if order_by:
        rows = rows.orderBy(*order_by, *[c for c in columns if c not in order_by])
    return rows if limit is None else rows.limit(limit)


def value_pairs(df: DataFrame, x: str, y: str, by: Sequence[str] = ("coin_id", "vs_currency")) -> DataFrame:
    """Scatter points: both values present."""
    return df.select(*by, x, y).dropna(subset=[x, y])


def peek(df: DataFrame, order_by: Sequence[str], n: int = 5, columns: Sequence[str] | None = None) -> DataFrame:
    """The first rows in series and time order."""
    rows = df if columns is None else df.select(*columns)
    return rows.orderBy(*order_by).limit(n)
