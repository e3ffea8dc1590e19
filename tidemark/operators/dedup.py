"""Keeping one row per key, by a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LOAD_ORDER = ("etl_timestamp", "file_modification_time", "file_name")
CHART_KEY = ("coin_id", "vs_currency", "timestamp_unix_ms", "price")
OHLC_KEY = ("coin_id", "vs_currency", "timestamp_unix_ms",
            "open_price", "high_price", "low_price", "close_price")


def keep_one(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = LOAD_ORDER,
    keep: str = "first",
    rank_col: str | None = None,
) -> DataFrame:
    """The first (or last) row of each key by ``order``, ties broken by all other columns.

    ``row_number() = 1`` lets Spark keep one row per key before the shuffle, so a key
    with very many copies does not gather in one task.
    """
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first' or 'last'")
    load = [c for c in order if c in df.columns]
    rest = [c for c in df.columns if c not in (*keys, *load)]
    ordering = [F.col(c).desc() if keep == "last" else F.col(c).asc() for c in load]
    ordering += [F.col(c) for c in rest]
    name = rank_col or "_rn"
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*ordering)))
    kept = ranked.filter(F.col(name) == 1)
    return kept if rank_col else kept.drop(name)


def dedup_ohlc(df: DataFrame) -> DataFrame:
    """One row per (series, millisecond, four prices): the earliest load."""
    return keep_one(df, OHLC_KEY)
