"""The route for long series gives the rows of the plain window."""

from dataclasses import replace

import pytest
from fixtures import block_layout, examples, frame, plain_layout, rows_of
from pyspark.sql import functions as F

from tidemark.operators import describe, diagnostics, features, series
from tidemark.operators.ordering import number_rows, series_quantiles


@pytest.fixture(scope="module")
def data(spark):
    df = frame(spark, examples()).cache()
    return df, plain_layout(df), block_layout(df)


CASES = {
    "number_rows": lambda d, lay: number_rows(d, lay),
    "lags": lambda d, lay: series.add_lags(d, lay),
    "returns": lambda d, lay: series.add_returns(d, lay),
    "intervals": lambda d, lay: series.add_intervals(d, lay),
    "rolling_price": lambda d, lay: series.add_rolling_price(d, lay),
    "rolling_volatility": lambda d, lay: series.add_rolling_volatility(d, lay),
    "split": lambda d, lay: features.split_features(d, lay),
    "features": lambda d, lay: features.build_features(d, lay),
    "lag_correlations": lambda d, lay: describe.lag_correlations(d, lay),
    "box_plot": lambda d, lay: describe.box_plot(d, lay, "price"),
    "quantiles": lambda d, lay: series_quantiles(
        d.withColumn("price", F.round("price", 0)), lay, "price", {"low": 0.0, "q": 0.3, "mid": 0.5, "high": 1.0}),
    "trend_test": lambda d, lay: diagnostics.trend_test(d, lay),
    "trend_line": lambda d, lay: diagnostics.trend_line(d, lay),
    "adf": lambda d, lay: diagnostics.adf_test(d, lay),
    "kpss_trend": lambda d, lay: diagnostics.kpss_test(d, lay),
    "kpss_level": lambda d, lay: diagnostics.kpss_test(d, lay, trend=False),
    "diff_stationarity": lambda d, lay: diagnostics.diff_stationarity(d, lay),
    "acf": lambda d, lay: diagnostics.acf(d, lay),
}


@pytest.mark.parametrize("case", sorted(CASES))
def test_blocks_equal_plain(data, case):
    df, plain, blocks = data
    assert blocks.blocked and not plain.blocked
    expected, found = rows_of(CASES[case](df, plain), 6), rows_of(CASES[case](df, blocks), 6)
    assert found == expected


@pytest.mark.parametrize("case", ["number_rows", "split", "features", "kpss_trend", "box_plot"])
def test_shuffled_joins_equal_broadcast(data, case):
    df, plain, blocks = data
    assert not replace(blocks, broadcast_bytes=0).fits_broadcast(df.select("coin_id", "price"), blocks.series)
    expected = rows_of(CASES[case](df, plain), 6)
    assert rows_of(CASES[case](df, replace(plain, broadcast_bytes=0)), 6) == expected
    assert rows_of(CASES[case](df, replace(blocks, broadcast_bytes=0)), 6) == expected


def test_block_shorter_than_halo(data):
    df, plain, _blocks = data
    tiny = block_layout(df, rows_per_block=5)
    assert rows_of(series.add_lags(df, tiny)) == rows_of(series.add_lags(df, plain))
    assert rows_of(features.split_features(df, tiny)) == rows_of(features.split_features(df, plain))


def test_missing_keys_stay(spark):
    df = frame(spark, {("a", None): range(40), (None, "usd"): range(30)})
    plain, blocks = plain_layout(df), block_layout(df, 16)
    assert rows_of(number_rows(df, blocks)) == rows_of(number_rows(df, plain))
    assert rows_of(features.split_features(df, blocks)) == rows_of(features.split_features(df, plain))


def test_block_sizes_do_not_depend_on_the_series(spark):
    df = frame(spark, {("hot", "usd"): range(1000), ("cold", "usd"): range(10)})
    layout = block_layout(df, 64)
    from tidemark.operators.ordering import BLOCK, spread_blocks

    spread = spread_blocks(number_rows(df, layout), layout, 12)
    largest = spread.groupBy("coin_id", "vs_currency", BLOCK).count().agg(F.max("count")).first()[0]
    assert largest <= 64 + 12
