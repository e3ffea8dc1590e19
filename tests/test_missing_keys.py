"""A series whose currency is missing is a series like any other, in every operator."""

import pytest
from compare import normal
from fixtures import block_layout, examples, frame, plain_layout
from pyspark.sql import functions as F

from tidemark.operators import describe, diagnostics, features, models, monitoring, series

COINS = ("noise", "ar", "walk")


@pytest.fixture(scope="module")
def pair(spark):
    """The same rows under a currency and without one."""
    known = frame(spark, {k: v for k, v in examples().items() if k[0] in COINS}).cache()
    return known, known.withColumn("vs_currency", F.lit(None).cast("string")).cache()


def layouts(df):
    return plain_layout(df), block_layout(df)


def forecast(df, layout):
    _fitted, predictions = models.score_all(features.build_features(df, layout), layout)
    return models.forecasts(predictions, layout)


CASES = {
    "histogram": lambda df, lay: describe.histogram(df, lay, "price", 10),
    "box_plot": lambda df, lay: describe.box_plot(df, lay, "price"),
    "outliers": lambda df, lay: describe.return_outliers(series.add_returns(df, lay), lay),
    "acf": diagnostics.acf,
    "pacf": lambda df, lay: diagnostics.pacf(diagnostics.acf(df, lay), lay),
    "adf": diagnostics.adf_test,
    "kpss": diagnostics.kpss_test,
    "stationarity": lambda df, lay: diagnostics.stationarity(
        diagnostics.adf_test(df, lay), diagnostics.kpss_test(df, lay), lay),
    "diff_stationarity": diagnostics.diff_stationarity,
    "trend_line": diagnostics.trend_line,
    "features": features.build_features,
    "forecasts": forecast,
    "report": lambda df, lay: monitoring.forecast_report(forecast(df, lay)),
    "split_order": lambda df, lay: monitoring.split_order(forecast(df, lay)),
}


def rows(df):
    plain = df.drop("vs_currency")
    rounded = [F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in plain.dtypes]
    return normal(plain.columns, [tuple(r) for r in plain.select(*rounded).collect()])


@pytest.mark.parametrize("route", [0, 1])
@pytest.mark.parametrize("case", sorted(CASES))
def test_missing_currency(pair, case, route):
    known, missing = pair
    found = CASES[case](missing, layouts(missing)[route])
    assert found.count() and not found.filter("vs_currency IS NOT NULL").count()
    assert rows(found) == rows(CASES[case](known, layouts(known)[route]))
