"""Land, parse, build features, train and forecast, in the order the data flows.

Each step reads the tables of the step before it and replaces its own, so a step can be
run again by itself. Source and target namespaces are both parameters.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import features as feat
from tidemark.operators import models
from tidemark.operators.ordering import ORDER_COLS, SeriesLayout, measure_series
from tidemark.operators.parse import ALIGN_KEYS, parse_chart, parse_ohlc, quarantined
from tidemark.operators.series import LAGS
from tidemark.session import scratch_scope
from tidemark.sources.landing import scan_landing
from tidemark.sources.tables import create_layers, layer_name, load_source, save_table

FEATURE_SOURCE = ("coin_id", "vs_currency", "timestamp", "timestamp_unix_ms", "price")


@dataclass(frozen=True)
class Tables:
    """Names of the tables under one namespace prefix."""

    prefix: str = ""

    def _name(self, layer: str, table: str) -> str:
        return f"{layer_name(self.prefix, layer)}.{table}"

    @property
    def raw(self) -> str:
        return self._name("raw", "market_documents")

    @property
    def chart(self) -> str:
        return self._name("processed", "coin_chart")

    @property
    def ohlc(self) -> str:
        return self._name("processed", "coin_ohlc")

    @property
    def quarantine(self) -> str:
        return self._name("processed", "quarantine")

    @property
    def features(self) -> str:
        return self._name("features", "coin_forecast_features")

    @property
    def coefficients(self) -> str:
        return self._name("models", "coin_model_coefficients")

    @property
    def performance(self) -> str:
        return self._name("models", "coin_model_performance")

    @property
    def forecasts(self) -> str:
        return self._name("models", "coin_forecasts")


def ingest(spark: SparkSession, landing: str, target: Tables) -> DataFrame:
    return save_table(scan_landing(spark, landing), target.raw, "Market data documents as landed")


def process_chart(
    spark: SparkSession, source: Tables, target: Tables, keys: Sequence[str] = ALIGN_KEYS
) -> DataFrame:
    rows = parse_chart(spark.table(source.raw), keys)
    return save_table(rows, target.chart, "Prices, market caps and volumes")


def process_ohlc(spark: SparkSession, source: Tables, target: Tables) -> DataFrame:
    return save_table(parse_ohlc(spark.table(source.raw)), target.ohlc, "Open, high, low and close prices")


def process_quarantine(spark: SparkSession, source: Tables, target: Tables) -> DataFrame:
    """What parsing leaves out of the chart and OHLC tables."""
    return save_table(quarantined(spark.table(source.raw)), target.quarantine, "Records that parsing left out")


def create_features(
    spark: SparkSession, source: Tables, target: Tables,
    lags: Sequence[int] = LAGS, ratio: float = feat.TRAIN_RATIO, vector: bool = False,
) -> tuple[DataFrame, SeriesLayout]:
    """The feature table, stored by side of the split so that a side is read alone."""
    rows = load_source(spark, source.chart, FEATURE_SOURCE)
    layout = measure_series(rows, order_cols=ORDER_COLS)
    table = feat.build_features(rows, layout, lags=lags, ratio=ratio, vector=vector)
    return save_table(table, target.features, "Lag features", partition_by=["dataset_type"]), layout


def train(
    spark: SparkSession, source: Tables, target: Tables, layout: SeriesLayout | None = None,
    vs_currency: str | None = None, model_base: str = "models", lags: Sequence[int] = LAGS, strict: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Models, their performance and the forecasts of every series, or of those of one currency.

    All series are fitted in one job. A series without training rows gets no model and NULL
    predictions; one without test rows gets NULL test metrics. ``series_status`` names both;
    ``strict`` raises for them instead.
    """
    table = spark.table(source.features)
    if vs_currency is not None:
        table = table.filter(F.col("vs_currency") == vs_currency)
    if layout is None:
        layout = measure_series(table, order_cols=ORDER_COLS)
    if strict:
        models.require_complete(models.series_status(table, layout.group_cols))
    fitted, predictions = models.score_all(table, layout, lags=lags)
    save_table(fitted, target.coefficients, "Intercept and coefficients per series")
    predictions = models.predict(
        table, spark.table(target.coefficients), models.scaled_names(lags=lags), layout)
    forecasts = save_table(models.forecasts(predictions, layout), target.forecasts, "Forecasts with control limits")
    performance = save_table(
        models.model_performance(forecasts, model_base), target.performance, "Test metrics per series")
    return performance, forecasts


def run(
    spark: SparkSession, landing: str, source: Tables, target: Tables,
    vs_currency: str | None = None, strict: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """The whole job, for every currency or one; ``source`` equals ``target`` unless one environment reads another's."""
    create_layers(spark, target.prefix)
    # All results are tables by the end, so intermediate stages can go.
    with scratch_scope(spark):
        ingest(spark, landing, target)
        process_chart(spark, source, target)
        process_ohlc(spark, source, target)
        process_quarantine(spark, source, target)
        _features, layout = create_features(spark, target, target)
        return train(spark, target, target, layout, vs_currency, strict=strict)
