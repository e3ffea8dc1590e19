"""Every operator of the library as a named query over the driver's tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import dashboards as dash
from tidemark.operators import describe as desc
from tidemark.operators import diagnostics as diag
from tidemark.operators import features as feat
from tidemark.operators import grid, models, moments, monitoring, quality, runs, series, sketches
from tidemark.operators.dedup import CHART_KEY, OHLC_KEY, keep_one
from tidemark.operators.ordering import number_rows
from tidemark.operators.parse import align_chart, chart_documents, chart_points, parse_chart, parse_ohlc, points_of, quarantined, usable
from tidemark.operators.refresh import FeatureStore
from tidemark.operators.split_parse import parse_chart_files
from tidemark.session import materialize, scratch_root
from tidemark.sources.landing import peek_with_file, scan_landing
from tidemark.sources.tables import create_layers, layer_name, load_source, replace_from_query, row_count, save_table
from tidemark.streaming.ingest import ingest_chart, ingested
from tidemark.streaming.landing import land_new_files
from workload import market as m
from workload.oracles import add_variants

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Arguments of the dashboard selections and of the single series shown.
COINS = ["click", "view"]
START, END = "2024-01-05 00:00:00", "2024-01-15 00:00:00"
ONE_COIN, ONE_CURRENCY = "click", "usd"
# Where the second load of the feature store begins.
SECOND_LOAD = "2024-01-20 00:00:00"


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: m.publish(fn(spark, sf_dir))
        return fn

    return register


def _returns(spark, sf_dir):
    df, layout = m.market_series(spark, sf_dir)
    return series.add_returns(df, layout), layout


def _parsed_loads(spark, sf_dir):
    text = m.loads(spark, sf_dir).withColumnRenamed("timestamp_raw", "timestamp")
    return quality.parse_timestamps(text)


def _history(spark, sf_dir):
    return dash.history_dataset(_parsed_loads(spark, sf_dir), sort=False)


def _forecasts(spark, sf_dir):
    """The forecasts as one job stored them; monitoring reads them and fits nothing again."""
    return m.stored_forecasts(spark, sf_dir)


def _split(spark, sf_dir):
    df, layout = m.market_series(spark, sf_dir)
    return feat.split_features(df, layout), layout


# Sources

@query("raw_ingest")
def _(spark, sf_dir):
    lines = m.events(spark, sf_dir).select("props")
    path = m.write_lines(lines, f"{scratch_root(spark)}/landing-{uuid.uuid4().hex}", "market_chart")
    return scan_landing(spark, path).select(
        "data", F.contains("file_name", F.lit("market_chart")).alias("is_chart_file"),
        (F.col("file_size") > 0).alias("has_size"),
        (F.col("file_modification_time") <= F.col("etl_timestamp")).alias("landed_before_load"))


@query("incremental_landing")
def _(spark, sf_dir):
    """Two runs of the incremental job over files that arrive between them; a third finds nothing new."""
    root = f"{scratch_root(m.prepared(spark))}/arriving-{uuid.uuid4().hex}"
    rows = m.events(spark, sf_dir).select("event_id", "props")
    for parity in (0, 1, None):
        if parity is not None:
            m.write_lines(rows.filter(F.col("event_id") % 2 == parity).select("props"), f"{root}/in", "market_chart")
        land_new_files(spark, f"{root}/in", f"{root}/out", f"{root}/state").awaitTermination()
    return spark.read.parquet(f"{root}/out").select(
        "data", F.contains("file_name", F.lit("market_chart")).alias("is_chart_file"), (F.col("file_size") > 0).alias("has_size"))


@query("incremental_chart")
def _(spark, sf_dir):
    """Four runs of the keyed ingest: the second brings half its points again, the third corrections, the last no file."""
    root = f"{scratch_root(m.prepared(spark))}/arriving-{uuid.uuid4().hex}"
    corrected = m.market(spark, sf_dir).filter(F.col("event_id") % 25 == 0).withColumn("price", F.col("price") + 1)
    third = F.col("document") % 3
    arrivals = [m.documents(spark, sf_dir, "1").filter(third < 2), m.documents(spark, sf_dir, "7").filter(third > 0),
                m.documents(spark, sf_dir, "30", corrected), None]
    for arrival in arrivals:
        if arrival is not None:
            m.write_lines(arrival.select("chart"), f"{root}/in", "market_chart")
        ingest_chart(spark, f"{root}/in", f"{root}/out", f"{root}/state").awaitTermination()
    return ingested(spark, f"{root}/out").select(*PARSED_CHART)


def _refreshed(spark, sf_dir):
    """A feature store after three loads: the beginning, the rest, and late rows all over."""
    rows = m.market(m.prepared(spark), sf_dir)
    late, begins = F.col("event_id") % 50 == 7, F.col("timestamp") < F.lit(SECOND_LOAD).cast("timestamp_ntz")
    store = FeatureStore(f"{scratch_root(spark)}/store-{uuid.uuid4().hex}", order_cols=m.ORDER,
                         plain_limit=1 if m.variant.long_series else None)
    for load, part in enumerate((~late & begins, ~late & ~begins, late)):
        store.refresh(rows.filter(part), load)
    return store


@query("feature_refresh")
def _(spark, sf_dir):
    return _refreshed(spark, sf_dir).current(spark).dropna(subset=series.lag_names("price")).select(
        "coin_id", "vs_currency", "timestamp", "event_id", "price", "market_cap", "total_volume", *series.lag_names("price"))


@query("merged_scaling")
def _(spark, sf_dir):
    store = _refreshed(spark, sf_dir)
    return moments.scaling_from(store.train_moments(spark), store.names)


@query("merged_coefficients")
def _(spark, sf_dir):
    store = _refreshed(spark, sf_dir)
    fitted = moments.fit_from(store.train_moments(spark), store.names)
    return fitted.select("coin_id", "vs_currency", "train_rows", "intercept",
                         F.posexplode("coefficients").alias("feature", "coefficient"))


@query("merged_limits")
def _(spark, sf_dir):
    store = _refreshed(spark, sf_dir)
    return moments.limits_from(moments.fit_from(store.train_moments(spark), store.names))


@query("table_round_trip")
def _(spark, sf_dir):
    """A table of a layer is created, replaced with another schema, made again from a query, and read back."""
    prefix = f"t{uuid.uuid4().hex[:8]}"
    create_layers(m.prepared(spark), prefix)
    market = f"{layer_name(prefix, 'processed')}.market"
    save_table(m.market(spark, sf_dir).select("coin_id"), market)
    save_table(m.market(spark, sf_dir), market, "The whole market", partition_by=["coin_id"])
    usd = replace_from_query(spark, f"{layer_name(prefix, 'features')}.usd", f"SELECT * FROM {market} WHERE vs_currency = 'usd'")
    return usd.select("coin_id", "vs_currency", "timestamp", "event_id", "price")


@query("renamed_timestamp")
def _(spark, sf_dir):
    return _parsed_loads(spark, sf_dir).select("coin_id", "vs_currency", "event_id", "timestamp_raw", "timestamp", "load")


@query("load_source")
def _(spark, sf_dir):
    m.market(spark, sf_dir).createOrReplaceTempView("market_source")
    return load_source(spark, "market_source")


@query("row_count")
def _(spark, sf_dir):
    return row_count(m.market(spark, sf_dir))


@query("peek_with_file")
def _(spark, sf_dir):
    peeked = peek_with_file(m.events(spark, sf_dir), 10, ["event_id"])
    return peeked.withColumn("file_path", F.element_at(F.split("file_path", "/"), -1))


# Parsing

PARSED_CHART = ("coin_id", "vs_currency", "days", "timestamp_unix_ms", "timestamp_raw", "timestamp",
                "price", "market_cap", "total_volume")


@query("parse_chart")
def _(spark, sf_dir):
    raw = scan_landing(spark, m.land_documents(spark, sf_dir, "market_chart"))
    return parse_chart(raw).select(*PARSED_CHART)


@query("split_chart")
def _(spark, sf_dir):
    """The chart documents read in blocks, as files too large for one task are."""
    return parse_chart_files(spark, m.land_documents(spark, sf_dir, "market_chart"), whole_bytes=0).select(*PARSED_CHART)


@query("parse_quarantine")
def _(spark, sf_dir):
    raw = scan_landing(spark, m.land_spoiled(spark, sf_dir))
    # The text of a number differs between engines, so the second number of a record stands for it.
    second = F.get(F.from_json("record", "array<double>"), F.lit(1))
    return quarantined(raw).select("kind", "endpoint", "coin_id", "vs_currency", second.alias("second"), "reason")


@query("parse_spoiled")
def _(spark, sf_dir):
    raw = scan_landing(spark, m.land_spoiled(spark, sf_dir))
    return parse_chart(raw).select("coin_id", "vs_currency", "timestamp_unix_ms", "price")


@query("parse_ohlc")
def _(spark, sf_dir):
    raw = scan_landing(spark, m.land_documents(spark, sf_dir, "ohlc"))
    return parse_ohlc(raw).select(
        "coin_id", "vs_currency", "days", "timestamp_unix_ms", "timestamp_raw",
        "open_price", "high_price", "low_price", "close_price")


@query("chart_align")
def _(spark, sf_dir):
    raw = scan_landing(spark, m.land_documents(spark, sf_dir, "market_chart"))
    points = materialize(chart_points(chart_documents(raw)), "points")
    return align_chart(
        usable(points_of(points, "prices")), points_of(points, "market_caps"), points_of(points, "total_volumes"),
        ["timestamp_unix_ms"],
    ).select("endpoint", "coin_id", "vs_currency", "timestamp_unix_ms", "price", "market_cap", "total_volume")


@query("chart_dedup")
def _(spark, sf_dir):
    rows = m.loads(spark, sf_dir).drop("timestamp_raw", "event_id")
    return keep_one(rows, CHART_KEY)


@query("ohlc_dedup")
def _(spark, sf_dir):
    return keep_one(m.ohlc_loads(spark, sf_dir).drop("timestamp"), OHLC_KEY)


# Views

@query("filter_series")
def _(spark, sf_dir):
    return series.filter_series(m.market(spark, sf_dir), ONE_COIN, ONE_CURRENCY)


@query("series_list")
def _(spark, sf_dir):
    return series.series_list(m.market(spark, sf_dir), "vs_currency = 'usd'")


@query("series_view")
def _(spark, sf_dir):
    return series.series_view(m.market(spark, sf_dir), ["timestamp", "coin_id", "price"],
                              order_by=["timestamp", "coin_id"])


@query("price_volume_pairs")
def _(spark, sf_dir):
    return series.value_pairs(m.market(spark, sf_dir), "total_volume", "price")


@query("lag1_pairs")
def _(spark, sf_dir):
    df, layout = m.market_series(spark, sf_dir)
    return series.value_pairs(series.add_lags(df, layout, lags=(1,)), "price_lag_1", "price")


@query("actual_vs_predicted")
def _(spark, sf_dir):
    return series.series_view(
        _forecasts(spark, sf_dir), ["coin_id", "vs_currency", "timestamp", "dataset_type", "price", "prediction"])


@query("residuals_over_time")
def _(spark, sf_dir):
    return series.series_view(
        _forecasts(spark, sf_dir), ["coin_id", "vs_currency", "timestamp", "dataset_type", "residual"])


@query("returns_over_time")
def _(spark, sf_dir):
    returns, _layout = _returns(spark, sf_dir)
    return series.series_view(returns, ["timestamp", "coin_id", "return_pct"], not_null=["return_pct"])


@query("peek")
def _(spark, sf_dir):
    return series.peek(m.market(spark, sf_dir), ["coin_id", "vs_currency", "timestamp", "event_id"], 5)


# Features

@query("lag_features")
def _(spark, sf_dir):
    df, layout = m.market_series(spark, sf_dir)
    return feat.lag_features(df, layout)


@query("lag_features_ties")
def _(spark, sf_dir):
    df, layout = m.ticks(spark, sf_dir)
    return feat.lag_features(df, layout)


@query("split_train")
def _(spark, sf_dir):
    return feat.train_rows(_split(spark, sf_dir)[0])


@query("split_test")
def _(spark, sf_dir):
    return feat.test_rows(_split(spark, sf_dir)[0])


@query("scaling_stats")
def _(spark, sf_dir):
    return feat.scaling_stats(feat.train_rows(_split(spark, sf_dir)[0]), series.lag_names("price"))


@query("standardize")
def _(spark, sf_dir):
    tagged, layout = _split(spark, sf_dir)
    names = series.lag_names("price")
    rows, scaled = feat.standardize(tagged, names, layout)
    return rows.select("coin_id", "vs_currency", "timestamp", *scaled)


@query("feature_train")
def _(spark, sf_dir):
    features, _layout = m.feature_table(spark, sf_dir)
    return feat.select_final(feat.train_rows(features))


@query("feature_test")
def _(spark, sf_dir):
    features, _layout = m.feature_table(spark, sf_dir)
    return feat.select_final(feat.test_rows(features))


# Models

@query("assembled")
def _(spark, sf_dir):
    df, layout = m.market_series(spark, sf_dir)
    rows = feat.select_final(feat.build_features(df, layout, vector=True))
    values = vector_to_array("features")
    return rows.select("coin_id", "vs_currency", "timestamp", *[values[i].alias(f"f{i}") for i in range(5)])


@query("single_model")
def _(spark, sf_dir):
    features, layout = m.feature_table(spark, sf_dir)
    return models.single_model(features, layout, {"coin_id": ONE_COIN, "vs_currency": ONE_CURRENCY})[1]


@query("saved_model")
def _(spark, sf_dir):
    """Coefficients of one series stored twice, read back and applied."""
    features, layout = m.feature_table(spark, sf_dir)
    path, key = f"{scratch_root(spark)}/model-{uuid.uuid4().hex}", {"coin_id": ONE_COIN, "vs_currency": ONE_CURRENCY}
    for _ in range(2):
        models.single_model(features, layout, key, path=path)
    one = series.filter_series(features, ONE_COIN, ONE_CURRENCY)
    return models.predict(one, spark.read.parquet(path), models.scaled_names(), layout).select(
        "coin_id", "vs_currency", "timestamp", "prediction", "residual")


@query("limited_reports")
def _(spark, sf_dir):
    """The first rows of reports that take a limit, as a name and the rows kept."""
    df, layout = m.market_series(spark, sf_dir)
    intervals, forecasts = series.add_intervals(df, layout), _forecasts(spark, sf_dir)
    reports = {
        "coverage": quality.coverage(df, limit=3), "cadence": quality.cadence_summary(intervals, limit=3),
        "frequency": quality.interval_frequency(intervals, limit=3), "gaps": series.time_gaps(intervals, limit=3),
        "describe": desc.describe(df, {"price": desc.spread("price")}, limit=3),
        "metrics": monitoring.report_part(forecasts, "errors", limit=3)}
    every = [r.select(F.lit(name).alias("report"), "coin_id", "vs_currency") for name, r in reports.items()]
    return reduce(DataFrame.unionByName, every)


@query("series_status")
def _(spark, sf_dir):
    return models.series_status(_split(spark, sf_dir)[0])


@query("model_coefficients")
def _(spark, sf_dir):
    features, layout = m.feature_table(spark, sf_dir)
    fitted, _predictions = models.score_all(features, layout)
    return fitted.select("coin_id", "vs_currency", "train_rows", "intercept",
                         F.posexplode("coefficients").alias("feature", "coefficient"))


@query("forecasts")
def _(spark, sf_dir):
    return m.forecast_table(spark, sf_dir)[0]


@query("control_limits")
def _(spark, sf_dir):
    features, layout = m.feature_table(spark, sf_dir)
    _fitted, predictions = models.score_all(features, layout)
    return monitoring.control_limits(feat.train_rows(predictions))


@query("model_performance")
def _(spark, sf_dir):
    features, layout = m.feature_table(spark, sf_dir)
    _fitted, predictions = models.score_all(features, layout)
    return models.model_performance(predictions)


# Monitoring

@query("forecast_date_range")
def _(spark, sf_dir):
    return quality.coverage(_forecasts(spark, sf_dir), distinct=False)


@query("forecast_null_summary")
def _(spark, sf_dir):
    return quality.null_summary(_forecasts(spark, sf_dir),
                                ["coin_id", "timestamp", "vs_currency", "price", "prediction", "residual"])


@query("forecast_duplicate_keys")
def _(spark, sf_dir):
    # Stored forecasts have distinct times; by the hour there are repeats to find.
    hourly = _forecasts(spark, sf_dir).withColumn("timestamp", F.date_trunc("hour", "timestamp"))
    return quality.duplicate_keys(hourly)


@query("split_summary")
def _(spark, sf_dir):
    return monitoring.report_part(_forecasts(spark, sf_dir), "range")


@query("split_validation")
def _(spark, sf_dir):
    return monitoring.split_order(_forecasts(spark, sf_dir))


@query("forecast_price_stats")
def _(spark, sf_dir):
    return monitoring.value_stats(_forecasts(spark, sf_dir), "price")


@query("residual_stats")
def _(spark, sf_dir):
    return monitoring.value_stats(_forecasts(spark, sf_dir), "residual")


@query("out_of_control")
def _(spark, sf_dir):
    return monitoring.rows_beyond_limits(_forecasts(spark, sf_dir))


@query("out_of_control_summary")
def _(spark, sf_dir):
    return monitoring.report_part(_forecasts(spark, sf_dir), "limits")


@query("forecast_metrics")
def _(spark, sf_dir):
    return monitoring.report_part(_forecasts(spark, sf_dir), "errors")


@query("error_pivot")
def _(spark, sf_dir):
    return monitoring.error_pivot(_forecasts(spark, sf_dir))


@query("residual_pivot")
def _(spark, sf_dir):
    return monitoring.residual_pivot(_forecasts(spark, sf_dir))


@query("top_errors")
def _(spark, sf_dir):
    return monitoring.largest_errors(_forecasts(spark, sf_dir), 5)


@query("top_test_errors")
def _(spark, sf_dir):
    return monitoring.largest_errors(_forecasts(spark, sf_dir), None, "test")


# Quality

@query("timestamp_parse_report")
def _(spark, sf_dir):
    return quality.timestamp_parse_report(_parsed_loads(spark, sf_dir))


@query("coverage")
def _(spark, sf_dir):
    return quality.coverage(_parsed_loads(spark, sf_dir))


@query("null_summary")
def _(spark, sf_dir):
    return quality.null_summary(_parsed_loads(spark, sf_dir), [
        "coin_id", "vs_currency", "timestamp", "price", "market_cap", "total_volume"])


@query("duplicate_keys")
def _(spark, sf_dir):
    return quality.duplicate_keys(_parsed_loads(spark, sf_dir))


@query("intervals")
def _(spark, sf_dir):
    df, layout = m.market_series(spark, sf_dir)
    return series.add_intervals(df, layout).select(
        "coin_id", "vs_currency", "timestamp", "previous_timestamp", "interval_minutes")


@query("cadence_summary")
def _(spark, sf_dir):
    df, layout = m.market_series(spark, sf_dir)
    return quality.cadence_summary(series.add_intervals(df, layout))


@query("interval_frequency")
def _(spark, sf_dir):
    df, layout = m.market_series(spark, sf_dir)
    return quality.interval_frequency(series.add_intervals(df, layout))


@query("time_gaps")
def _(spark, sf_dir):
    df, layout = m.market_series(spark, sf_dir)
    return series.time_gaps(series.add_intervals(df, layout))


# Description

@query("describe_market")
def _(spark, sf_dir):
    return desc.describe_market(m.loads(spark, sf_dir))


@query("describe_price")
def _(spark, sf_dir):
    return desc.describe_price(m.loads(spark, sf_dir))


@query("describe_market_cap")
def _(spark, sf_dir):
    return desc.describe_level(m.loads(spark, sf_dir), "market_cap", "market_cap")


@query("describe_volume")
def _(spark, sf_dir):
    return desc.describe_level(m.loads(spark, sf_dir), "total_volume", "volume")


@query("returns")
def _(spark, sf_dir):
    return _returns(spark, sf_dir)[0].select(
        "coin_id", "vs_currency", "timestamp", "price", "previous_price", "price_change", "return_pct")


@query("return_stats")
def _(spark, sf_dir):
    return desc.return_stats(_returns(spark, sf_dir)[0])


@query("return_outliers")
def _(spark, sf_dir):
    returns, layout = _returns(spark, sf_dir)
    return desc.return_outliers(returns, layout).select(
        "coin_id", "vs_currency", "timestamp", "price", "previous_price", "return_pct", "lower_bound", "upper_bound"
    ).orderBy("coin_id", "vs_currency", "timestamp")


@query("top_return_outliers")
def _(spark, sf_dir):
    returns, layout = _returns(spark, sf_dir)
    return desc.top_absolute(
        desc.return_outliers(returns, layout), "return_pct", "absolute_return_pct",
        ["coin_id", "vs_currency", "timestamp", "event_id", "price", "return_pct", "lower_bound", "upper_bound"],
        10, ["coin_id", "vs_currency", "timestamp", "event_id"])


@query("outlier_counts")
def _(spark, sf_dir):
    returns, layout = _returns(spark, sf_dir)
    return desc.outlier_counts(desc.return_outliers(returns, layout))


@query("top_abs_returns")
def _(spark, sf_dir):
    return desc.top_absolute(
        _returns(spark, sf_dir)[0], "return_pct", "absolute_return_pct",
        ["coin_id", "vs_currency", "timestamp", "event_id", "price", "previous_price", "price_change", "return_pct",
         "total_volume"],
        10, ["coin_id", "vs_currency", "timestamp", "event_id"])


@query("rolling_price")
def _(spark, sf_dir):
    df, layout = m.market_series(spark, sf_dir)
    return series.add_rolling_price(df, layout).select(
        "coin_id", "vs_currency", "timestamp", "price", "rolling_price_mean", "rolling_price_std")


@query("rolling_volatility")
def _(spark, sf_dir):
    df, layout = m.market_series(spark, sf_dir)
    return series.add_rolling_volatility(df, layout).select(
        "coin_id", "vs_currency", "timestamp", "return_pct", "rolling_return_std")


@query("correlations")
def _(spark, sf_dir):
    return desc.correlations(m.market(spark, sf_dir))


@query("price_lag_corr")
def _(spark, sf_dir):
    df, layout = m.market_series(spark, sf_dir)
    return desc.lag_correlations(df, layout)


@query("return_lag_corr")
def _(spark, sf_dir):
    returns, layout = _returns(spark, sf_dir)
    return desc.lag_correlations(returns.filter(F.col("return_pct").isNotNull()), layout, "return_pct", "return")


@query("price_histogram")
def _(spark, sf_dir):
    df, layout = m.market_series(spark, sf_dir)
    return desc.histogram(df, layout, "price", desc.PRICE_BINS)


@query("return_histogram")
def _(spark, sf_dir):
    returns, layout = _returns(spark, sf_dir)
    return desc.histogram(returns, layout, "return_pct", desc.RETURN_BINS)


@query("return_boxplot")
def _(spark, sf_dir):
    returns, layout = _returns(spark, sf_dir)
    return desc.box_plot(returns, layout, "return_pct")


# Dashboards

@query("dash_ohlc")
def _(spark, sf_dir):
    return dash.ohlc_dataset(m.ohlc_loads(spark, sf_dir))


@query("dash_history")
def _(spark, sf_dir):
    return dash.history_dataset(_parsed_loads(spark, sf_dir))


@query("dash_filtered_history")
def _(spark, sf_dir):
    return dash.selected(_history(spark, sf_dir), COINS, START, END)


@query("candles")
def _(spark, sf_dir):
    return dash.candles(dash.ohlc_dataset(m.ohlc_loads(spark, sf_dir), sort=False))


@query("dash_price_cards")
def _(spark, sf_dir):
    return dash.price_cards(dash.selected(_history(spark, sf_dir), COINS, START, END))


@query("dash_price_line")
def _(spark, sf_dir):
    return dash.line_series(_history(spark, sf_dir), "price", "sum_price")


@query("dash_market_cap_line")
def _(spark, sf_dir):
    return dash.line_series(_history(spark, sf_dir), "market_cap", "sum_market_cap")


@query("dash_filter_facet")
def _(spark, sf_dir):
    return dash.filter_facet(_history(spark, sf_dir), "coin_id", COINS, START, END)


@query("dash_time_facet")
def _(spark, sf_dir):
    return dash.filter_facet(_history(spark, sf_dir), "timestamp", COINS, START, END)


@query("dash_control_chart")
def _(spark, sf_dir):
    return dash.control_chart(_forecasts(spark, sf_dir))


@query("dash_control_cards")
def _(spark, sf_dir):
    return dash.control_cards(_forecasts(spark, sf_dir))


# Diagnostics

@query("trend_fit")
def _(spark, sf_dir):
    df, layout = m.market_series(spark, sf_dir)
    return diag.trend_fit(number_rows(diag.complete_rows(df), layout), layout).drop("_r")


@query("trend_test")
def _(spark, sf_dir):
    return diag.trend_test(*m.market_series(spark, sf_dir))


@query("trend_line")
def _(spark, sf_dir):
    return diag.trend_line(*m.market_series(spark, sf_dir))


@query("adf_test")
def _(spark, sf_dir):
    return diag.adf_test(*m.market_series(spark, sf_dir))


@query("kpss_test")
def _(spark, sf_dir):
    return diag.kpss_test(*m.market_series(spark, sf_dir))


@query("stationarity")
def _(spark, sf_dir):
    df, layout = m.market_series(spark, sf_dir)
    return diag.stationarity(diag.adf_test(df, layout), diag.kpss_test(df, layout), layout)


@query("diff_stationarity")
def _(spark, sf_dir):
    return diag.diff_stationarity(*m.market_series(spark, sf_dir))


@query("price_acf")
def _(spark, sf_dir):
    return diag.acf(*m.market_series(spark, sf_dir))


@query("return_acf")
def _(spark, sf_dir):
    returns, layout = _returns(spark, sf_dir)
    return diag.acf(returns, layout, "return_pct")


@query("price_pacf")
def _(spark, sf_dir):
    df, layout = m.market_series(spark, sf_dir)
    return diag.pacf(diag.acf(df, layout), layout)


@query("return_pacf")
def _(spark, sf_dir):
    returns, layout = _returns(spark, sf_dir)
    return diag.pacf(diag.acf(returns, layout, "return_pct"), layout)


def _runs(spark, sf_dir):
    rows = _forecasts(spark, sf_dir)
    return runs.control_runs(rows, m.layout_of(rows, runs.RUN_ORDER))


@query("control_runs")
def _(spark, sf_dir):
    return _runs(spark, sf_dir).select("coin_id", "vs_currency", "timestamp", "dataset_type", "residual", "side_run", *runs.RULES)


@query("control_run_summary")
def _(spark, sf_dir):
    return runs.run_summary(_runs(spark, sf_dir))


@query("residual_drift")
def _(spark, sf_dir):
    rows = _forecasts(spark, sf_dir)
    return runs.drift(rows, m.layout_of(rows, runs.RUN_ORDER))


@query("regular_grid")
def _(spark, sf_dir):
    df, layout = m.market_series(spark, sf_dir)
    return grid.regular_grid(df, layout, ("price", "total_volume"))


@query("sketch_quantiles")
def _(spark, sf_dir):
    """Quartiles of prices from stored daily sketches of two loads, and whether their exact ranks are within the bound."""
    rows = m.market(m.prepared(spark), sf_dir)
    day, even = F.col("timestamp").cast("date"), F.col("event_id") % 2 == 0
    table = materialize(sketches.daily_sketches(rows.filter(even), "price", day).unionByName(
        sketches.daily_sketches(rows.filter(~even), "price", day)), "sketches")
    found = sketches.quantiles(sketches.merged(table))
    off = sketches.rank_distance(rows, "price", materialize(found, "quantiles"))
    return off.select("coin_id", "vs_currency", "n", *[
        (F.col(name) <= sketches.rank_error()).alias(f"{name}_within_bound") for name in sketches.QUARTILES])


# The same operators where the second currency is missing, and by the route for series that are too long for one
# task, with small blocks.

VARIANTS = {
    "no_currency": ({"no_currency": True}, (
        "lag_features", "standardize", "feature_train", "forecasts", "control_limits", "forecast_metrics", "split_validation", "return_outliers", "price_histogram", "return_boxplot", "trend_line",
        "trend_test", "price_acf", "return_pacf", "kpss_test", "adf_test", "stationarity",
        "incremental_chart", "feature_refresh", "merged_coefficients", "merged_limits", "control_runs", "residual_drift", "regular_grid")),
    "long": ({"long_series": True}, (
        "lag_features", "split_train", "split_test", "standardize", "feature_train", "forecasts", "intervals", "returns",
        "rolling_price", "rolling_volatility", "price_lag_corr", "return_outliers", "return_boxplot", "trend_line",
        "price_acf", "kpss_test", "adf_test", "feature_refresh", "control_runs", "residual_drift",
        "regular_grid")),
}


def _presented(name: str, how: dict[str, bool]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        with m.presented(**how):
            return QUERIES[name](spark, sf_dir)

    return run


for _suffix, (_how, _names) in VARIANTS.items():
    QUERIES |= {f"{_name}_{_suffix}": _presented(_name, _how) for _name in _names}
add_variants(VARIANTS)
