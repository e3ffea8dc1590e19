"""Market series derived from the ``events`` table."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.timestamps import TEXT_FORMAT
from tidemark.operators.features import build_features
from tidemark.operators.models import forecasts, score_all
from tidemark.operators.ordering import SeriesLayout, measure_series
from tidemark.session import apply_settings, materialize, scratch_root

ORDER = ("timestamp", "event_id")
POINTS_PER_DOCUMENT = 256


prepared = apply_settings


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_settings(spark).read.parquet(f"{sf_dir}/events.parquet")


@dataclass
class Variant:
    """How the market is presented while a query is built."""

    no_currency: bool = False       # the second currency is missing
    long_series: bool = False       # series count as too long for one task


variant = Variant()
# Rows of a block where the route for long series is forced.
SMALL_BLOCK = 256


@contextmanager
def presented(**how: bool):
    global variant
    before, variant = variant, Variant(**how)
    try:
        yield
    finally:
        variant = before


def market(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten series: an event type is a coin, the parity of the user its currency."""
    value = F.col("value")
    currency = F.when(F.col("user_id") % 2 == 0, "usd")
    return events(spark, sf_dir).select(
        F.col("event_type").alias("coin_id"),
        (currency if variant.no_currency else currency.otherwise("eur")).alias("vs_currency"),
        F.col("ts").alias("timestamp"),
        "event_id",
        value.alias("price"),
        (value * (F.col("user_id") + 1)).alias("market_cap"),
        (value * (F.col("event_id") % 97 + 1)).alias("total_volume"),
    )


def layout_of(df: DataFrame, order: Sequence[str] = ORDER) -> SeriesLayout:
    if variant.long_series:
        return measure_series(df, order_cols=order, plain_limit=1, rows_per_block=SMALL_BLOCK)
    return measure_series(df, order_cols=order)


def market_series(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, SeriesLayout]:
    df = market(spark, sf_dir)
    return df, layout_of(df)


def loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of the market: repeated rows, corrected prices, missing caps, bad timestamps."""
    base = market(spark, sf_dir)
    again = base.filter(F.col("event_id") % 10 == 0)
    corrected = base.filter(F.col("event_id") % 25 == 0).withColumn("price", F.col("price") + 1)
    rows = (
        base.withColumn("load", F.lit(1))
        .unionByName(again.withColumn("load", F.lit(2)))
        .unionByName(corrected.withColumn("load", F.lit(2)))
    )
    text = F.date_format("timestamp", TEXT_FORMAT)
    return rows.select(
        "coin_id", "vs_currency", "event_id",
        F.when(F.col("event_id") % 103 == 0, F.lit(None)).when(F.col("event_id") % 101 == 0, "bad")
        .otherwise(text).alias("timestamp_raw"),
        F.unix_millis(F.col("timestamp").cast("timestamp")).alias("timestamp_unix_ms"),
        "price",
        F.when(F.col("event_id") % 13 != 0, F.col("market_cap")).alias("market_cap"),
        "total_volume",
        (F.col("timestamp") + F.make_dt_interval(F.col("load"))).alias("etl_timestamp"),
        F.col("load"),
    )


def ohlc_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("price")
    return loads(spark, sf_dir).select(
        "coin_id", "vs_currency", "timestamp_unix_ms",
        F.col("timestamp_raw").alias("timestamp"),
        price.alias("open_price"), (price * 1.02).alias("high_price"), (price * 0.98).alias("low_price"),
        (price + (F.col("event_id") % 5 - 2) * 0.01 * price).alias("close_price"),
        "etl_timestamp", "load",
    )


def ticks(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, SeriesLayout]:
    """Series with many equal times: orders by priority and status, in date and key order."""
    df = apply_settings(spark).read.parquet(f"{sf_dir}/orders.parquet").select(
        F.col("o_orderpriority").alias("coin_id"), F.col("o_orderstatus").alias("vs_currency"),
        F.col("o_orderdate").alias("timestamp"), F.col("o_orderkey").alias("event_id"),
        F.col("o_totalprice").alias("price"))
    return df, layout_of(df)


# JSON documents. A document holds the points of one series among POINTS_PER_DOCUMENT
# consecutive event ids, so no document grows with the table.

def documents(spark: SparkSession, sf_dir: str, days: str = "1", rows: DataFrame | None = None) -> DataFrame:
    """Per document: series, chart envelope and OHLC envelope as JSON text, of the market or of ``rows`` like it."""
    points = (market(spark, sf_dir) if rows is None else rows).select(
        "coin_id", "vs_currency", F.floor(F.col("event_id") / POINTS_PER_DOCUMENT).alias("document"),
        F.unix_millis(F.col("timestamp").cast("timestamp")).alias("ms"),
        "price", "market_cap", "total_volume",
        (F.col("price") + (F.col("event_id") % 5 - 2) * 0.01 * F.col("price")).alias("close"))
    grouped = points.groupBy("coin_id", "vs_currency", "document").agg(
        F.sort_array(F.collect_list(F.struct("ms", "price", "market_cap", "total_volume", "close"))).alias("points"))

    def column(name: str):
        return F.transform("points", lambda p: F.array(p["ms"].cast("double"), p[name]))

    chart = F.to_json(F.struct(
        column("price").alias("prices"), column("market_cap").alias("market_caps"),
        column("total_volume").alias("total_volumes")))
    ohlc = F.to_json(F.transform("points", lambda p: F.array(
        p["ms"].cast("double"), p["price"], p["price"] * 1.02, p["price"] * 0.98, p["close"])))

    def envelope(kind: str, response):
        return F.to_json(F.struct(
            F.concat(F.lit("/coins/"), F.col("coin_id"), F.lit(f"/{kind}")).alias("endpoint"),
            F.to_json(F.struct("vs_currency", F.lit(days).alias("days"))).alias("parameters"),
            response.alias("response")))

    return grouped.select("document", envelope("market_chart", chart).alias("chart"),
                          envelope("ohlc", ohlc).alias("ohlc"))


def write_lines(lines: DataFrame, path: str, file_prefix: str) -> str:
    """Write one text column as files whose names start with ``file_prefix``."""
    lines.write.mode("append").option("mapreduce.output.basename", file_prefix).text(path)
    return path


def land_documents(spark: SparkSession, sf_dir: str, kind: str, loads: int = 2) -> str:
    """A landing folder with chart or OHLC documents; the second load repeats every even document
    with another ``days``. Written by each call, from the tables as they are then."""
    apply_settings(spark)
    root = f"{scratch_root(spark)}/landing-{uuid.uuid4().hex}"
    column = "chart" if kind == "market_chart" else "ohlc"
    write_lines(documents(spark, sf_dir, "1").select(column), f"{root}/1", kind)
    if loads > 1:
        repeated = documents(spark, sf_dir, "7").filter(F.col("document") % 2 == 0)
        write_lines(repeated.select(column), f"{root}/2", kind)
    return root


def land_spoiled(spark: SparkSession, sf_dir: str) -> str:
    """A document for each event, spoiled by its id modulo 7: epochs that are no time, short records, no coin."""
    kind = F.col("event_id") % 7
    epoch = (F.when(kind == 0, '"NaN"').when(kind == 1, "1e300").when(kind == 2, "9e18")
             .otherwise(F.unix_millis(F.col("timestamp").cast("timestamp")).cast("string")))
    endpoint = F.when(kind == 3, "/ping").otherwise(F.concat(F.lit("/coins/"), F.col("coin_id"), F.lit("/x")))
    price = F.col("event_id").cast("string")

    def envelope(response):
        parameters = F.to_json(F.struct("vs_currency"))
        return F.to_json(F.struct(endpoint.alias("endpoint"), parameters.alias("parameters"), response.alias("response")))

    rows = market(apply_settings(spark), sf_dir)
    chart = F.concat(F.lit('{"prices":[['), epoch, F.lit(","), price, F.lit("]]}"))
    record = F.when(kind == 4, F.concat(epoch, F.lit(",1"))).otherwise(F.concat(epoch, F.lit(",1,2,0,"), price))
    root = f"{scratch_root(spark)}/landing-{uuid.uuid4().hex}"
    write_lines(rows.select(envelope(chart)), root, "market_chart")
    return write_lines(rows.select(envelope(F.concat(F.lit("[["), record, F.lit("]]")))), root, "ohlc")


# Feature and forecast tables, as stored between the jobs.

def feature_table(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, SeriesLayout]:
    df, layout = market_series(spark, sf_dir)
    return materialize(build_features(df, layout), "features"), layout


def stored_forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The forecasts of the tables as they are now, stored and read again."""
    return materialize(forecast_table(spark, sf_dir)[0], "forecasts")


def forecast_table(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, SeriesLayout]:
    features, layout = feature_table(spark, sf_dir)
    _, predictions = score_all(features, layout)
    return forecasts(predictions, layout), layout


def publish(df: DataFrame, digits: int = 6) -> DataFrame:
    """Results in a comparable form: rounded floats without negative zero, plain timestamps."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DoubleType):
            column = F.round(column, digits) + F.lit(0.0)
        elif isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        columns.append(column.alias(field.name))
    return df.select(*columns)
