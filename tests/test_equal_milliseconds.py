"""Points of one series that share a millisecond keep the market cap and volume that stand beside them."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators.dedup import CHART_KEY
from tidemark.operators.parse import parse_chart
from tidemark.operators.split_parse import parse_chart_files
from tidemark.sources.landing import scan_landing
from tidemark.streaming.ingest import add_batch, ingested
from workload import market as m
from workload.queries import QUERIES

MS = 1_700_000_000_000
COLUMNS = ("timestamp_unix_ms", "price", "market_cap", "total_volume")


def line(points, caps=None, volumes=None, currency="usd"):
    body = {"prices": [[t, p] for t, p, _, _ in points],
            "market_caps": [[t, c] for t, _, c, _ in points] if caps is None else caps,
            "total_volumes": [[t, v] for t, _, _, v in points] if volumes is None else volumes}
    parameters = {"vs_currency": currency, "days": "1"} if currency else {"days": "1"}
    return json.dumps({"endpoint": "/coins/a/market_chart", "parameters": json.dumps(parameters), "response": json.dumps(body)})


FIRST = [(MS, 1.0, 90.0, 7.0), (MS, 2.0, 20.0, 8.0), (MS + 1, 3.0, None, 1.0), (MS + 1, 4.0, 5.0, None)]
SECOND = [(MS, 5.0, 50.0, 0.5), (MS + 9, 6.0, 60.0, 2.0)]  # another document of the same file, the same time


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def write(folder, *lines):
    (folder / "market_chart.json").write_text("\n".join(lines) + "\n")
    return str(folder)


@pytest.mark.parametrize("currency", ["usd", None])
@pytest.mark.parametrize("route", ["whole", "blocks", "small blocks", "keyed"])
def test_each_point_keeps_its_own_values(spark, tmp_path, route, currency):
    (tmp_path / "in").mkdir()
    path = write(tmp_path / "in", line(FIRST, currency=currency), line(SECOND, currency=currency), line(FIRST, currency=currency))
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        if route == "whole":
            found = parse_chart(scan_landing(spark, path))
        elif route == "keyed":
            add_batch(scan_landing(spark, path), 0, str(tmp_path / "out"), parse_chart, CHART_KEY)
            found = ingested(spark, str(tmp_path / "out"))
        else:
            if route == "small blocks":
                spark.conf.set("spark.sql.files.maxPartitionBytes", "100")
                spark.conf.set("spark.sql.files.openCostInBytes", "0")
            found = parse_chart_files(spark, path, whole_bytes=0)
        assert rows_of(found) == sorted(FIRST + SECOND, key=str)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_other_numbers_of_points_take_the_lowest(spark, tmp_path):
    """Two caps for three prices have no order to go by; the volumes have."""
    points = [(MS, 1.0, None, 3.0), (MS, 2.0, None, 2.0), (MS, 3.0, None, 1.0)]
    path = write(tmp_path, line(points, caps=[[MS, 9], [MS, 8]]))
    assert rows_of(parse_chart(scan_landing(spark, path))) == [(MS, 1.0, 8.0, 3.0), (MS, 2.0, 8.0, 2.0), (MS, 3.0, 8.0, 1.0)]


@pytest.mark.parametrize("name", ["parse_chart", "split_chart", "incremental_chart", "incremental_chart_no_currency"])
def test_queries_over_events_at_equal_times(spark, tmp_path, name):
    """Every second event has the time of the one before it."""
    rows = spark.range(600).select(
        F.col("id").alias("event_id"),
        (F.timestamp_millis(MS + F.floor(F.col("id") / 2) * 1000)).cast("timestamp_ntz").alias("ts"),
        (F.col("id") * 7 % 13).alias("user_id"), F.lit("view").alias("event_type"),
        (F.col("id") % 50 + F.col("id") % 2 * 0.5 + 2).cast("double").alias("value"), F.lit("{}").alias("props"))
    rows.write.parquet(f"{tmp_path}/events.parquet")
    wanted = m.market(spark, str(tmp_path))
    if name.startswith("incremental"):
        wanted = wanted.unionByName(wanted.filter("event_id % 25 = 0").withColumn("price", F.col("price") + 1))
    wanted = wanted.select(F.unix_millis(F.col("timestamp").cast("timestamp")).alias("timestamp_unix_ms"), *COLUMNS[1:])
    assert rows_of(QUERIES[name](spark, str(tmp_path))) == rows_of(wanted)
