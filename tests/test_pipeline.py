"""Tables, the whole job, and incremental landing."""

import datetime

import pytest
from test_parse import MS, chart, document, write

from tidemark.operators import quality, series
from tidemark.plans import pipeline
from tidemark.session import materialize, scratch_root
from tidemark.sources.landing import scan_landing
from tidemark.sources.tables import create_layers, load_source, replace_from_query, row_count, save_table
from tidemark.streaming.landing import land_new_files


@pytest.fixture(scope="module")
def namespace(spark):
    prefix = "tide_test"
    create_layers(spark, prefix)
    yield pipeline.Tables(prefix)
    for name in create_layers(spark, prefix):
        spark.sql(f"DROP DATABASE {name} CASCADE")


def test_save_replaces_rows_and_schema(spark, namespace):
    name = namespace.raw
    assert save_table(spark.range(3), name, "it's a table").count() == 3
    assert "it's a table" in str(spark.sql(f"DESCRIBE EXTENDED {name}").collect())
    replaced = replace_from_query(spark, name, "SELECT 'x' AS word, 1.5 AS number")
    assert replaced.columns == ["word", "number"] and row_count(replaced).first()["row_count"] == 1
    assert load_source(spark, name, ["word"]).columns == ["word"]


def test_scan_reads_listed_columns_only(spark, namespace):
    save_table(spark.range(3).selectExpr("id", "id AS other", "id AS third"), namespace.chart)
    plan = load_source(spark, namespace.chart, ["other"])._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<other:bigint>" in plan


def test_whole_job(spark, namespace, tmp_path):
    points = {
        coin: [[MS + 300_000 * i, base + (i * 7 % 11)] for i in range(60)] for coin, base in (("bitcoin", 100.0), ("ether", 10.0))}
    for coin, prices in points.items():
        write(tmp_path, f"{coin}_market_chart.json", chart(prices, [[ms, 5 * p] for ms, p in prices], coin=coin))
    write(tmp_path, "again_market_chart.json", chart(points["bitcoin"][:30], coin="bitcoin", days="7"), at=4_000_000_000)
    write(tmp_path, "btc_ohlc.json", document("/coins/bitcoin/ohlc", [[MS, 1, 2, 3, 4]]))
    performance, forecasts = pipeline.run(spark, str(tmp_path), namespace, namespace)
    assert spark.table(namespace.chart).count() == 120 and spark.table(namespace.ohlc).count() == 1
    rows = {r["coin_id"]: r for r in performance.collect()}
    assert {c: (r["train_rows"], r["test_rows"]) for c, r in rows.items()} == {"bitcoin": (38, 10), "ether": (38, 10)}
    assert rows["ether"]["model_path"] == "models/ether_usd_linear_regression"
    assert forecasts.count() == 96
    assert spark.table(namespace.coefficients).count() == 2
    train_only = spark.table(namespace.features).filter("dataset_type = 'train'")
    assert "PartitionFilters: [isnotnull(dataset_type" in train_only._jdf.queryExecution().executedPlan().toString()


def test_new_files_land_once(spark, tmp_path):
    landing, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "state"))
    (tmp_path / "in").mkdir()

    def run():
        land_new_files(spark, landing, target, checkpoint, files_per_batch=1).awaitTermination(120)
        return sorted(r["data"] for r in spark.read.parquet(target).collect())

    write(landing, "a_market_chart.json", "one", "two")
    assert run() == ["one", "two"]
    write(landing, "b_market_chart.json", "three")
    assert run() == ["one", "three", "two"]
    assert run() == ["one", "three", "two"]
    batch = scan_landing(spark, landing)
    landed = spark.read.parquet(target)
    assert landed.columns == batch.columns
    assert sorted(landed.drop("etl_timestamp").collect()) == sorted(batch.drop("etl_timestamp").collect())


def test_scratch_is_the_checkpoint_folder(spark):
    assert scratch_root(spark) == spark.sparkContext.getCheckpointDir()
    folder = scratch_root(spark).removeprefix("file:").lstrip("/")
    assert f"/{folder}/stage-" in materialize(spark.range(5)).inputFiles()[0]


def test_cluster_without_shared_folder_is_an_error():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, _key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(Session())


def test_bad_text_becomes_null(spark):
    df = spark.createDataFrame([("2024-01-01 00:05:00",), ("bad",), (None,)], "timestamp string")
    parsed = quality.parse_timestamps(df)
    assert parsed.columns == ["timestamp_raw", "timestamp"]
    assert tuple(quality.timestamp_parse_report(parsed).first()) == (3, 1, 1)


def test_gap_of_an_hour(spark):
    from fixtures import START, frame, plain_layout
    from pyspark.sql import functions as F

    df = frame(spark, {("a", "usd"): range(10)}).filter(~F.col("event_id").between(3, 13)).unionByName(
        spark.createDataFrame([("a", "usd", START + datetime.timedelta(minutes=70), 14, 0.0)],
                              "coin_id string, vs_currency string, timestamp timestamp_ntz, event_id long, price double"))
    intervals = series.add_intervals(df, plain_layout(df))
    assert [r["interval_minutes"] for r in series.time_gaps(intervals).collect()] == [60.0]
