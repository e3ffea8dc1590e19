"""Queries see the tables as they are when they are called."""

from pyspark.sql import functions as F

from workload.market import land_documents

SF_DIR = "/root/testdata/sf0.001"


def test_rewritten_tables_are_landed_again(spark, tmp_path):
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    events.write.parquet(f"{tmp_path}/events.parquet")
    first = land_documents(spark, str(tmp_path), "market_chart")
    kept = events.filter(F.col("event_id") % 50 == 0)
    kept.write.mode("overwrite").parquet(f"{tmp_path}/events.parquet")
    second = land_documents(spark, str(tmp_path), "market_chart")
    assert first != second
    after = spark.read.text(f"{second}/*")
    prices = after.select(F.explode(F.from_json(F.get_json_object("value", "$.response.prices"), "array<string>"))).count()
    assert prices < events.count()
