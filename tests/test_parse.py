"""Documents, files and their rows."""

import json
import os

import pytest

from tidemark.operators import parse
from tidemark.operators.dedup import keep_one
from tidemark.sources.landing import peek_with_file, scan_landing

MS = 1700000000123
FIRST, SECOND = (MS, "2023-11-14 22:13:20"), (MS + 300000, "2023-11-14 22:18:20")


def document(endpoint, response, currency="usd", days="1"):
    parameters = json.dumps({k: v for k, v in (("vs_currency", currency), ("days", days)) if v is not None})
    return json.dumps({
        "endpoint": endpoint, "parameters": parameters,
        "response": response if response is None or isinstance(response, str) else json.dumps(response)})


def chart(prices, caps=(), volumes=(), coin="bitcoin", **kwargs):
    body = {"prices": prices, "market_caps": list(caps), "total_volumes": list(volumes)}
    return document(f"/coins/{coin}/market_chart", body, **kwargs)


def write(folder, name, *lines, at=None):
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    if at:
        os.utime(path, (at, at))


def chart_rows(spark, folder, *columns, **kwargs):
    rows = parse.parse_chart(scan_landing(spark, str(folder)), **kwargs).select(*columns).collect()
    return sorted((tuple(r) for r in rows), key=str)


def test_raw_columns(spark, tmp_path):
    write(tmp_path, "a_market_chart.json", "x", "y")
    raw = scan_landing(spark, str(tmp_path))
    assert raw.columns == ["etl_timestamp", "data", "file_path", "file_name", "file_size", "file_modification_time"]
    rows = raw.collect()
    assert sorted(r["data"] for r in rows) == ["x", "y"]
    assert {(r["file_name"], r["file_size"]) for r in rows} == {("a_market_chart.json", 4)}
    assert len({r["etl_timestamp"] for r in rows}) == 1


def test_peek_names_the_file(spark, tmp_path):
    spark.range(20).write.parquet(str(tmp_path / "t"))
    rows = peek_with_file(spark.read.parquet(str(tmp_path / "t")), 3, ["id"]).collect()
    assert [r["id"] for r in rows] == [0, 1, 2] and all("/t/part-" in r["file_path"] for r in rows)


def test_chart_document(spark, tmp_path):
    write(tmp_path, "a_market_chart.json", chart([[FIRST[0], 1.5], [SECOND[0], 2.5]], [[MS, 10]]))
    assert chart_rows(spark, tmp_path, "coin_id", "vs_currency", "days", "timestamp_unix_ms", "timestamp_raw",
                      "price", "market_cap", "total_volume") == [
        ("bitcoin", "usd", "1", *FIRST, 1.5, 10.0, None), ("bitcoin", "usd", "1", *SECOND, 2.5, None, None)]


def test_lines_that_give_no_rows(spark, tmp_path):
    write(tmp_path, "a_market_chart.json", "not json", document("/coins/x/market_chart", None), "",
          chart([]), document("/coins/x/market_chart", {"market_caps": [[MS, 1]]}))
    write(tmp_path, "other.json", chart([[MS, 1.0]]))
    assert chart_rows(spark, tmp_path, "coin_id") == []


def test_points_with_missing_parts(spark, tmp_path):
    write(tmp_path, "a_market_chart.json", chart([[MS, None], [MS + 1], [None, 3.0]]))
    assert chart_rows(spark, tmp_path, "timestamp_unix_ms", "price") == [(MS, None), (MS + 1, None)]


def test_rows_without_coin_or_epoch_are_set_aside(spark, tmp_path):
    write(tmp_path, "a_market_chart.json", document("/ping", {"prices": [[MS, 1.0]]}), chart([[None, 2.0], [MS, 3.0]]))
    documents = parse.chart_documents(scan_landing(spark, str(tmp_path)))
    points = parse.points_of(parse.chart_points(documents), "prices")
    assert sorted(r["price"] for r in parse.quarantine(points).collect()) == [1.0, 2.0]
    assert chart_rows(spark, tmp_path, "coin_id", "price") == [("bitcoin", 3.0)]


def test_same_point_in_two_files_keeps_the_earlier(spark, tmp_path):
    write(tmp_path, "b_market_chart.json", chart([[MS, 1.0]], [[MS, 5]], days="1"), at=1000)
    write(tmp_path, "a_market_chart.json", chart([[MS, 1.0], [MS, 2.0]], [[MS, 7]], days="7"), at=2000)
    assert chart_rows(spark, tmp_path, "price", "days", "market_cap") == [(1.0, "1", 5.0), (2.0, "7", 7.0)]


def test_coins_sharing_a_millisecond(spark, tmp_path):
    write(tmp_path, "a_market_chart.json", chart([[MS, 1.0]], [[MS, 10]]), chart([[MS, 2.0]], coin="ether"))
    assert chart_rows(spark, tmp_path, "coin_id", "market_cap") == [("bitcoin", 10.0), ("ether", None)]
    assert chart_rows(spark, tmp_path, "coin_id", "market_cap", keys=["timestamp_unix_ms"]) == [
        ("bitcoin", 10.0), ("ether", 10.0)]


def test_missing_currency_still_aligns(spark, tmp_path):
    write(tmp_path, "a_market_chart.json", chart([[MS, 1.0]], [[MS, 10]], [[MS, 4]], currency=None))
    assert chart_rows(spark, tmp_path, "vs_currency", "market_cap", "total_volume") == [(None, 10.0, 4.0)]


def test_copies_neither_multiply_nor_mix(spark, tmp_path):
    line = chart([[MS, 1.0]], [[MS, 10]], [[MS, 4]])
    write(tmp_path, "a_market_chart.json", *[line] * 50)
    assert chart_rows(spark, tmp_path, "price", "market_cap", "total_volume") == [(1.0, 10.0, 4.0)]
    aligned = chart_rows(spark, tmp_path, "price", "market_cap", dedup=False)
    assert aligned == [(1.0, 10.0)] * 50


def fan_out(points, caps, volumes):
    """All matches first, one row per (ms, price) after, NULL lowest: the definition."""
    rows = []
    for ms, price in points:
        for cap in [c for m, c in caps if m == ms] or [None]:
            for volume in [v for m, v in volumes if m == ms] or [None]:
                rows.append((ms, price, cap, volume))
    kept = {}
    for row in sorted(rows, key=lambda r: tuple((v is not None, v or 0) for v in r)):
        kept.setdefault(row[:2], row)
    return sorted(kept.values(), key=str)


def test_alignment_equals_join_then_dedup(spark, tmp_path):
    points = [[MS + i % 4, float(i % 3)] for i in range(12)]
    caps = [[MS, 5], [MS, 3], [MS + 1, None], [MS + 1, 2], [MS + 3, 9]]
    volumes = [[MS, 1], [MS + 2, 8], [MS + 2, 7]]
    write(tmp_path, "a_market_chart.json", chart(points, caps, volumes))
    assert chart_rows(spark, tmp_path, "timestamp_unix_ms", "price", "market_cap", "total_volume") == fan_out(
        points, caps, volumes)


def test_ohlc_records(spark, tmp_path):
    write(tmp_path, "btc_ohlc.json", document("/coins/bitcoin/ohlc", [
        [MS, 1, 2, 3, 4], [MS, 1, 2, 3, 4], [MS + 1, 1, 2, 3], [MS + 2, 5, 6, 7, 8, 9]]))
    rows = parse.parse_ohlc(scan_landing(spark, str(tmp_path))).orderBy("timestamp_unix_ms").collect()
    assert [(r["timestamp_unix_ms"], r["open_price"], r["close_price"]) for r in rows] == [
        (MS, 1.0, 4.0), (MS + 2, 5.0, 8.0)]
    assert rows[0]["timestamp_raw"] == FIRST[1]


def test_keep_one_orders(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "w"), ("b", None, "z")], "k string, t int, v string")
    def kept(keep):
        return sorted((r["k"], r["v"]) for r in keep_one(df, ["k"], ["t"], keep).collect())

    assert kept("first") == [("a", "x"), ("b", "z")]
    assert kept("last") == [("a", "w"), ("b", "z")]
    with pytest.raises(ValueError):
        keep_one(df, ["k"], ["t"], "middle")


def test_copies_meet_before_the_shuffle(spark):
    df = spark.range(10).selectExpr("id % 2 AS coin_id", "id AS etl_timestamp")
    plan = keep_one(df, ["coin_id"])._jdf.queryExecution().executedPlan().toString()
    below_exchange = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in below_exchange and "Partial" in below_exchange
