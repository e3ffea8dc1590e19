"""Documents read in blocks give the same rows as documents read whole."""

import json
import os
import tempfile

import pytest

from tidemark.operators.parse import chart_documents, chart_points, parse_chart
from tidemark.operators.split_parse import parse_chart_files, split_points
from tidemark.sources.landing import scan_landing

COLUMNS = ("endpoint", "coin_id", "vs_currency", "days", "field", "timestamp_unix_ms", "value", "file_name")


def document(coin="a", prices=(), caps=(), volumes=(), spaces=False, tail=False, **more):
    gap = (", ", ": ") if spaces else (",", ":")
    payload = {"prices": prices, "market_caps": caps, "total_volumes": volumes, **more}
    response = json.dumps({k: v for k, v in payload.items() if v is not None}, separators=gap)
    head = {"endpoint": f"/coins/{coin}/market_chart", "parameters": json.dumps({"vs_currency": "usd", "days": "1"}, separators=gap)}
    parts = {"response": response, **head} if tail else {**head, "response": response}
    return json.dumps(parts, separators=gap)


def rows_of(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


LINES = [
    document("a", [[1, 1.5], [2, None], [3, -2e-7]], [[1, 7.0]], [[3, 9]]),
    document("b", [[1, 1.5]], [], None, spaces=True),
    document("c", [], [[5, 6]], [[5, 7], [6, 8, 9]], tail=True),
    document("d", [[1]], [[2, 3]], other=[[1, 99], [2, 98]]),
    document("e", None, None, None), json.dumps({"endpoint": "/coins/f/market_chart", "parameters": None, "response": None}),
    json.dumps({"endpoint": "/ping", "response": json.dumps({"prices": [[1, 2]]})}),
    document("g", [["NaN", 1.0], [1e300, 2.0], [4, 5.0]]), document('quoted "h"', [[8, 1.0]]), "",
    document("i", [[k, k / 7] for k in range(5000)], [[k, k * 2.0] for k in range(5000)], [[k, 1.0] for k in range(4000)]),
]


@pytest.mark.parametrize("block", [None, 3000])
def test_points_equal_those_of_whole_documents(spark, block):
    folder = tempfile.mkdtemp(prefix="split-")
    for n in range(2):
        os.makedirs(f"{folder}/{n}")
        with open(f"{folder}/{n}/market_chart-{n}.txt", "w") as out:
            out.write("\n".join(LINES[n:]) + ("\n" if n else ""))
    with open(f"{folder}/ohlc.txt", "w") as out:
        out.write(LINES[0])
    settings = {} if block is None else {"spark.sql.files.maxPartitionBytes": str(block), "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k) for k in settings}
    whole = rows_of(chart_points(chart_documents(scan_landing(spark, folder))), *COLUMNS)
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        assert rows_of(split_points(spark, folder), *COLUMNS) == whole
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_one_line_of_many_megabytes_is_read_by_many_tasks(spark):
    folder = tempfile.mkdtemp(prefix="split-")
    points = [[1_700_000_000_000 + 1000 * k, k / 7] for k in range(250_000)]
    with open(f"{folder}/market_chart.txt", "w") as out:
        out.write(document("a", points, points[::2], points[::3]))
    size = os.path.getsize(f"{folder}/market_chart.txt")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    whole = parse_chart(scan_landing(spark, folder))
    names = ("coin_id", "vs_currency", "timestamp_unix_ms", "price", "market_cap", "total_volume")
    expected = rows_of(whole, *names)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 20))
    try:
        scan = spark.read.option("lineSep", "],").text(folder)
        assert scan.rdd.getNumPartitions() >= size >> 20
        assert rows_of(parse_chart_files(spark, folder, whole_bytes=1 << 20), *names) == expected
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    # Small files take the other way.
    assert rows_of(parse_chart_files(spark, folder), *names) == expected


def test_no_files_of_either_size(spark):
    folder = tempfile.mkdtemp(prefix="split-")
    with open(f"{folder}/market_chart.txt", "w") as out:
        out.write("\n")
    for limit in (0, 1000):
        assert parse_chart_files(spark, folder, whole_bytes=limit).count() == 0
