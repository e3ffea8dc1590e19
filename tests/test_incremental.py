"""What loads extend equals what one build over all rows gives."""

import datetime
import random
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import moments, series, sketches
from tidemark.operators.models import fit_models, scaled_names, score_all
from tidemark.operators.features import build_features, scaling_stats, train_rows
from tidemark.operators.monitoring import control_limits
from tidemark.operators.ordering import measure_series
from tidemark.operators.parse import parse_chart
from tidemark.operators.refresh import FeatureStore
from tidemark.sources.landing import scan_landing
from tidemark.sources.tables import touched
from tidemark.streaming.ingest import add_batch, ingest_chart, ingested
from tidemark.operators.dedup import CHART_KEY
from workload import market as m

START = datetime.datetime(2024, 3, 1)
ORDER = ("timestamp", "price")


def rows_of(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


# Keyed ingest

def envelope(coin, currency, points):
    import json

    payload = {"prices": [[t, p] for t, p in points], "market_caps": [[t, 2 * p] for t, p in points], "total_volumes": [[t, 3 * p] for t, p in points]}
    parameters = {"days": "1"} if currency is None else {"vs_currency": currency, "days": "1"}
    return json.dumps({"endpoint": f"/coins/{coin}/market_chart", "parameters": json.dumps(parameters), "response": json.dumps(payload)})


POINTS = ["coin_id", "vs_currency", "timestamp_unix_ms", "price", "market_cap", "total_volume"]


def test_runs_with_overlapping_files_equal_one_batch(spark):
    root = tempfile.mkdtemp(prefix="ingest-")
    day = 86_400_000
    first = [(day * d + 1000 * k, float(10 * d + k)) for d in range(3) for k in range(5)]
    arrivals = [
        [("a", "usd", first), ("a", None, first[:4])],
        [("a", "usd", first[8:] + [(day * 9, 1.0)]), ("b", "usd", first), ("a", None, first[2:6])],
        [("a", "usd", [(t, p + 1) for t, p in first[:2]] + first[:2])],     # corrections, and what they correct
    ]
    added = []
    for n, some in enumerate([*arrivals, [], []]):
        if some:
            text = spark.createDataFrame([(envelope(*x),) for x in some], "value string").coalesce(1)
            m.write_lines(text, f"{root}/in", f"market_chart-{n}")
        ingest_chart(spark, f"{root}/in", f"{root}/out", f"{root}/state").awaitTermination()
        added.append(ingested(spark, f"{root}/out").count())
    once = parse_chart(scan_landing(spark, f"{root}/in"))
    assert rows_of(ingested(spark, f"{root}/out"), *POINTS) == rows_of(once, *POINTS)
    # The second run adds what is new in it, the third its two corrections, runs without files nothing.
    assert added == [19, 19 + 1 + 15 + 2, 39, 39, 39]


def test_a_batch_that_runs_again_adds_nothing(spark):
    root = tempfile.mkdtemp(prefix="ingest-")
    m.write_lines(spark.createDataFrame([(envelope("a", "usd", [(1, 1.0), (2, 2.0)]),)], "value string"), f"{root}/in", "market_chart")
    raw = scan_landing(spark, f"{root}/in")
    for batch in (0, 0, 1, 1, 0):
        add_batch(raw, batch, f"{root}/out", parse_chart, CHART_KEY)
        assert rows_of(ingested(spark, f"{root}/out"), "timestamp_unix_ms", "batch") == [(1, 0), (2, 0)]


def test_a_batch_without_points_leaves_no_table(spark):
    root = tempfile.mkdtemp(prefix="ingest-")
    m.write_lines(spark.createDataFrame([("not json",)], "value string"), f"{root}/in", "market_chart")
    add_batch(scan_landing(spark, f"{root}/in"), 0, f"{root}/out", parse_chart, CHART_KEY)
    m.write_lines(spark.createDataFrame([(envelope("a", "usd", [(1, 1.0)]),)], "value string"), f"{root}/in", "market_chart")
    add_batch(scan_landing(spark, f"{root}/in"), 1, f"{root}/out", parse_chart, CHART_KEY)
    assert ingested(spark, f"{root}/out").count() == 1


@pytest.mark.parametrize("limit", [1000, 2])
def test_only_touched_partitions_are_read(spark, limit):
    path = tempfile.mkdtemp(prefix="days-") + "/t"
    spark.range(100).withColumn("day", (F.col("id") % 10).cast("int")).write.partitionBy("day").parquet(path)
    wanted = spark.createDataFrame([(3,), (4,), (4,), (5,)], "day int")
    found = touched(spark.read.parquet(path), "day", wanted, limit)
    assert sorted(r["day"] for r in found.select("day").distinct().collect()) == [3, 4, 5]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


# Features

def random_rows(seed, n, per_day, coins=("a", None, "c")):
    draw = random.Random(seed)
    return [(draw.choice(coins), draw.choice(["usd", None]), START + datetime.timedelta(days=k // per_day, minutes=draw.randint(0, 1439)),
             round(draw.uniform(1, 9), 3), k) for k in range(n)]


FIELDS = "coin_id string, vs_currency string, timestamp timestamp_ntz, price double, id long"


@pytest.mark.parametrize("seed,per_day,long", [(1, 40, False), (2, 6, False), (3, 2, False), (4, 6, True)])
def test_loads_in_any_order_equal_one_build(spark, seed, per_day, long):
    """Loads with late rows everywhere; with few rows a day, look-backs reach over many days."""
    rows = random_rows(seed, 400, per_day)
    draw = random.Random(seed + 100)
    load_of = [0 if k < 200 else 1 if k < 360 else 3 for k in range(400)]
    load_of = [draw.choice([0, 1, 2, 3]) if draw.random() < .1 else x for x in load_of]
    order = (*ORDER, "id")
    store = FeatureStore(tempfile.mkdtemp(prefix="store-") + "/s", order_cols=order, plain_limit=1 if long else None)
    for load in range(4):
        some = [r for r, x in zip(rows, load_of) if x == load]
        store.refresh(spark.createDataFrame(some, FIELDS), load)
    # A load that runs again changes nothing.
    store.refresh(spark.createDataFrame([r for r, x in zip(rows, load_of) if x == 3], FIELDS), 3)
    every = spark.createDataFrame(rows, FIELDS)
    layout = measure_series(every, order_cols=order)
    names = ["coin_id", "vs_currency", "timestamp", "price", "id", *series.lag_names("price")]
    assert rows_of(store.current(spark), *names) == rows_of(series.add_lags(every, layout), *names)


def test_a_load_of_newer_rows_reads_the_tail_only(spark):
    rows = [("a", "usd", START + datetime.timedelta(minutes=30 * k), float(k), k) for k in range(48 * 20)]
    store = FeatureStore(tempfile.mkdtemp(prefix="store-") + "/s", order_cols=ORDER)
    store.refresh(spark.createDataFrame(rows[:48 * 19], FIELDS), 0)
    plan = store.refresh(spark.createDataFrame(rows[48 * 19:], FIELDS), 1).collect()
    assert sum(r["_needed"] for r in plan) == 1 and sum(r["_dirty"] for r in plan) == 1
    # A late row opens its day again, and reads the day before.
    late = [("a", "usd", START + datetime.timedelta(days=5, minutes=7), 5.5, -1)]
    plan = store.refresh(spark.createDataFrame(late, FIELDS), 2).collect()
    dirty, needed = ([r["_day"] for r in plan if r[c]] for c in ("_dirty", "_needed"))
    first = min(r["_day"] for r in plan)
    assert sorted(dirty) == [first + 5, first + 6] and sorted(needed) == [first + 4, first + 5, first + 6]


def test_an_empty_load_and_rows_without_time(spark):
    store = FeatureStore(tempfile.mkdtemp(prefix="store-") + "/s", order_cols=ORDER)
    store.refresh(spark.createDataFrame([("a", "usd", START, 1.0, 1)], FIELDS), 0)
    store.refresh(spark.createDataFrame([("a", "usd", None, 1.0, 1)], FIELDS), 1)
    store.refresh(spark.createDataFrame([], FIELDS), 2)
    assert store.current(spark).count() == 1


# Moments

def close(found, expected, tolerance=1e-9):
    assert len(found) == len(expected)
    for a, b in zip(found, expected):
        assert len(a) == len(b)
        for x, y in zip(a, b):
            if isinstance(x, float) and isinstance(y, float):
                assert abs(x - y) <= tolerance * max(1.0, abs(y))
            else:
                assert x == y


@pytest.mark.parametrize("offset", [0.0, 1e6])
def test_merged_moments_equal_a_full_fit(spark, offset):
    draw = np.random.default_rng(4)
    data = draw.normal(size=(600, 3)) + offset
    data[:, 2] = 2 * data[:, 0] - data[:, 1] + draw.normal(size=600) * .1
    rows = spark.createDataFrame([("a" if k % 3 else None, "usd", k % 7, *map(float, x)) for k, x in enumerate(data)],
                                 "coin_id string, vs_currency string, part int, x double, y double, price double")
    by = ["coin_id", "vs_currency"]
    parts = moments.part_moments(rows, ["x", "y", "price"], [*by, "part"])
    # Merging in any grouping gives the same.
    half = moments.merge_moments(parts.filter("part < 3"), by).unionByName(parts.filter("part >= 3").drop("part"))
    for merged in (moments.merge_moments(parts, by), moments.merge_moments(half, by)):
        close(rows_of(moments.scaling_from(merged, ["x", "y"]), *by, "x_mean", "y_mean", "x_std", "y_std"),
              rows_of(scaling_stats(rows, ["x", "y"]), *by, "x_mean", "y_mean", "x_std", "y_std"))
        stats = scaling_stats(rows, ["x", "y"])
        joined = rows.alias("r").join(stats.alias("s"), F.col("r.coin_id").eqNullSafe(F.col("s.coin_id")))
        scaled = joined.select("r.*", ((F.col("x") - F.col("x_mean")) / F.col("x_std")).alias("xs"), ((F.col("y") - F.col("y_mean")) / F.col("y_std")).alias("ys"))
        expected = fit_models(scaled, ["xs", "ys"])
        fitted = moments.fit_from(merged, ["x", "y"])
        one = [(*r[:3], r["intercept"], *r["coefficients"]) for r in sorted(fitted.collect(), key=repr)]
        two = [(*r[:3], r["intercept"], *r["coefficients"]) for r in sorted(expected.collect(), key=repr)]
        close(one, two, 1e-9 if not offset else 1e-8)


def test_store_gives_the_limits_of_a_full_fit(spark):
    rows = random_rows(9, 900, 30, coins=("a", "b"))
    order = (*ORDER, "id")
    store = FeatureStore(tempfile.mkdtemp(prefix="store-") + "/s", order_cols=order)
    for load, (a, b) in enumerate(((0, 500), (500, 900))):
        store.refresh(spark.createDataFrame(rows[a:b], FIELDS), load)
    every = spark.createDataFrame(rows, FIELDS)
    layout = measure_series(every, order_cols=order)
    features = build_features(every, layout)
    fitted, predictions = score_all(features, layout)
    names = ["coin_id", "vs_currency", "residual_std", "lcl", "ucl"]
    mine = moments.fit_from(store.train_moments(spark), store.names)
    close(rows_of(moments.limits_from(mine), *names), rows_of(control_limits(train_rows(predictions)), *names))
    close(rows_of(mine, "coin_id", "vs_currency", "train_rows", "intercept"), rows_of(fitted, "coin_id", "vs_currency", "train_rows", "intercept"))
    assert scaled_names()[0] == "price_lag_1_scaled"


def test_a_feature_without_spread_merges(spark):
    rows = spark.createDataFrame([("a", "usd", 1.0, float(k)) for k in range(5)], "coin_id string, vs_currency string, x double, price double")
    fitted = moments.fit_from(moments.merge_moments(moments.part_moments(rows, ["x", "price"])), ["x"]).first()
    assert fitted["coefficients"] == [0.0] and fitted["intercept"] == 2.0 and abs(fitted["residual_std"] - np.std(range(5), ddof=1)) < 1e-12


# Sketches

@pytest.mark.parametrize("kind", ["uniform", "ties", "skewed"])
def test_merged_sketches_keep_their_bound(spark, kind):
    column = {"uniform": F.rand(3), "ties": F.floor(F.rand(3) * 7), "skewed": F.exp(F.randn(3) * 5)}[kind]
    rows = spark.range(200_000).select(
        F.when(F.col("id") % 3 == 0, "a").alias("coin_id"), F.lit("usd").alias("vs_currency"), (F.col("id") % 60).alias("d"),
        column.cast("double").alias("price"))
    rows = rows.cache()
    table = sketches.daily_sketches(rows, "price", F.col("d"))
    found = sketches.quantiles(sketches.merged(table), {"p01": 0.01, "median": 0.5, "p99": 0.99})
    off = sketches.rank_distance(rows, "price", found, {"p01": 0.01, "median": 0.5, "p99": 0.99}).collect()
    assert len(off) == 2 and sum(r["n"] for r in off) == 200_000
    assert all(r[q] <= sketches.rank_error() for r in off for q in ("p01", "median", "p99"))
    assert table.agg(F.max(F.length("sketch"))).first()[0] < 16_000
    rows.unpersist()
