"""Run rules, residual drift and the regular grid, against plain Python."""

import collections
import datetime
import random

import numpy as np
import pytest

from tidemark.operators import grid, runs
from tidemark.operators.ordering import measure_series

START = datetime.datetime(2024, 3, 1)


def forecast_rows(seed, n):
    """Two series with long stretches on one side, values on the mean, NULL residuals and equal times."""
    draw = random.Random(seed)
    out = []
    for coin in ("a", None):
        side = 1
        for k in range(n):
            side = -side if draw.random() < .08 else side
            residual = draw.choice([None, 0.0]) if draw.random() < .05 else side * abs(draw.gauss(0, 1.3))
            out.append((coin, "usd", START + datetime.timedelta(minutes=k // 2), "train" if k < .8 * n else "test", float(k), residual, 0.0, 1.0))
    return out


SCHEMA = ("coin_id string, vs_currency string, timestamp timestamp_ntz, dataset_type string, price double, residual double, "
          "residual_mean double, residual_std double")


def brute_runs(rows):
    out, series = [], collections.defaultdict(list)
    for r in rows:
        series[r[0]].append(r)
    for some in series.values():
        some.sort(key=lambda r: (r[2], r[4]))
        z = [r[5] for r in some]
        run, last = 0, None
        for k, r in enumerate(some):
            side = 0 if z[k] is None else int(np.sign(z[k]))
            run = 0 if side == 0 else run + 1 if side == last else 1
            last = side
            flags = [z[k] is not None and abs(z[k]) > 3]
            for points, of, deviations in runs.NEAR_RULES.values():
                flags.append(any(z[k] is not None and s * z[k] > deviations and sum(
                    x is not None and s * x > deviations for x in z[max(0, k - of + 1):k + 1]) >= points for s in (1, -1)))
            out.append((r[0], r[4], run, *flags, run >= 8))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [None, 8, 64])
def test_control_runs(spark, block):
    """With blocks of 8 rows, most runs reach over the edges of several blocks."""
    rows = forecast_rows(5, 300)
    df = spark.createDataFrame(rows, SCHEMA)
    limits = {} if block is None else {"plain_limit": 1, "rows_per_block": block}
    layout = measure_series(df, order_cols=runs.RUN_ORDER, **limits)
    got = runs.control_runs(df, layout).select("coin_id", "price", "side_run", *runs.RULES)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_runs(rows)
    assert max(r[2] for r in brute_runs(rows)) > 24


def test_run_summary(spark):
    df = spark.createDataFrame(forecast_rows(6, 100), SCHEMA)
    found = runs.control_runs(df, measure_series(df, order_cols=runs.RUN_ORDER))
    table = runs.run_summary(found).collect()
    assert len(table) == 4 and sum(r["observations"] for r in table) == 200


@pytest.mark.parametrize("block", [None, 8])
def test_drift_is_the_two_sample_statistic(spark, block):
    rows = forecast_rows(7, 200) + [("one side", "usd", START, "train", 1.0, 0.5, 0.0, 1.0), ("nothing", "usd", START, "test", 1.0, None, 0.0, 1.0)]
    rows += [("moved", "usd", START, side, float(k), k % 9 + (3.0 if side == "test" else 0.0), 0.0, 1.0) for side in ("train", "test") for k in range(90)]
    df = spark.createDataFrame(rows, SCHEMA)
    limits = {} if block is None else {"plain_limit": 1, "rows_per_block": block}
    got = {r["coin_id"]: r for r in runs.drift(df, measure_series(df, order_cols=runs.RUN_ORDER, **limits)).collect()}
    for coin in ("a", None, "moved"):
        x, y = (np.array([r[5] for r in rows if r[0] == coin and r[3] == side and r[5] is not None]) for side in ("train", "test"))
        at = np.concatenate([x, y])
        d = max(abs((x <= v).mean() - (y <= v).mean()) for v in at)
        root = np.sqrt(len(x) * len(y) / (len(x) + len(y)))
        lam = (root + .12 + .11 / root) * d
        p = 1.0 if lam < .2 else min(1.0, max(0.0, 2 * sum((-1) ** (k - 1) * np.exp(-2 * k * k * lam * lam) for k in range(1, 101))))
        assert got[coin]["ks_statistic"] == pytest.approx(d, abs=1e-12) and got[coin]["p_value"] == pytest.approx(p, abs=1e-12)
    assert got["moved"]["drift"] and (got["one side"]["n_train"], got["one side"]["ks_statistic"], got["one side"]["drift"]) == (1, None, None)
    assert "nothing" not in got


def brute_grid(rows, minutes=5):
    series, out = collections.defaultdict(list), []
    for coin, _, at, price, k in rows:
        if at is not None:
            series[coin].append((at, k, price))
    step, zero = datetime.timedelta(minutes=minutes), datetime.datetime(1970, 1, 1)
    for coin, some in series.items():
        some.sort()
        at = zero - (zero - some[0][0]) // step * step
        while at <= some[-1][0]:
            seen = max(x for x in some if x[0] <= at)
            out.append((coin, at, seen[2], (at - seen[0]) // datetime.timedelta(microseconds=1)))
            at += step
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [None, 4])
def test_regular_grid(spark, block, monkeypatch):
    """Gaps of minutes and of days, rows on a step, equal times, NULL prices, times before 1970, one row alone."""
    monkeypatch.setattr(grid, "STEPS_AT_ONCE", 16)
    draw = random.Random(8)
    rows, at = [], START
    for k in range(60):
        at += draw.choice([datetime.timedelta(minutes=5), datetime.timedelta(seconds=draw.randint(0, 400)), datetime.timedelta(hours=9), datetime.timedelta(0)])
        rows.append((draw.choice(["a", None]), "usd", at, draw.choice([None, float(k)]), k))
    rows += [("alone", "usd", START, 1.0, 0), ("off", "usd", START + datetime.timedelta(seconds=1), 1.0, 0), ("no time", "usd", None, 1.0, 0),
             ("old", "usd", datetime.datetime(1969, 12, 31, 23, 41, 7), 1.0, 0), ("old", "usd", datetime.datetime(1970, 1, 1, 0, 7), 2.0, 1),
             ("end", "usd", START, 1.0, 0), ("end", "usd", START, 2.0, 1), ("end", "usd", START + datetime.timedelta(minutes=10), 3.0, 2)]
    df = spark.createDataFrame(rows, "coin_id string, vs_currency string, timestamp timestamp_ntz, price double, id long")
    limits = {} if block is None else {"plain_limit": 1, "rows_per_block": block}
    layout = measure_series(df, order_cols=("timestamp", "id"), **limits)
    got = grid.regular_grid(df, layout).select("coin_id", "grid_timestamp", "price", "micros_old")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_grid(rows)
