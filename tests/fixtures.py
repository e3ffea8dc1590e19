"""Small hand-made series."""

import datetime

import numpy as np

from tidemark.operators.ordering import measure_series

START = datetime.datetime(2024, 1, 1)
SCHEMA = "coin_id string, vs_currency string, timestamp timestamp_ntz, event_id long, price double"
ORDER = ("timestamp", "event_id")


def frame(spark, series):
    """``series``: {(coin, currency): prices} as one row per price, five minutes apart."""
    rows = [
        (coin, currency, START + datetime.timedelta(minutes=5 * i), i, None if p is None else float(p))
        for (coin, currency), prices in series.items() for i, p in enumerate(prices)
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def plain_layout(df):
    return measure_series(df, order_cols=ORDER)


def block_layout(df, rows_per_block=64):
    """Forces the route for long series."""
    return measure_series(df, order_cols=ORDER, plain_limit=1, rows_per_block=rows_per_block)


def examples(seed=7):
    rng = np.random.default_rng(seed)
    ar = np.zeros(300)
    for t in range(1, 300):
        ar[t] = 0.6 * ar[t - 1] + rng.normal()
    return {
        ("noise", "usd"): 50 + rng.normal(size=400),
        ("ar", "usd"): 20 + ar,
        ("walk", "usd"): 100 + np.cumsum(rng.normal(size=500)),
        ("trend", "eur"): np.arange(250) * 0.05 + rng.normal(size=250),
        ("gappy", "eur"): [None if i % 17 == 3 else 10 + float(np.sin(i)) + i % 5 for i in range(200)],
        ("short", "usd"): rng.normal(size=30),
    }


def rows_of(df, digits=8):
    """Rows as sorted plain tuples, floats rounded."""
    def plain(v):
        return round(v, digits) + 0.0 if isinstance(v, float) else v

    return sorted((tuple(plain(v) for v in row) for row in df.collect()), key=str)
