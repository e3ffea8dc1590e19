"""For each query, SQL that gives the same rows from the same tables."""

from __future__ import annotations

LAGS = (1, 2, 3, 6, 12)
G = "coin_id, vs_currency"
W = "PARTITION BY coin_id, vs_currency ORDER BY timestamp, event_id"
LAG_COLUMNS = ", ".join(f"price_lag_{k}" for k in LAGS)
ORACLES: dict[str, str] = {}


def r(expression: str, name: str | None = None) -> str:
    """A rounded float without negative zero, under its own or the given name."""
    return f"round({expression}, 6) + 0.0 AS {name or expression}"


def rs(names: str) -> str:
    """Several rounded columns under their own names."""
    return ", ".join(r(n.strip()) for n in names.split(","))


# Views of the tables.

MARKET = """market AS (
  SELECT event_type AS coin_id, CASE WHEN user_id % 2 = 0 THEN 'usd' ELSE 'eur' END AS vs_currency,
         ts AS timestamp, event_id, value AS price, value * (user_id + 1) AS market_cap,
         value * (event_id % 97 + 1) AS total_volume
  FROM events)"""

LOADS = MARKET + """,
load_rows AS (
  SELECT *, 1 AS load FROM market
  UNION ALL SELECT *, 2 FROM market WHERE event_id % 10 = 0
  UNION ALL SELECT * REPLACE (price + 1 AS price), 2 FROM market WHERE event_id % 25 = 0),
loads AS (
  SELECT coin_id, vs_currency, event_id,
         CASE WHEN event_id % 103 = 0 THEN NULL WHEN event_id % 101 = 0 THEN 'bad'
              ELSE strftime(timestamp, '%Y-%m-%d %H:%M:%S') END AS timestamp_raw,
         epoch_us(timestamp) // 1000 AS timestamp_unix_ms, price,
         CASE WHEN event_id % 13 <> 0 THEN market_cap END AS market_cap, total_volume,
         timestamp + load * INTERVAL 1 DAY AS etl_timestamp, load
  FROM load_rows),
parsed AS (
  SELECT *, try_strptime(timestamp_raw, '%Y-%m-%d %H:%M:%S') AS timestamp FROM loads)"""

OHLC = LOADS + """,
ohlc AS (
  SELECT coin_id, vs_currency, timestamp_unix_ms, timestamp, price AS open_price, price * 1.02 AS high_price,
         price * 0.98 AS low_price, price + (event_id % 5 - 2) * 0.01 * price AS close_price, etl_timestamp, load
  FROM parsed)"""

HISTORY = LOADS + """,
history AS (
  SELECT * FROM (
    SELECT coin_id, timestamp, price, market_cap, total_volume, vs_currency,
           row_number() OVER (PARTITION BY coin_id, timestamp
             ORDER BY etl_timestamp DESC, price NULLS FIRST, market_cap NULLS FIRST, total_volume NULLS FIRST,
                      vs_currency NULLS FIRST) AS rn
    FROM parsed WHERE timestamp IS NOT NULL) WHERE rn = 1)"""

DASH_OHLC = OHLC + """,
dash_ohlc AS (
  SELECT * FROM (
    SELECT coin_id, timestamp, open_price, high_price, low_price, close_price, vs_currency, etl_timestamp,
           row_number() OVER (PARTITION BY coin_id, timestamp
             ORDER BY etl_timestamp, open_price, high_price, low_price, close_price, vs_currency) AS rn
    FROM ohlc WHERE timestamp IS NOT NULL) WHERE rn = 1)"""

SELECTED = ("coin_id IN ('click', 'view') AND timestamp >= TIMESTAMP '2024-01-05 00:00:00' "
            "AND timestamp <= TIMESTAMP '2024-01-15 00:00:00'")

RETURNS = MARKET + f""",
previous AS (SELECT *, lag(price) OVER ({W}) AS previous_price FROM market),
returns AS (
  SELECT *, price - previous_price AS price_change,
         (price / nullif(previous_price, 0) - 1) * 100 AS return_pct FROM previous)"""

INTERVALS = MARKET + f""",
before AS (SELECT *, lag(timestamp) OVER ({W}) AS previous_timestamp FROM market),
intervals AS (
  SELECT *, (epoch_us(timestamp) // 1000000 - epoch_us(previous_timestamp) // 1000000) / 60.0 AS interval_minutes
  FROM before)"""


def lags_of(table: str) -> str:
    lagged = ", ".join(f"lag(price, {k}) OVER ({W}) AS price_lag_{k}" for k in LAGS)
    complete = " AND ".join(f"price_lag_{k} IS NOT NULL" for k in LAGS)
    return f"""lagged AS (SELECT *, {lagged} FROM {table}),
complete AS (SELECT * FROM lagged WHERE {complete})"""


SPLIT = MARKET + ",\n" + lags_of("market") + f""",
positions AS (
  SELECT *, row_number() OVER ({W}) AS position, count(*) OVER (PARTITION BY {G}) AS total FROM complete),
split AS (
  SELECT * EXCLUDE (position, total),
         CASE WHEN position <= floor(total * CAST(0.80 AS DOUBLE)) THEN 'train' ELSE 'test' END AS dataset_type
  FROM positions)"""

_STATS = ", ".join(
    f"avg(price_lag_{k}) AS price_lag_{k}_mean, stddev_samp(price_lag_{k}) AS price_lag_{k}_std" for k in LAGS)
_SCALED = ", ".join(
    f"CASE WHEN price_lag_{k}_std IS NULL OR price_lag_{k}_std = 0 THEN 0.0 "
    f"ELSE (price_lag_{k} - price_lag_{k}_mean) / price_lag_{k}_std END AS price_lag_{k}_scaled" for k in LAGS)
SCALED_COLUMNS = ", ".join(f"price_lag_{k}_scaled" for k in LAGS)

FEATURES = SPLIT + f""",
stats AS (SELECT {G}, {_STATS} FROM split WHERE dataset_type = 'train' GROUP BY {G}),
features AS (SELECT split.*, {_SCALED} FROM split LEFT JOIN stats USING ({G}))"""


def residualise(order: tuple[int, ...], tag: str) -> str:
    """Least squares by taking one feature after another out of the label and the later features.

    All sums run over training rows; the last table holds the label's residual ``y`` and the
    last feature's own residual ``e``.
    """
    over = f"OVER (PARTITION BY {G})"

    def train(expression: str) -> str:
        return f"sum(CASE WHEN dataset_type = 'train' THEN {expression} END) {over}"

    def centred(column: str) -> str:
        return f"{column} - avg(CASE WHEN dataset_type = 'train' THEN {column} END) {over}"

    keep = "coin_id, vs_currency, timestamp, dataset_type, price"
    tables = [f"{tag}0 AS (SELECT {keep}, {centred('price')} AS y, "
              + ", ".join(f"{centred(f'price_lag_{k}_scaled')} AS f{k}" for k in order) + " FROM features)"]
    for i, k in enumerate(order):
        later = order[i + 1:]
        slope = f"coalesce({train(f'f{k} * y')} / nullif({train(f'f{k} * f{k}')}, 0), 0)"
        columns = [f"y - f{k} * {slope} AS y", f"{slope} AS slope"]
        columns += [
            f"f{j} - f{k} * coalesce({train(f'f{k} * f{j}')} / nullif({train(f'f{k} * f{k}')}, 0), 0) AS f{j}"
            for j in later]
        tables.append(f"{tag}{i + 1} AS (SELECT {keep}, {', '.join(columns)} FROM {tag}{i})")
    return ",\n".join(tables)


FORECASTS = FEATURES + ",\n" + residualise(LAGS, "ols") + f""",
predictions AS (
  SELECT coin_id, timestamp, vs_currency, dataset_type, price, price - y AS prediction, y AS residual FROM ols5),
baseline AS (
  SELECT {G}, avg(residual) AS residual_mean, stddev_samp(residual) AS residual_std
  FROM predictions WHERE dataset_type = 'train' GROUP BY {G}),
limits AS (
  SELECT *, residual_mean - residual_std AS lower_1_sigma, residual_mean + residual_std AS upper_1_sigma,
         residual_mean - 2 * residual_std AS lower_2_sigma, residual_mean + 2 * residual_std AS upper_2_sigma,
         residual_mean - 3 * residual_std AS lcl, residual_mean + 3 * residual_std AS ucl FROM baseline),
forecasts AS (SELECT * FROM predictions LEFT JOIN limits USING ({G}))"""
LIMITS = "residual_mean, residual_std, lower_1_sigma, upper_1_sigma, lower_2_sigma, upper_2_sigma, lcl, ucl"


def oracle(name: str, views: str, select: str) -> None:
    ORACLES[name] = f"WITH {views}\n{select}" if views else select


def summary(column: str, mean: str, std: str, low: str, q1: str, median: str, q3: str, high: str) -> str:
    return ", ".join([
        r(f"avg({column})", mean), r(f"stddev_samp({column})", std), r(f"min({column})", low),
        r(f"quantile_disc({column}, 0.25)", q1), r(f"quantile_disc({column}, 0.5)", median),
        r(f"quantile_disc({column}, 0.75)", q3), r(f"max({column})", high)])


# Sources

oracle("raw_ingest", "", """SELECT props AS data, true AS is_chart_file, true AS has_size, true AS landed_before_load
FROM events""")
oracle("incremental_landing", "", "SELECT props AS data, true AS is_chart_file, true AS has_size FROM events")
oracle("table_round_trip", MARKET, f"""
SELECT {G}, timestamp, event_id, {r('price')} FROM market WHERE vs_currency = 'usd'""")
oracle("renamed_timestamp", LOADS, f"SELECT {G}, event_id, timestamp_raw, timestamp, load FROM parsed")
oracle("load_source", MARKET, f"SELECT coin_id, timestamp, vs_currency, {r('price')} FROM market")
oracle("row_count", MARKET, "SELECT count(*) AS row_count FROM market")
oracle("peek_with_file", "", """SELECT event_id, ts, user_id, event_type, value, props, 'events.parquet' AS file_path
FROM events ORDER BY event_id LIMIT 10""")

# Parsing

oracle("parse_chart", MARKET, f"""
SELECT coin_id, vs_currency, '1' AS days, epoch_us(timestamp) // 1000 AS timestamp_unix_ms,
       strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS timestamp_raw, date_trunc('millisecond', timestamp) AS timestamp,
       {rs('price, market_cap, total_volume')} FROM market""")
oracle("incremental_chart", MARKET + """,
arrived AS (
  SELECT *, CASE WHEN event_id // 256 % 3 < 2 THEN '1' ELSE '7' END AS days FROM market
  UNION ALL SELECT * REPLACE (price + 1 AS price), '30' FROM market WHERE event_id % 25 = 0)""", f"""
SELECT coin_id, vs_currency, days, epoch_us(timestamp) // 1000 AS timestamp_unix_ms,
       strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS timestamp_raw, date_trunc('millisecond', timestamp) AS timestamp,
       {rs('price, market_cap, total_volume')} FROM arrived""")
ORACLES["split_chart"] = ORACLES["parse_chart"]
SPOILED = MARKET + """,
spoiled AS (
  SELECT *, event_id % 7 AS kind,
         CASE event_id % 7 WHEN 3 THEN '/ping' ELSE '/coins/' || coin_id || '/x' END AS endpoint,
         epoch_us(timestamp) // 1000 AS ms FROM market)"""
oracle("parse_spoiled", SPOILED, """
SELECT coin_id, vs_currency, ms AS timestamp_unix_ms, CAST(event_id AS DOUBLE) AS price FROM spoiled WHERE kind > 3""")
_REASON = "CASE WHEN kind = 3 THEN 'no coin' WHEN kind = 4 THEN 'short record' ELSE 'no epoch' END AS reason"
oracle("parse_quarantine", SPOILED, f"""
SELECT 'market_chart' AS kind, endpoint, CASE WHEN kind <> 3 THEN coin_id END AS coin_id, vs_currency,
       CAST(event_id AS DOUBLE) AS second, {_REASON} FROM spoiled WHERE kind < 4
UNION ALL
SELECT 'ohlc', endpoint, CASE WHEN kind <> 3 THEN coin_id END, vs_currency, 1.0, {_REASON} FROM spoiled WHERE kind < 5""")
oracle("parse_ohlc", MARKET, f"""
SELECT coin_id, vs_currency, '1' AS days, epoch_us(timestamp) // 1000 AS timestamp_unix_ms,
       strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS timestamp_raw, {r('price', 'open_price')},
       {r('price * 1.02', 'high_price')}, {r('price * 0.98', 'low_price')},
       {r('price + (event_id % 5 - 2) * 0.01 * price', 'close_price')} FROM market""")
oracle("chart_align", MARKET + """,
points AS (SELECT *, epoch_us(timestamp) // 1000 AS timestamp_unix_ms FROM market),
-- The second load repeats even documents: series points of 256 consecutive event ids.
landed AS (SELECT * FROM points UNION ALL SELECT * FROM points WHERE (event_id // 256) % 2 = 0),
caps AS (SELECT timestamp_unix_ms, min(market_cap) AS market_cap FROM points GROUP BY 1),
volumes AS (SELECT timestamp_unix_ms, min(total_volume) AS total_volume FROM points GROUP BY 1)""", f"""
SELECT '/coins/' || coin_id || '/market_chart' AS endpoint, coin_id, vs_currency, p.timestamp_unix_ms,
       {r('p.price', 'price')}, {r('caps.market_cap', 'market_cap')}, {r('volumes.total_volume', 'total_volume')}
FROM landed p LEFT JOIN caps USING (timestamp_unix_ms) LEFT JOIN volumes USING (timestamp_unix_ms)""")
oracle("chart_dedup", LOADS, f"""
SELECT coin_id, vs_currency, timestamp_unix_ms, {rs('price, market_cap, total_volume')}, etl_timestamp, load
FROM (SELECT *, row_number() OVER (PARTITION BY coin_id, vs_currency, timestamp_unix_ms, price
        ORDER BY etl_timestamp, market_cap NULLS FIRST, total_volume NULLS FIRST, load) AS rn FROM loads)
WHERE rn = 1""")
oracle("ohlc_dedup", OHLC, f"""
SELECT coin_id, vs_currency, timestamp_unix_ms, {rs('open_price, high_price, low_price, close_price')},
       etl_timestamp, load
FROM (SELECT *, row_number() OVER (PARTITION BY coin_id, vs_currency, timestamp_unix_ms,
        open_price, high_price, low_price, close_price ORDER BY etl_timestamp, load) AS rn FROM ohlc)
WHERE rn = 1""")

# Views

oracle("filter_series", MARKET, f"""
SELECT coin_id, vs_currency, timestamp, event_id, {rs('price, market_cap, total_volume')}
FROM market WHERE coin_id = 'click' AND vs_currency = 'usd'""")
oracle("series_list", MARKET, "SELECT DISTINCT coin_id, vs_currency FROM market WHERE vs_currency = 'usd'")
oracle("series_view", MARKET, f"SELECT timestamp, coin_id, {r('price')} FROM market")
oracle("price_volume_pairs", MARKET, f"SELECT {G}, {rs('total_volume, price')} FROM market")
oracle("lag1_pairs", RETURNS, f"""
SELECT {G}, {r('previous_price', 'price_lag_1')}, {r('price')} FROM returns WHERE previous_price IS NOT NULL""")
oracle("actual_vs_predicted", FORECASTS, f"""
SELECT {G}, timestamp, dataset_type, {rs('price, prediction')} FROM forecasts""")
oracle("residuals_over_time", FORECASTS, f"""
SELECT {G}, timestamp, dataset_type, {r('residual')} FROM forecasts""")
oracle("returns_over_time", RETURNS, f"""
SELECT timestamp, coin_id, {r('return_pct')} FROM returns WHERE return_pct IS NOT NULL""")
oracle("peek", MARKET, f"""
SELECT coin_id, vs_currency, timestamp, event_id, {rs('price, market_cap, total_volume')}
FROM (SELECT * FROM market ORDER BY coin_id, vs_currency, timestamp, event_id LIMIT 5)""")

# Features

MARKET_COLUMNS = "price, market_cap, total_volume"
oracle("lag_features", SPLIT, f"""
SELECT {G}, timestamp, event_id, {rs(MARKET_COLUMNS)}, {rs(LAG_COLUMNS)} FROM complete""")
oracle("lag_features_ties", """ticks AS (
  SELECT o_orderpriority AS coin_id, o_orderstatus AS vs_currency, o_orderdate AS timestamp,
         o_orderkey AS event_id, o_totalprice AS price FROM orders),
""" + lags_of("ticks"), f"SELECT {G}, timestamp, event_id, {r('price')}, {rs(LAG_COLUMNS)} FROM complete")
for side in ("train", "test"):
    oracle(f"split_{side}", SPLIT, f"""
SELECT {G}, timestamp, event_id, {rs(MARKET_COLUMNS)}, {rs(LAG_COLUMNS)}, dataset_type
FROM split WHERE dataset_type = '{side}'""")
    oracle(f"feature_{side}", FEATURES, f"""
SELECT coin_id, timestamp, vs_currency, {r('price')}, {rs(LAG_COLUMNS)}, {rs(SCALED_COLUMNS)}
FROM features WHERE dataset_type = '{side}'""")
oracle("assembled", FEATURES, f"""
SELECT {G}, timestamp, {', '.join(r(f'price_lag_{k}_scaled', f'f{i}') for i, k in enumerate(LAGS))} FROM features""")
oracle("scaling_stats", FEATURES, f"""
SELECT {G}, {', '.join(rs(f'price_lag_{k}_mean, price_lag_{k}_std') for k in LAGS)} FROM stats""")
oracle("standardize", FEATURES, f"SELECT {G}, timestamp, {rs(SCALED_COLUMNS)} FROM features")

# Models

oracle("series_status", SPLIT, f"""
SELECT *, CASE WHEN train_rows = 0 THEN 'no_train' WHEN test_rows = 0 THEN 'no_test' ELSE 'ok' END AS status
FROM (SELECT {G}, count(*) FILTER (dataset_type = 'train') AS train_rows,
             count(*) FILTER (dataset_type = 'test') AS test_rows FROM split GROUP BY {G})""")
_LAST = [tuple(k for k in LAGS if k != last) + (last,) for last in LAGS]
oracle("model_coefficients",
       FEATURES + ",\n" + ",\n".join(residualise(order, f"c{i}_") for i, order in enumerate(_LAST)) + f""",
slopes AS ({' UNION ALL '.join(
    f"SELECT {G}, {i} AS feature, any_value(slope) AS coefficient FROM c{i}_5 GROUP BY {G}" for i in range(5))}),
sizes AS (SELECT {G}, count(*) AS train_rows, avg(price) AS mean_price FROM features
  WHERE dataset_type = 'train' GROUP BY {G})""", f"""
SELECT {G}, train_rows, {r('mean_price', 'intercept')}, feature, {r('coefficient')}
FROM sizes JOIN slopes USING ({G})""")
oracle("forecasts", FORECASTS, f"""
SELECT coin_id, timestamp, vs_currency, dataset_type, {rs('price, prediction, residual')}, {rs(LIMITS)}
FROM forecasts""")
ONE = "coin_id = 'click' AND vs_currency = 'usd'"
oracle("single_model", FORECASTS, f"""
SELECT coin_id, timestamp, vs_currency, dataset_type, {rs('price, prediction, residual')}, {rs(LIMITS)}
FROM forecasts WHERE {ONE}""")
oracle("saved_model", FORECASTS, f"SELECT {G}, timestamp, {rs('prediction, residual')} FROM forecasts WHERE {ONE}")
oracle("control_limits", FORECASTS, f"SELECT {G}, {rs(LIMITS)} FROM limits")
oracle("model_performance", FORECASTS, f"""
SELECT {G}, 'linear_regression' AS model_type, count(*) FILTER (dataset_type = 'train') AS train_rows,
       count(*) FILTER (dataset_type = 'test') AS test_rows,
       {r("sqrt(avg(residual * residual) FILTER (dataset_type = 'test'))", 'rmse')},
       {r("avg(abs(residual)) FILTER (dataset_type = 'test')", 'mae')},
       {r("1 - avg(residual * residual) FILTER (dataset_type = 'test') / "
          "nullif(var_pop(price) FILTER (dataset_type = 'test'), 0)", 'r2')},
       'models/' || coin_id || '_' || vs_currency || '_linear_regression' AS model_path
FROM forecasts GROUP BY {G}""")

# Monitoring

oracle("forecast_date_range", FORECASTS, f"""
SELECT {G}, count(*) AS observations, min(timestamp) AS start_timestamp, max(timestamp) AS end_timestamp
FROM forecasts GROUP BY {G}""")
oracle("forecast_null_summary", FORECASTS, "SELECT " + ", ".join(
    f"count(*) FILTER ({c} IS NULL) AS {c}"
    for c in ("coin_id", "timestamp", "vs_currency", "price", "prediction", "residual")) + " FROM forecasts")
oracle("forecast_duplicate_keys", FORECASTS, f"""
SELECT {G}, date_trunc('hour', timestamp) AS timestamp, count(*) AS count
FROM forecasts GROUP BY ALL HAVING count(*) > 1""")
oracle("split_summary", FORECASTS, f"""
SELECT {G}, dataset_type, count(*) AS observations, min(timestamp) AS start_timestamp,
       max(timestamp) AS end_timestamp FROM forecasts GROUP BY {G}, dataset_type""")
oracle("split_validation", FORECASTS, f"""
SELECT *, last_train_timestamp < first_test_timestamp AS valid_chronological_split FROM (
  SELECT {G}, max(timestamp) FILTER (dataset_type = 'train') AS last_train_timestamp,
         min(timestamp) FILTER (dataset_type = 'test') AS first_test_timestamp FROM forecasts GROUP BY {G})""")
oracle("forecast_price_stats", FORECASTS, f"""
SELECT {G}, dataset_type, count(*) AS n,
       {summary('price', 'mean_price', 'std_price', 'min_price', 'q1', 'median', 'q3', 'max_price')}
FROM forecasts GROUP BY {G}, dataset_type""")
oracle("residual_stats", FORECASTS, f"""
SELECT {G}, dataset_type, count(*) AS n,
       {summary('residual', 'mean_residual', 'std_residual', 'min_residual', 'q1', 'median', 'q3', 'max_residual')}
FROM forecasts GROUP BY {G}, dataset_type""")
oracle("out_of_control", FORECASTS, f"""
SELECT {G}, timestamp, dataset_type, {rs('price, prediction, residual, lcl, ucl')}
FROM forecasts WHERE residual > ucl OR residual < lcl""")
oracle("out_of_control_summary", FORECASTS, f"""
SELECT *, {r('beyond_control_limits * 100.0 / observations', 'percent_beyond_limits')} FROM (
  SELECT {G}, dataset_type, count(*) AS observations,
         count(*) FILTER (residual > ucl OR residual < lcl) AS beyond_control_limits
  FROM forecasts GROUP BY {G}, dataset_type)""")
METRICS = FORECASTS + f""",
metrics AS (
  SELECT {G}, dataset_type, avg(abs(residual)) AS mae, sqrt(avg(residual * residual)) AS rmse,
         avg(residual) AS mean_error, avg(abs(residual / nullif(price, 0))) * 100 AS mape,
         stddev_samp(residual) AS std_residual
  FROM forecasts GROUP BY {G}, dataset_type)"""
oracle("forecast_metrics", METRICS, f"SELECT {G}, dataset_type, {rs('mae, rmse, mean_error, mape')} FROM metrics")


def pivoted(columns: dict[str, str]) -> str:
    return ", ".join(r(f"max({c}) FILTER (dataset_type = '{side}')", f"{side}_{name}")
                     for side in ("train", "test") for name, c in columns.items())


oracle("error_pivot", METRICS, f"""
SELECT {G}, {pivoted({c: c for c in ('mae', 'rmse', 'mean_error', 'mape')})} FROM metrics GROUP BY {G}""")
oracle("residual_pivot", METRICS, f"""
SELECT {G}, {pivoted({'mean_residual': 'mean_error', 'std_residual': 'std_residual'})}
FROM metrics GROUP BY {G}""")
ERRORS = f"""
SELECT {G}, timestamp, dataset_type, {rs('price, prediction, residual')},
       {r('abs(residual)', 'absolute_residual')} FROM """
oracle("top_errors", FORECASTS,
       ERRORS + "(SELECT * FROM forecasts ORDER BY abs(residual) DESC, coin_id, vs_currency, timestamp, dataset_type, price LIMIT 5)")
oracle("top_test_errors", FORECASTS, ERRORS + "forecasts WHERE dataset_type = 'test'")

# Quality

oracle("timestamp_parse_report", LOADS, """
SELECT count(*) AS rows, count(*) FILTER (timestamp_raw IS NULL) AS null_raw_timestamp,
       count(*) FILTER (timestamp_raw IS NOT NULL AND timestamp IS NULL) AS failed_timestamp_parses FROM parsed""")
oracle("coverage", LOADS, f"""
SELECT {G}, count(*) AS observations, count(DISTINCT timestamp) AS unique_timestamps,
       min(timestamp) AS start_timestamp, max(timestamp) AS end_timestamp FROM parsed GROUP BY {G}""")
oracle("null_summary", LOADS, "SELECT " + ", ".join(
    f"count(*) FILTER ({c} IS NULL) AS {c}"
    for c in ("coin_id", "vs_currency", "timestamp", "price", "market_cap", "total_volume")) + " FROM parsed")
oracle("duplicate_keys", LOADS, f"""
SELECT {G}, timestamp, count(*) AS count FROM parsed GROUP BY {G}, timestamp HAVING count(*) > 1""")
oracle("intervals", INTERVALS, f"""
SELECT {G}, timestamp, previous_timestamp, {r('interval_minutes')} FROM intervals""")
oracle("cadence_summary", INTERVALS, f"""
SELECT {G}, count(*) AS intervals, {r('avg(interval_minutes)', 'mean_minutes')},
       {r('quantile_disc(interval_minutes, 0.5)', 'median_minutes')}, {r('min(interval_minutes)', 'min_minutes')},
       {r('max(interval_minutes)', 'max_minutes')},
       count(*) FILTER (interval_minutes > 5) AS intervals_above_expected
FROM intervals WHERE interval_minutes IS NOT NULL GROUP BY {G}""")
oracle("interval_frequency", INTERVALS, f"""
SELECT {G}, {r('seconds / 60.0', 'interval_minutes')}, count FROM (
  SELECT {G}, CAST(round(interval_minutes * 60) AS BIGINT) AS seconds, count(*) AS count
  FROM intervals WHERE interval_minutes IS NOT NULL GROUP BY ALL)""")
oracle("time_gaps", INTERVALS, f"""
SELECT {G}, previous_timestamp, timestamp, {r('interval_minutes')} FROM intervals WHERE interval_minutes > 5""")

def _first(report: str, source: str, order: str) -> str:
    return f"SELECT '{report}' AS report, {G} FROM (SELECT * FROM {source} ORDER BY {order} LIMIT 3)"


oracle("limited_reports", INTERVALS + f""",
frequencies AS (SELECT {G}, interval_minutes, count(*) AS c FROM intervals WHERE interval_minutes IS NOT NULL GROUP BY ALL),
keys AS (SELECT DISTINCT {G} FROM market), sides AS (SELECT *, unnest(['test', 'train']) AS side FROM keys)""",
       " UNION ALL ".join([
           _first("coverage", "keys", G), _first("cadence", "keys", G), _first("describe", "keys", G),
           _first("metrics", "sides", f"{G}, side"),
           _first("frequency", "frequencies", "coin_id, c DESC, vs_currency, interval_minutes"),
           _first("gaps", "(SELECT * FROM intervals WHERE interval_minutes > 5)", f"interval_minutes DESC, {G}, timestamp")]))

# Description

oracle("describe_market", LOADS, f"""
SELECT {G}, count(*) AS n,
       {summary('price', 'mean_price', 'std_price', 'min_price', 'price_q1', 'price_median', 'price_q3', 'max_price')},
       {r('avg(market_cap)', 'mean_market_cap')}, {r('stddev_samp(market_cap)', 'std_market_cap')},
       {r('avg(total_volume)', 'mean_volume')}, {r('stddev_samp(total_volume)', 'std_volume')}
FROM loads GROUP BY {G}""")
oracle("describe_price", LOADS, f"""
SELECT {G}, count(price) AS n,
       {summary('price', 'mean_price', 'std_price', 'min_price', 'q1', 'median', 'q3', 'max_price')}
FROM loads GROUP BY {G}""")
for _key, _column, _name in (("describe_market_cap", "market_cap", "market_cap"),
                             ("describe_volume", "total_volume", "volume")):
    oracle(_key, LOADS, f"""
SELECT {G}, {r(f'avg({_column})', f'mean_{_name}')}, {r(f'stddev_samp({_column})', f'std_{_name}')},
       {r(f'min({_column})', f'min_{_name}')}, {r(f'quantile_disc({_column}, 0.5)', f'median_{_name}')},
       {r(f'max({_column})', f'max_{_name}')} FROM loads GROUP BY {G}""")
oracle("returns", RETURNS, f"""
SELECT {G}, timestamp, {rs('price, previous_price, price_change, return_pct')} FROM returns""")
oracle("return_stats", RETURNS, f"""
SELECT {G}, {summary('return_pct', 'mean_return_pct', 'return_std_pct', 'min_return_pct', 'q1', 'median', 'q3',
                     'max_return_pct')}
FROM returns WHERE return_pct IS NOT NULL GROUP BY {G}""")
OUTLIERS = RETURNS + f""",
quartiles AS (
  SELECT {G}, quantile_cont(return_pct, 0.25) AS q1, quantile_cont(return_pct, 0.75) AS q3
  FROM returns WHERE return_pct IS NOT NULL GROUP BY {G}),
bounds AS (SELECT {G}, q1 - 1.5 * (q3 - q1) AS lower_bound, q3 + 1.5 * (q3 - q1) AS upper_bound FROM quartiles),
outliers AS (
  SELECT * FROM returns LEFT JOIN bounds USING ({G}) WHERE return_pct < lower_bound OR return_pct > upper_bound)"""
oracle("return_outliers", OUTLIERS, f"""
SELECT {G}, timestamp, {rs('price, previous_price, return_pct, lower_bound, upper_bound')} FROM outliers""")
oracle("top_return_outliers", OUTLIERS, f"""
SELECT {G}, timestamp, event_id, {rs('price, return_pct, lower_bound, upper_bound')},
       {r('abs(return_pct)', 'absolute_return_pct')}
FROM (SELECT * FROM outliers ORDER BY abs(return_pct) DESC, coin_id, vs_currency, timestamp, event_id LIMIT 10)""")
oracle("outlier_counts", OUTLIERS, f"""
SELECT {G}, count(*) AS potential_return_outliers FROM outliers GROUP BY {G}""")
oracle("top_abs_returns", RETURNS, f"""
SELECT {G}, timestamp, event_id, {rs('price, previous_price, price_change, return_pct, total_volume')},
       {r('abs(return_pct)', 'absolute_return_pct')}
FROM (SELECT * FROM returns WHERE return_pct IS NOT NULL
      ORDER BY abs(return_pct) DESC, coin_id, vs_currency, timestamp, event_id LIMIT 10)""")
TRAILING = f"OVER ({W} ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)"
oracle("rolling_price", MARKET, f"""
SELECT {G}, timestamp, {r('price')}, {r(f'avg(price) {TRAILING}', 'rolling_price_mean')},
       {r(f'stddev_samp(price) {TRAILING}', 'rolling_price_std')} FROM market""")
oracle("rolling_volatility", RETURNS, f"""
SELECT {G}, timestamp, {r('return_pct')}, {r(f'stddev_samp(return_pct) {TRAILING}', 'rolling_return_std')}
FROM returns""")
oracle("correlations", MARKET, f"""
SELECT {G}, {r('corr(price, market_cap)', 'price_market_cap_corr')},
       {r('corr(price, total_volume)', 'price_volume_corr')},
       {r('corr(market_cap, total_volume)', 'market_cap_volume_corr')} FROM market GROUP BY {G}""")
for _key, _views, _source, _value, _name in (
        ("price_lag_corr", MARKET, "market", "price", "price"),
        ("return_lag_corr", RETURNS, "(SELECT * FROM returns WHERE return_pct IS NOT NULL)", "return_pct", "return")):
    _lags = ", ".join(f"lag({_value}, {k}) OVER ({W}) AS l{k}" for k in LAGS)
    oracle(_key, _views, f"""
SELECT {G}, {', '.join(r(f'corr({_value}, l{k})', f'{_name}_acf_lag_{k}') for k in LAGS)}
FROM (SELECT *, {_lags} FROM {_source}) GROUP BY {G}""")
for _key, _views, _source, _value, _bins in (
        ("price_histogram", MARKET, "market", "price", 40), ("return_histogram", RETURNS, "returns", "return_pct", 50)):
    oracle(_key, _views + f""",
rows AS (SELECT {G}, {_value} AS x FROM {_source} WHERE {_value} IS NOT NULL),
ends AS (SELECT {G}, min(x) AS lo, max(x) AS hi FROM rows GROUP BY {G}),
bins AS (SELECT {G}, lo, hi, CAST(b AS INTEGER) AS bin FROM ends, range(0, {_bins}) AS t(b)),
counts AS (
  SELECT {G}, least(CAST(floor((x - lo) / (hi - lo) * {_bins}) AS INTEGER), {_bins - 1}) AS bin, count(*) AS c
  FROM rows JOIN ends USING ({G}) GROUP BY ALL)""", f"""
SELECT {G}, bin, {r(f'lo + bin * ((hi - lo) / {_bins})', 'bin_start')},
       {r(f'lo + (bin + 1) * ((hi - lo) / {_bins})', 'bin_end')}, coalesce(c, 0) AS frequency
FROM bins LEFT JOIN counts USING ({G}, bin)""")
oracle("return_boxplot", RETURNS + f""",
rows AS (SELECT {G}, return_pct AS x FROM returns WHERE return_pct IS NOT NULL),
quartiles AS (
  SELECT {G}, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.75) AS q3
  FROM rows GROUP BY {G}),
fences AS (SELECT *, q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high FROM quartiles)""", f"""
SELECT {G}, {r('any_value(q1)', 'q1')}, {r('any_value(median)', 'median')}, {r('any_value(q3)', 'q3')},
       {r('least(min(x) FILTER (x >= low), any_value(q1))', 'whisker_low')},
       {r('greatest(max(x) FILTER (x <= high), any_value(q3))', 'whisker_high')},
       count(*) FILTER (x < low OR x > high) AS fliers
FROM rows JOIN fences USING ({G}) GROUP BY {G}""")

# Dashboards

HISTORY_COLUMNS = f"coin_id, timestamp, {rs('price, market_cap, total_volume')}, vs_currency, rn"
CANDLE = "open_price, high_price, low_price, close_price"
oracle("dash_ohlc", DASH_OHLC, f"""
SELECT coin_id, timestamp, {rs(CANDLE)}, vs_currency, etl_timestamp, rn FROM dash_ohlc""")
oracle("candles", DASH_OHLC, f"""
SELECT coin_id, timestamp, {rs(CANDLE)},
       CASE WHEN open_price <= close_price THEN 'up' ELSE 'down' END AS direction FROM dash_ohlc""")
oracle("dash_history", HISTORY, f"SELECT {HISTORY_COLUMNS} FROM history")
oracle("dash_filtered_history", HISTORY, f"SELECT {HISTORY_COLUMNS} FROM history WHERE {SELECTED}")
oracle("dash_price_cards", HISTORY + f",\nshown AS (SELECT * FROM history WHERE {SELECTED})", f"""
SELECT (SELECT {r('price', 'price')} FROM shown
        ORDER BY timestamp DESC, coin_id DESC, vs_currency DESC, price DESC LIMIT 1) AS current_price,
       {r('avg(price)', 'average_price')}, {r('min(price)', 'minimum_price')}, {r('max(price)', 'maximum_price')}
FROM shown""")
oracle("dash_price_line", HISTORY, f"""
SELECT timestamp, {r('sum(price)', 'sum_price')} FROM history GROUP BY timestamp""")
oracle("dash_market_cap_line", HISTORY, f"""
SELECT timestamp, {r('sum(market_cap)', 'sum_market_cap')} FROM history GROUP BY timestamp""")
_RANGE = SELECTED.split(" AND ", 1)[1]
oracle("dash_filter_facet", HISTORY, f"""
SELECT coin_id, count(*) FILTER ({_RANGE}) AS coin_id_associativity FROM history GROUP BY coin_id""")
oracle("dash_time_facet", HISTORY, """
SELECT timestamp, count(*) FILTER (coin_id IN ('click', 'view')) AS timestamp_associativity
FROM history GROUP BY timestamp""")
oracle("dash_control_chart", FORECASTS, f"""
SELECT coin_id, timestamp, vs_currency, dataset_type, {r('residual')},
       {rs(LIMITS.replace('residual_std, ', ''))} FROM forecasts""")
oracle("dash_control_cards", FORECASTS, """
SELECT count(*) AS total_observations,
       count(*) FILTER (residual > ucl OR residual < lcl) AS out_of_control_points FROM forecasts""")

# Diagnostics

TREND = MARKET + f""",
numbered AS (SELECT *, row_number() OVER ({W}) - 1 AS idx FROM market),
fits AS (
  SELECT {G}, count(*) AS n, regr_slope(price, idx) AS slope, regr_intercept(price, idx) AS intercept,
         regr_r2(price, idx) AS r_squared FROM numbered GROUP BY {G})"""
oracle("trend_fit", TREND, f"SELECT {G}, n, {rs('slope, intercept, r_squared')} FROM fits")
oracle("trend_line", TREND, f"""
SELECT {G}, timestamp, {r('price')}, {r('intercept + slope * idx', 'linear_trend')}
FROM numbered JOIN fits USING ({G})""")

def autocorrelations(source: str, value: str) -> str:
    """``coefficients``: autocorrelations of ``value`` by lag."""
    return f"""
rows AS (
  SELECT {G}, {value} - avg({value}) OVER (PARTITION BY {G}) AS x, row_number() OVER ({W}) AS idx,
         count(*) OVER (PARTITION BY {G}) AS n
  FROM {source} WHERE {value} IS NOT NULL),
squares AS (SELECT {G}, n, sum(x * x) AS s FROM rows GROUP BY {G}, n),
shifts AS (SELECT unnest(range(1, 41)) AS lag),
products AS (
  SELECT a.coin_id, a.vs_currency, CAST(lag AS INTEGER) AS lag, sum(a.x * b.x) AS p
  FROM rows a, shifts, rows b
  WHERE a.coin_id = b.coin_id AND a.vs_currency = b.vs_currency AND b.idx = a.idx - lag GROUP BY 1, 2, 3),
coefficients AS (
  SELECT {G}, n, lag, p / nullif(s, 0) AS acf FROM products JOIN squares USING ({G})
  WHERE lag <= least(40, greatest(1, n // 2 - 1)))"""


for _key, _views, _source, _value in (("price", MARKET, "market", "price"), ("return", RETURNS, "returns", "return_pct")):
    _acf = _views + "," + autocorrelations(_source, _value)
    oracle(f"{_key}_acf", _acf, f"""
SELECT {G}, n, lag, {r('acf')},
       {r(f'1.959963984540054 * sqrt((1 + 2 * coalesce(sum(acf * acf) OVER (PARTITION BY {G} ORDER BY lag '
          'ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / n)', 'band')}
FROM coefficients""")
    # Durbin-Levinson: phi holds the coefficients of the order reached so far.
    ORACLES[f"{_key}_pacf"] = f"""WITH RECURSIVE {_acf},
listed AS (SELECT {G}, n, list(acf ORDER BY lag) AS rho FROM coefficients WHERE acf IS NOT NULL GROUP BY {G}, n),
orders AS (
  SELECT {G}, n, rho, 1 AS lag, rho[1] AS pacf, [rho[1]] AS phi, 1 - rho[1] * rho[1] AS error FROM listed
  UNION ALL
  SELECT {G}, n, rho, lag + 1, f, list_append([phi[i] - f * phi[lag + 1 - i] FOR i IN range(1, lag + 1)], f),
         error * (1 - f * f)
  FROM (SELECT *, (rho[lag + 1] - list_sum([phi[i] * rho[lag + 1 - i] FOR i IN range(1, lag + 1)])) / error AS f
        FROM orders WHERE lag < len(rho)))
SELECT {G}, n, lag, {r('pacf')}, {r('1.959963984540054 / sqrt(n)', 'band')} FROM orders"""


# Tests of stationarity. A series is a table with G, idx (from 0), n and v.

def series_of(source: str, value: str) -> str:
    return f"""
series AS (
  SELECT {G}, {value} AS v, row_number() OVER ({W}) - 1 AS idx, count(*) OVER (PARTITION BY {G}) AS n
  FROM {source} WHERE {value} IS NOT NULL)"""


def kpss(trend: bool, n_max: str = "(SELECT max(n) FROM series)") -> str:
    """``kpss``: statistic, p-value and bandwidth of ``series``."""
    line = "regr_intercept(v, idx) AS a, regr_slope(v, idx) AS b" if trend else "avg(v) AS a, 0.0 AS b"
    points = (0.119, 0.146, 0.176, 0.216) if trend else (0.347, 0.463, 0.574, 0.739)
    between = "\n".join(
        f"    WHEN stat <= {high} THEN {p} - {p - q:.3f} * (stat - {low}) / ({high} - {low})"
        for low, high, p, q in zip(points, points[1:], (0.10, 0.05, 0.025), (0.05, 0.025, 0.01)))
    return f"""
lines AS (SELECT {G}, {line} FROM series GROUP BY {G}),
errors AS (SELECT {G}, idx, n, v - (a + b * idx) AS e FROM series JOIN lines USING ({G})),
walks AS (
  SELECT {G}, n, sum(e) OVER (PARTITION BY {G} ORDER BY idx) AS s FROM errors),
eta AS (SELECT {G}, n, sum(s * s) / (n * n) AS eta FROM walks GROUP BY {G}, n),
-- First the lags that choose the bandwidth, then those within it.
gammas AS (
  SELECT a.coin_id, a.vs_currency, a.n, k, sum(a.e * b.e) AS g
  FROM errors a, (SELECT unnest(range(0, CAST(floor(pow({n_max}, 2.0 / 9.0)) AS BIGINT) + 1)) AS k) shifts, errors b
  WHERE a.coin_id = b.coin_id AND a.vs_currency = b.vs_currency AND b.idx = a.idx - k GROUP BY ALL),
widths AS (
  SELECT {G}, sum(CASE WHEN k = 0 THEN g ELSE 2 * g END / n) AS s0, sum(2 * k * g / n) AS s1, any_value(n) AS n
  FROM gammas WHERE k <= floor(pow(n, 2.0 / 9.0)) GROUP BY {G}),
chosen AS (
  SELECT {G}, least(CAST(floor(1.1447 * pow((s1 / s0) * (s1 / s0), 1.0 / 3.0) * pow(n, 1.0 / 3.0)) AS BIGINT), n - 1)
         AS lags FROM widths),
within AS (
  SELECT a.coin_id, a.vs_currency, a.n, lags, k, sum(a.e * b.e) AS g
  FROM errors a JOIN chosen c ON a.coin_id = c.coin_id AND a.vs_currency = c.vs_currency
    JOIN (SELECT unnest(range(0, (SELECT max(lags) FROM chosen) + 1)) AS k) shifts ON k <= lags
    JOIN errors b ON a.coin_id = b.coin_id AND a.vs_currency = b.vs_currency AND b.idx = a.idx - k GROUP BY ALL),
spreads AS (
  SELECT {G}, lags, sum(CASE WHEN k = 0 THEN g ELSE 2 * g * (1 - k / (lags + 1.0)) END / n) AS variance
  FROM within GROUP BY {G}, lags),
kpss_stats AS (SELECT {G}, eta / variance AS stat, lags FROM eta JOIN spreads USING ({G})),
kpss AS (
  SELECT {G}, stat, lags, CASE WHEN stat <= {points[0]} THEN 0.10
{between} ELSE 0.01 END AS p FROM kpss_stats)"""


# Regressors of the Dickey-Fuller test that the SQL has columns for: Schwert's rule needs them up to 30,000 rows.
ADF_COLUMNS = 50


def taken_out(tag: str, source: str, columns: list[str], keep: str) -> str:
    """Each column in turn taken out of ``y`` and of the columns after it, as sums over the series' rows."""
    over = f"OVER (PARTITION BY {G})"
    tables, before = [], source
    for i, c in enumerate(columns):
        def slope(other: str, c: str = c) -> str:
            # A column that nothing is left of takes nothing out.
            return (f"CASE WHEN sum({c} * {c}) {over} > 1e-9 * {c}_size THEN "
                    f"sum({c} * {other}) {over} / sum({c} * {c}) {over} ELSE 0 END")

        later = "".join(f", {o} - {c} * ({slope(o)}) AS {o}, {o}_size" for o in columns[i + 1:])
        last = f", {c} AS last_e, {slope('y')} AS last_slope" if i == len(columns) - 1 else ""
        tables.append(f"{tag}{i} AS (SELECT {keep}, y - {c} * ({slope('y')}) AS y{later}{last} FROM {before})")
        before = f"{tag}{i}"
    return ",\n".join(tables)


def adf() -> str:
    """``adf``: statistic, p-value and lags of ``series``, by regressions built up column by column.

    Orders are compared on one sample; the chosen one is fitted on its own, with columns past it set to 0.
    """
    names = [f"d{k}" for k in range(1, ADF_COLUMNS + 1)]
    lagged = ", ".join(f"coalesce(lag(d, {k}) OVER w, 0) AS d{k}" for k in range(1, ADF_COLUMNS + 1))

    def sized(columns: list[str]) -> str:
        return ", ".join(f"{c}, sum({c} * {c}) OVER (PARTITION BY {G}) AS {c}_size" for c in columns)

    masked = ", ".join(f"CASE WHEN {k} <= used THEN d{k} ELSE 0 END AS d{k}" for k in range(1, ADF_COLUMNS + 1))
    fit = taken_out("a", "adf_sample", ["one", "z", *names], f"{G}, n, most, idx")
    errors = " UNION ALL ".join(
        f"SELECT {G}, n, most, {k} AS lags, sum(y * y) AS rss FROM a{k + 1} GROUP BY {G}, n, most" for k in range(ADF_COLUMNS + 1))
    again = taken_out("b", "adf_chosen_sample", ["one", *names, "z"], f"{G}, n, used")
    last = ADF_COLUMNS + 1
    tau_small, tau_large = "2.1659 + 1.4412 * t + 0.038269 * t * t", "1.7339 + 0.93202 * t - 0.12745 * t * t - 0.010368 * t * t * t"
    # Simpson's rule for the normal distribution, from 0 to |x|.
    steps = 400
    area = (f"abs(x) / {steps} / 3 * list_sum([(CASE WHEN i IN (0, {steps}) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) "
            f"* exp(-0.5 * (abs(x) * i / {steps}) * (abs(x) * i / {steps})) FOR i IN range(0, {steps} + 1)]) / sqrt(2 * pi())")
    return f"""
adf_rows AS (
  SELECT {G}, idx, n, least(CAST(ceil(12 * pow(n / 100.0, 0.25)) AS BIGINT), n // 2 - 2) AS most,
         lag(v) OVER w - avg(v) OVER (PARTITION BY {G}) AS z, v - lag(v) OVER w AS d
  FROM series WINDOW w AS (PARTITION BY {G} ORDER BY idx)),
adf_lags AS (SELECT *, {lagged} FROM adf_rows WINDOW w AS (PARTITION BY {G} ORDER BY idx)),
adf_raw AS (SELECT {G}, n, most, idx, d AS y, 1.0 AS one, z, {', '.join(names)} FROM adf_lags WHERE idx > most),
adf_sample AS (SELECT {G}, n, most, idx, y, {sized(['one', 'z', *names])} FROM adf_raw),
{fit},
adf_errors AS ({errors}),
adf_orders AS (
  SELECT *, row_number() OVER (PARTITION BY {G} ORDER BY (n - 1 - most) * ln(rss / (n - 1 - most)) + 2 * (lags + 2), lags) AS rank
  FROM adf_errors WHERE lags <= most),
adf_used AS (SELECT {G}, lags AS used FROM adf_orders WHERE rank = 1),
adf_chosen AS (SELECT {G}, n, used, d AS y, 1.0 AS one, z, {masked} FROM adf_lags JOIN adf_used USING ({G}) WHERE idx > used),
adf_chosen_sample AS (SELECT {G}, n, used, y, {sized(['one', *names, 'z'])} FROM adf_chosen),
{again},
adf_stats AS (
  SELECT {G}, used, any_value(last_slope) / sqrt(sum(y * y) / (n - 1 - used - used - 2) / sum(last_e * last_e)) AS t
  FROM b{last} GROUP BY {G}, n, used),
adf_scores AS (SELECT *, CASE WHEN t <= -1.61 THEN {tau_small} ELSE {tau_large} END AS x FROM adf_stats),
adf AS (
  SELECT {G}, t AS stat, used AS lags, CASE WHEN t > 2.74 THEN 1.0 WHEN t < -18.83 THEN 0.0
    WHEN x > 0 THEN 0.5 + {area} ELSE 0.5 - {area} END AS p FROM adf_scores)"""


# Student's t by the substitution t = sqrt(df) tan(a): shares of the area under cos(a) ** (df - 1), by Simpson's rule.
def _cosines(low: str, high: str, steps: int = 4000) -> str:
    return (f"((({high}) - ({low})) / {steps} * list_sum([(CASE WHEN i IN (0, {steps}) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) "
            f"* pow(cos(({low}) + (({high}) - ({low})) * i / {steps}), n - 3) FOR i IN range(0, {steps} + 1)]))")


oracle("trend_test", TREND + f""",
angles AS (SELECT *, atan(sqrt(r_squared / (1 - r_squared))) AS angle FROM fits),
valued AS (SELECT *, {_cosines('angle', 'pi() / 2')} / {_cosines('0.0', 'pi() / 2')} AS p_value FROM angles)""", f"""
SELECT {G}, n, {rs('slope, intercept, r_squared, p_value')}, p_value < 0.05 AS significant_trend_5pct FROM valued""")
PRICE_SERIES = MARKET + "," + series_of("market", "price")
oracle("kpss_test", PRICE_SERIES + "," + kpss(True), f"""
SELECT {G}, {r('stat', 'kpss_statistic')}, {r('p', 'kpss_p_value')}, lags AS kpss_lags_used,
       p < 0.05 AS kpss_reject_h0_5pct FROM kpss""")
oracle("adf_test", PRICE_SERIES + "," + adf(), f"""
SELECT {G}, {r('stat', 'adf_statistic')}, {r('p', 'adf_p_value')}, lags AS adf_lags_used,
       p < 0.05 AS adf_reject_h0_5pct FROM adf""")
oracle("stationarity", PRICE_SERIES + "," + kpss(True) + "," + adf(), f"""
SELECT {G}, {r('a.stat', 'adf_statistic')}, {r('a.p', 'adf_p_value')}, a.lags AS adf_lags_used,
       a.p < 0.05 AS adf_reject_h0_5pct, {r('k.stat', 'kpss_statistic')}, {r('k.p', 'kpss_p_value')},
       k.lags AS kpss_lags_used, k.p < 0.05 AS kpss_reject_h0_5pct,
       CASE WHEN a.p < 0.05 AND k.p >= 0.05 THEN 'Evidence favors stationarity'
            WHEN a.p >= 0.05 AND k.p < 0.05 THEN 'Evidence favors non-stationarity'
            WHEN a.p < 0.05 THEN 'Conflicting evidence' ELSE 'Inconclusive' END AS interpretation
FROM adf a JOIN kpss k USING ({G})""")
oracle("diff_stationarity", MARKET + f""",
changes AS (SELECT *, price - lag(price) OVER ({W}) AS change FROM market),""" + series_of("changes", "change")
       + "," + kpss(False) + "," + adf(), f"""
SELECT {G}, {r('a.p', 'adf_p_value_diff_price')}, {r('k.p', 'kpss_p_value_diff_price')},
       a.p < 0.05 AS adf_stationary_5pct, k.p >= 0.05 AS kpss_stationary_5pct
FROM adf a JOIN kpss k USING ({G})""")


# Control charts

_RUN_W = f"PARTITION BY {G} ORDER BY timestamp, price, residual"
_NEAR = {"two_of_three": (2, 3, 2), "four_of_five": (4, 5, 1)}


def _near(name: str, sign: str) -> str:
    points, of, deviations = _NEAR[name]
    beyond = f"coalesce({sign} * (residual - residual_mean) > {deviations} * residual_std, false)"
    return (f"({beyond} AND count(*) FILTER ({beyond}) OVER ({_RUN_W} ROWS BETWEEN {of - 1} PRECEDING AND CURRENT ROW) >= {points})")


RUNS = FORECASTS + f""",
sided AS (SELECT *, CASE WHEN residual > residual_mean THEN 1 WHEN residual < residual_mean THEN -1 ELSE 0 END AS side FROM forecasts),
changes AS (SELECT *, CASE WHEN lag(side) OVER ({_RUN_W}) IS DISTINCT FROM side THEN 1 ELSE 0 END AS begins FROM sided),
numbered AS (SELECT *, sum(begins) OVER ({_RUN_W}) AS run FROM changes),
runs AS (
  SELECT *, CASE WHEN side = 0 THEN 0 ELSE row_number() OVER (PARTITION BY {G}, run ORDER BY timestamp, price, residual) END AS side_run,
         coalesce(abs(residual - residual_mean) > 3 * residual_std, false) AS beyond_3_sigma,
         {", ".join(f"{_near(n, '1')} OR {_near(n, '-1')} AS {n}" for n in _NEAR)}
  FROM numbered)"""
oracle("control_runs", RUNS, f"""
SELECT {G}, timestamp, dataset_type, {r('residual')}, side_run, beyond_3_sigma, two_of_three, four_of_five,
       side_run >= 8 AS eight_on_side FROM runs""")
oracle("control_run_summary", RUNS, f"""
SELECT {G}, dataset_type, count(*) AS observations, count(*) FILTER (beyond_3_sigma) AS beyond_3_sigma,
       count(*) FILTER (two_of_three) AS two_of_three, count(*) FILTER (four_of_five) AS four_of_five,
       count(*) FILTER (side_run >= 8) AS eight_on_side, max(side_run) AS longest_side_run
FROM runs GROUP BY {G}, dataset_type""")
oracle("residual_drift", FORECASTS + f""",
sizes AS (SELECT {G}, count(*) FILTER (dataset_type = 'train') AS n_train, count(*) FILTER (dataset_type = 'test') AS n_test
          FROM forecasts WHERE residual IS NOT NULL GROUP BY {G}),
curves AS (
  SELECT {G}, n_train, n_test,
         abs(count(*) FILTER (dataset_type = 'train') OVER w / n_train - count(*) FILTER (dataset_type = 'test') OVER w / n_test) AS gap
  FROM forecasts JOIN sizes USING ({G}) WHERE residual IS NOT NULL
  WINDOW w AS (PARTITION BY {G} ORDER BY residual RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
distances AS (SELECT {G}, n_train, n_test, max(gap) AS d, sqrt(n_train * n_test / (n_train + n_test)) AS root FROM curves GROUP BY ALL),
scaled AS (SELECT *, (root + 0.12 + 0.11 / root) * d AS lam FROM distances),
valued AS (
  SELECT *, CASE WHEN lam < 0.2 THEN 1.0 ELSE least(1.0, greatest(0.0, 2 * list_sum(list_transform(range(1, 101),
         lambda k: CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END * exp(-2 * k * k * lam * lam))))) END AS p FROM scaled)""", f"""
SELECT {G}, n_train, n_test, {r('d', 'ks_statistic')}, {r('p', 'p_value')}, p < 0.05 AS drift FROM valued""")
oracle("regular_grid", MARKET + f""",
spans AS (SELECT {G}, epoch_us(min(timestamp)) AS low, epoch_us(max(timestamp)) AS high FROM market GROUP BY {G}),
steps AS (SELECT {G}, unnest(range((low + 299999999) // 300000000, high // 300000000 + 1)) AS step FROM spans),
grid AS (SELECT {G}, make_timestamp(step * 300000000) AS grid_timestamp FROM steps)""", f"""
SELECT coin_id, vs_currency, grid_timestamp, {rs('price, total_volume')},
       epoch_us(grid_timestamp) - epoch_us(timestamp) AS micros_old
FROM (SELECT g.*, m.price, m.total_volume, m.timestamp FROM grid g ASOF JOIN market m
      ON g.coin_id = m.coin_id AND g.vs_currency = m.vs_currency AND g.grid_timestamp >= m.timestamp)""")
oracle("sketch_quantiles", MARKET, f"""
SELECT {G}, count(price) AS n, true AS q1_within_bound, true AS median_within_bound, true AS q3_within_bound
FROM market GROUP BY {G}""")

# What loads extend equals what one build over all rows gives.

for _key, _same in (("feature_refresh", "lag_features"), ("merged_scaling", "scaling_stats"),
                    ("merged_coefficients", "model_coefficients"), ("merged_limits", "control_limits")):
    ORACLES[_key] = ORACLES[_same]


# Variants: a missing currency is a value of its own to SQL until the last step; long series give the same rows.

def _without_currency(name: str) -> str:
    body = ORACLES[name].replace("ELSE 'eur' END", "ELSE '?' END")
    return f"SELECT * REPLACE (nullif(vs_currency, '?') AS vs_currency) FROM ({body})"


def add_variants(variants: dict) -> None:
    for suffix, (how, names) in variants.items():
        for name in names:
            ORACLES[f"{name}_{suffix}"] = _without_currency(name) if how.get("no_currency") else ORACLES[name]
