"""Diagnostics against brute force on small series and published values."""

import math

import numpy as np
import pytest
from fixtures import examples, frame, plain_layout

from pyspark.sql import functions as F

from tidemark.functions import statistics as st
from tidemark.operators import diagnostics


def kpss_p(statistic, trend):
    return float(np.interp(statistic, st.KPSS_TREND if trend else st.KPSS_LEVEL, st.KPSS_P))


def ols(y, x):
    beta, *_ = np.linalg.lstsq(x, y, rcond=None)
    rest = y - x @ beta
    return beta, float(rest @ rest)


def brute_adf(y):
    """Every regression fitted by itself on explicit columns."""
    n = len(y)
    most = min(int(np.ceil(12 * (n / 100) ** 0.25)), n // 2 - 2)
    d = np.diff(y)

    def design(lags, start):
        """Rows t = start … n-1; d[t-1] is the change into row t."""
        t = np.arange(start, n)
        columns = [np.ones(len(t)), y[t - 1]] + [d[t - 1 - j] for j in range(1, lags + 1)]
        return d[t - 1], np.column_stack(columns)

    scores = []
    for lags in range(most + 1):
        target, x = design(most, most + 1)
        x = x[:, :lags + 2]
        _beta, rss = ols(target, x)
        scores.append((len(target) * np.log(rss / len(target)) + 2 * (lags + 2), lags))
    lags = min(scores)[1]
    target, x = design(lags, lags + 1)
    beta, rss = ols(target, x)
    variance = rss / (len(target) - x.shape[1]) * np.linalg.inv(x.T @ x)[1, 1]
    return beta[1] / np.sqrt(variance), lags


def brute_kpss(y, trend):
    n = len(y)
    x = np.column_stack([np.ones(n), np.arange(n)]) if trend else np.ones((n, 1))
    beta, _rss = ols(y, x)
    e = y - x @ beta

    def gamma(k):
        return float(e[k:] @ e[:n - k]) / n

    c = int(n ** (2 / 9))
    s0 = gamma(0) + 2 * sum(gamma(k) for k in range(1, c + 1))
    s1 = 2 * sum(k * gamma(k) for k in range(1, c + 1))
    lags = min(n - 1, int(1.1447 * ((s1 / s0) ** 2) ** (1 / 3) * n ** (1 / 3)))
    variance = gamma(0) + 2 * sum((1 - k / (lags + 1)) * gamma(k) for k in range(1, lags + 1))
    return float(np.sum(np.cumsum(e) ** 2)) / n**2 / variance, lags


def complete(prices):
    return np.array([p for p in prices if p is not None], dtype=float)


@pytest.fixture(scope="module")
def data(spark):
    df = frame(spark, examples()).cache()
    return df, plain_layout(df)


def by_coin(rows):
    return {row["coin_id"]: row for row in rows.collect()}


def test_adf(data):
    found = by_coin(diagnostics.adf_test(*data))
    for (coin, _currency), prices in examples().items():
        statistic, lags = brute_adf(complete(prices))
        assert found[coin]["adf_lags_used"] == lags
        assert found[coin]["adf_statistic"] == pytest.approx(statistic, rel=1e-6)
        assert found[coin]["adf_p_value"] == pytest.approx(st.adf_p_value(statistic), abs=1e-8)


@pytest.mark.parametrize("trend", [True, False])
def test_kpss(data, trend):
    found = by_coin(diagnostics.kpss_test(*data, trend=trend))
    for (coin, _currency), prices in examples().items():
        statistic, lags = brute_kpss(complete(prices), trend)
        assert found[coin]["kpss_lags_used"] == lags
        assert found[coin]["kpss_statistic"] == pytest.approx(statistic, rel=1e-6)
        assert found[coin]["kpss_p_value"] == pytest.approx(kpss_p(statistic, trend), abs=1e-8)


def test_differences(data):
    found = by_coin(diagnostics.diff_stationarity(*data))
    for (coin, _currency), prices in examples().items():
        d = np.diff(complete(prices))
        assert found[coin]["adf_p_value_diff_price"] == pytest.approx(st.adf_p_value(brute_adf(d)[0]), abs=1e-8)
        kpss = kpss_p(brute_kpss(d, False)[0], False)
        assert found[coin]["kpss_p_value_diff_price"] == pytest.approx(kpss, abs=1e-8)


def test_verdicts(data):
    df, layout = data
    found = by_coin(diagnostics.stationarity(
        diagnostics.adf_test(df, layout), diagnostics.kpss_test(df, layout), layout))
    verdicts = {(True, False): "Evidence favors stationarity", (False, True): "Evidence favors non-stationarity",
                (True, True): "Conflicting evidence", (False, False): "Inconclusive"}
    for (coin, _currency), prices in examples().items():
        y = complete(prices)
        rejects = (st.adf_p_value(brute_adf(y)[0]) < 0.05, kpss_p(brute_kpss(y, True)[0], True) < 0.05)
        assert found[coin]["interpretation"] == verdicts[rejects]


def test_acf_and_pacf(data):
    df, layout = data
    acf_rows = diagnostics.acf(df, layout)
    found, partial = {}, {}
    for row in acf_rows.collect():
        found.setdefault(row["coin_id"], {})[row["lag"]] = row
    for row in diagnostics.pacf(acf_rows, layout).collect():
        partial.setdefault(row["coin_id"], {})[row["lag"]] = row
    for (coin, _currency), prices in examples().items():
        x = complete(prices)
        n, x = len(x), x - x.mean()
        lags = min(40, max(1, n // 2 - 1))
        r = [float(x[k:] @ x[:n - k]) / float(x @ x) for k in range(lags + 1)]
        assert sorted(found[coin]) == sorted(partial[coin]) == list(range(1, lags + 1))
        for k in range(1, lags + 1):
            assert found[coin][k]["acf"] == pytest.approx(r[k], abs=1e-9)
            band = 1.959963984540054 * np.sqrt((1 + 2 * sum(v * v for v in r[1:k])) / n)
            assert found[coin][k]["band"] == pytest.approx(band, rel=1e-9)
            toeplitz = np.array([[r[abs(i - j)] for j in range(k)] for i in range(k)])
            assert partial[coin][k]["pacf"] == pytest.approx(np.linalg.solve(toeplitz, r[1:k + 1])[-1], abs=1e-7)


def test_series_too_short_or_constant(spark):
    df = frame(spark, {("flat", "usd"): [3.0] * 50, ("three", "usd"): [1.0, 2.0, 4.0], ("one", "usd"): [1.0]})
    layout = plain_layout(df)
    adf = by_coin(diagnostics.adf_test(df, layout))
    assert set(adf) == {"flat", "three", "one"} and all(r["adf_statistic"] is None for r in adf.values())
    kpss = by_coin(diagnostics.kpss_test(df, layout))
    assert kpss["flat"]["kpss_statistic"] is None and kpss["one"]["kpss_statistic"] is None
    trend = by_coin(diagnostics.trend_test(df, layout))
    assert trend["flat"]["r_squared"] == 0 and trend["flat"]["p_value"] == 1.0
    assert trend["one"]["p_value"] is None
    assert diagnostics.acf(df, layout).filter("coin_id = 'flat' AND acf IS NOT NULL").isEmpty()


# Published values.

@pytest.mark.parametrize("t, df, p", [
    (2.228138852, 10, 0.05), (1.0, 1, 0.5), (12.7062047, 1, 0.05), (1.962339, 1000, 0.05), (2.580755, 1000, 0.01),
    (0.5, 1e10, 0.6170750774519738), (5.0, 1e10, 5.733031437583892e-07)])
def test_student(t, df, p):
    assert st.student_two_sided([t], [df])[0] == pytest.approx(p, rel=1e-5)


def test_student_has_no_steps():
    df = np.array([2, 3, 10, 50, 60, 70, 1e3, 1e6 - 1, 1e6 + 1, 1e9, 1e12])
    for t in (0.1, 1.0, 2.5, 5.0):
        p = st.student_two_sided(np.full(len(df), t), df)
        assert (np.diff(p) < 1e-12).all() and p[-1] == pytest.approx(math.erfc(t / math.sqrt(2)), rel=1e-8)
    assert st.student_two_sided([40.0], [100])[0] < 1e-60


@pytest.mark.parametrize("tau, p", [(-3.43, 0.010), (-2.86, 0.050), (-2.57, 0.099)])
def test_mackinnon(tau, p):
    assert st.adf_p_value(tau) == pytest.approx(p, abs=1e-3)


def test_kpss_table(spark):
    table = spark.createDataFrame([(x,) for x in (0.146, 9.0, 0.0, 0.739)], "s double")
    trend, level = ([r[0] for r in table.select(diagnostics.kpss_p_value(F.col("s"), t)).collect()] for t in (True, False))
    assert trend == pytest.approx([0.05, 0.01, 0.10, 0.01]) and level[3] == pytest.approx(0.01)
