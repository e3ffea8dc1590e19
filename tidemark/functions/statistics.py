"""Small numeric helpers that work on a few numbers per series."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd

# Fixed values. Normal quantile of a two-sided 95 % band.
Z95 = 1.959963984540054
# MacKinnon (1994), constant, one variable: bounds, switch point and polynomials in tau.
ADF_TAU_MAX, ADF_TAU_MIN, ADF_TAU_STAR = 2.74, -18.83, -1.61
ADF_SMALL = (2.1659, 1.4412, 0.038269)
ADF_LARGE = (1.7339, 0.93202, -0.12745, -0.010368)
# Kwiatkowski et al. (1992): p-values and their critical values.
KPSS_P = (0.10, 0.05, 0.025, 0.01)
KPSS_LEVEL = (0.347, 0.463, 0.574, 0.739)
KPSS_TREND = (0.119, 0.146, 0.176, 0.216)
# Smallest eigenvalue, relative to the largest, that still counts as information.
RANK_TOLERANCE = 1e-13
# Gauss-Legendre nodes on [0, 1] for each of the panels of an integral.
PANELS = 64
NODES, WEIGHTS = (x / 2 for x in np.polynomial.legendre.leggauss(16))
NODES = NODES + 0.5


def solve_centred(cross: pd.Series, target: pd.Series, means: pd.Series, label_mean: pd.Series) -> pd.Series:
    """Intercept and slopes from centred second moments, minimum norm where columns depend."""
    if not len(cross):
        return pd.Series([], dtype=object)
    y = np.stack([np.asarray(v, dtype=float) for v in target])
    k = y.shape[1]
    a = np.stack([np.asarray(v, dtype=float) for v in cross]).reshape(-1, k, k)
    slopes = np.einsum("nij,nj->ni", np.linalg.pinv(a, rcond=RANK_TOLERANCE, hermitian=True), y)
    x = np.stack([np.asarray(v, dtype=float) for v in means])
    intercept = label_mean.to_numpy(dtype=float) - (slopes * x).sum(axis=1)
    return pd.Series(list(np.column_stack([intercept, slopes])))


def student_two_sided(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    """Two-sided p-values of Student's t, by one formula for all degrees of freedom (1 or more).

    With ``t = sqrt(df) tan(a)`` the density becomes a power of the cosine, so the p-value is the share of
    ``cos(a) ** (df - 1)`` beyond ``a``. Tail and centre are integrated with the same nodes after
    the step ``a = s / sqrt(df)``, in which the integrand keeps a Gaussian shape however large ``df`` is.
    """
    t, df = np.abs(np.asarray(t, dtype=float))[:, None], np.asarray(df, dtype=float)[:, None]
    root = np.sqrt(df)
    start, end = root * np.arctan(t / root), root * (np.pi / 2)

    def area(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        # Relative to the value at the low end, which keeps far tails from underflowing.
        width = (high - low) / PANELS
        at = (low + width * np.arange(PANELS)[None, :])[:, :, None] + width[:, :, None] * NODES
        with np.errstate(divide="ignore"):
            power = (df - 1)[:, :, None] * (_log_cos(at / root[:, :, None]) - _log_cos(low / root)[:, :, None])
        return (np.exp(power) @ WEIGHTS * width).sum(axis=1, keepdims=True)

    def reach(low: np.ndarray) -> np.ndarray:
        # Beyond 13 widths of the Gaussian nothing is left; where the range is shorter it is taken whole.
        return np.minimum(end, low + 13.0)

    front = np.exp((df - 1) * _log_cos(start / root))
    tail, whole = front * area(start, reach(start)), area(np.zeros_like(start), reach(np.zeros_like(start)))
    return np.clip(tail / whole, 0.0, 1.0)[:, 0]


def _log_cos(angle: np.ndarray) -> np.ndarray:
    """Log of the cosine, exact near 0 where the cosine itself rounds to 1."""
    half = np.sin(angle / 2)
    return np.log1p(-2 * half * half)


def slope_p_values(r: np.ndarray, n: np.ndarray, slope: np.ndarray) -> np.ndarray:
    """p-values of zero slopes from correlations of ``n`` points; NaN where there is none."""
    r, n, slope = (np.asarray(x, dtype=float) for x in (r, n, slope))
    df, tiny = np.maximum(n - 2, 1), 1e-20
    bounded = np.clip(r, -1.0, 1.0)
    t = bounded * np.sqrt(df / ((1 - bounded + tiny) * (1 + bounded + tiny)))
    p = np.full(len(r), np.nan)
    known = ~np.isnan(r) & (n > 2)
    if known.any():
        p[known] = student_two_sided(t[known], df[known])
    two = ~np.isnan(r) & (n == 2)
    p[two] = np.where(slope[two] == 0, 1.0, 0.0)
    return p


def normal_cdf(x: float) -> float:
    return 0.5 * math.erfc(-x / math.sqrt(2))


def adf_p_value(tau: float) -> float:
    """Approximate p-value of a Dickey-Fuller statistic with a constant."""
    if tau > ADF_TAU_MAX:
        return 1.0
    if tau < ADF_TAU_MIN:
        return 0.0
    terms = ADF_SMALL if tau <= ADF_TAU_STAR else ADF_LARGE
    return normal_cdf(sum(c * tau**i for i, c in enumerate(terms)))


def partial_autocorrelations(acf: Sequence[float]) -> list[float]:
    """Durbin-Levinson recursion on autocorrelations of lags 1, 2, …"""
    r = np.asarray(acf, dtype=float)
    found: list[float] = []
    phi = np.empty(0)
    error = 1.0
    for k in range(len(r)):
        last = (r[k] - phi @ r[:k][::-1]) / error if error != 0 else float("nan")
        phi = np.append(phi - last * phi[::-1], last)
        error *= 1.0 - last * last
        found.append(float(last))
    return found


def adf_statistic(
    n: int, max_lag: int, dd: np.ndarray, zd: np.ndarray, zz: float, z_sum: float,
    head: np.ndarray, tail: np.ndarray,
) -> tuple[float, int] | None:
    """Dickey-Fuller statistic with a constant, lag order chosen by AIC.

    For a centred series ``z`` and its differences ``d``: ``dd[k]`` is the sum of
    ``d[t] d[t-k]``, ``zd[k]`` of ``z[t-1] d[t-k]``, ``zz`` of ``z[t-1]**2`` and ``z_sum``
    of ``z[t-1]``, each over all ``t >= 1`` for which the terms exist. ``head`` and ``tail``
    are the first and last ``max_lag + 1`` values of ``z``. A regression sample starts
    later than ``t = 1`` and its lagged terms end earlier than the series; the sums over
    it are the full sums less those few edge terms.
    """
    p = max_lag
    d_head = np.diff(head, prepend=0.0)  # d_head[u] = d[u] for 1 <= u <= p
    d_head[0] = 0.0
    d_tail = np.diff(tail)  # d[n-p] … d[n-1]

    def z_at(i: int) -> float:
        return head[i] if i <= p else tail[i - (n - 1 - p)]

    def moments(start: int, lags: int) -> tuple[np.ndarray, np.ndarray, float]:
        """Normal equations over ``t >= start`` with columns 1, z[t-1], d[t-1] … d[t-lags]."""
        cross_d = np.empty((lags + 1, lags + 1))
        for k in range(lags + 1):
            # With u = t - i, the terms of column pair (i, i + k) cover u in [start - i, n - 1 - i].
            first = d_head[1:start] * np.concatenate([np.zeros(min(k, start - 1)), d_head[1:max(start - k, 1)]])
            head_sums = np.concatenate([[0.0], np.cumsum(first)])
            ends = d_tail[k:] * d_tail[:len(d_tail) - k] if k < len(d_tail) else np.empty(0)
            tail_sums = np.concatenate([[0.0], np.cumsum(ends[::-1])])
            i = np.arange(lags + 1 - k)
            cross_d[i, i + k] = cross_d[i + k, i] = dd[k] - head_sums[start - i - 1] - tail_sums[i]
        z_d = np.array([
            zd[j] - float(head[j:start - 1] @ d_head[1:start - j]) for j in range(lags + 1)])
        d_sum = np.array([z_at(n - 1 - j) - z_at(start - 1 - j) for j in range(lags + 1)])
        earlier = head[:start - 1]
        size = lags + 2
        gram = np.empty((size, size))
        gram[0, 0] = n - start
        gram[0, 1] = gram[1, 0] = z_sum - earlier.sum()
        gram[1, 1] = zz - earlier @ earlier
        gram[0, 2:] = gram[2:, 0] = d_sum[1:]
        gram[1, 2:] = gram[2:, 1] = z_d[1:]
        gram[2:, 2:] = cross_d[1:, 1:]
        target = np.concatenate([[d_sum[0], z_d[0]], cross_d[0, 1:]])
        return gram, target, float(cross_d[0, 0])

    gram, target, total = moments(p + 1, p)
    scale = np.sqrt(np.diag(gram))
    if total <= 0 or not np.all(scale > 0):
        return None
    unit, unit_target = gram / np.outer(scale, scale), target / scale
    try:
        explained = np.cumsum(np.linalg.solve(np.linalg.cholesky(unit), unit_target) ** 2)[1:]
    except np.linalg.LinAlgError:
        explained = np.array([
            unit_target[:m] @ np.linalg.lstsq(unit[:m, :m], unit_target[:m], rcond=None)[0]
            for m in range(2, p + 3)])
    nobs = n - 1 - p
    left = np.maximum(total - explained, np.finfo(float).tiny)
    aic = nobs * np.log(left / nobs) + 2 * (np.arange(p + 1) + 2)
    lag = int(np.argmin(aic))

    gram, target, total = moments(lag + 1, lag)
    nobs, columns = n - 1 - lag, lag + 2
    scale = np.sqrt(np.diag(gram))
    if nobs <= columns or not np.all(scale > 0):
        return None
    inverse = np.linalg.pinv(gram / np.outer(scale, scale), hermitian=True)
    beta = inverse @ (target / scale)
    variance = (total - beta @ (target / scale)) / (nobs - columns) * inverse[1, 1]
    if not variance > 0:
        return None
    return float(beta[1] / math.sqrt(variance)), lag
