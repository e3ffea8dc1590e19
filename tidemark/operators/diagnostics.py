"""Trend, stationarity and autocorrelation of series, as grouped Spark jobs.

Long sums run in Spark, per series or per block of a series; only a few numbers per
series reach a numeric helper.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.functions.columns import correlation
from tidemark.functions.statistics import (
    KPSS_LEVEL, KPSS_P, KPSS_TREND, Z95, adf_p_value, adf_statistic, partial_autocorrelations, slope_p_values,
)
from tidemark.operators.ordering import (
    BLOCK, HALO, INDEX, SeriesLayout, attach_stats, join_series, number_rows, series_stats, spread_blocks,
    with_lookback,
)
from tidemark.session import materialize

MAX_LAGS = 40
SIGNIFICANCE = 0.05
# The wording by which test rejects its null hypothesis.
VERDICTS = {
    "adf only": "Evidence favors stationarity",
    "kpss only": "Evidence favors non-stationarity",
    "both": "Conflicting evidence",
    "neither": "Inconclusive",
}


def complete_rows(df: DataFrame, value: str = "price", time_col: str = "timestamp") -> DataFrame:
    """Rows with a timestamp and a value."""
    return df.filter(F.col(time_col).isNotNull() & F.col(value).isNotNull())


def _group_schema(df: DataFrame, layout: SeriesLayout) -> list[T.StructField]:
    return [T.StructField(c, df.schema[c].dataType) for c in layout.group_cols]


# Linear trend

def trend_fit(numbered: DataFrame, layout: SeriesLayout, value: str = "price") -> DataFrame:
    """Least-squares line of a value on its index 0 … n-1."""
    x, y = F.col(INDEX), F.col(value)
    flat = F.var_pop(y) == 0
    return numbered.groupBy(*layout.group_cols).agg(
        F.count(y).alias("n"),
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.when(flat, F.lit(0.0)).otherwise(correlation(value, INDEX)).alias("_r"),
    ).select(*layout.group_cols, "n", "slope", "intercept", (F.col("_r") * F.col("_r")).alias("r_squared"), "_r")


@F.pandas_udf(T.DoubleType())
def _slope_p(r: pd.Series, n: pd.Series, slope: pd.Series) -> pd.Series:
    return pd.Series(slope_p_values(r.to_numpy(), n.to_numpy(), slope.to_numpy()))


def trend_test(df: DataFrame, layout: SeriesLayout, value: str = "price") -> DataFrame:
    """Trend line with the two-sided p-value of its slope."""
    fit = trend_fit(number_rows(complete_rows(df, value), layout), layout, value)
    p = _slope_p(F.col("_r"), F.col("n"), F.col("slope"))
    return fit.withColumn("p_value", p).drop("_r").withColumn(
        "significant_trend_5pct", F.col("p_value") < SIGNIFICANCE)


def trend_line(df: DataFrame, layout: SeriesLayout, value: str = "price") -> DataFrame:
    """Each row with the value of its series' trend line."""
    numbered = number_rows(complete_rows(df, value), layout)
    x, y = F.col(INDEX), F.col(value)
    fitted = series_stats(numbered, {"_slope": F.regr_slope(y, x), "_intercept": F.regr_intercept(y, x)}, layout)
    return fitted.select(*layout.group_cols, "timestamp", value, (F.col("_intercept") + F.col("_slope") * x).alias("linear_trend"))


# Sums over blocks

def _block_sums(
    df: DataFrame, layout: SeriesLayout, halo: int, sums: Callable[[pd.DataFrame], list[tuple[str, int, float]]]
) -> DataFrame:
    """Apply ``sums`` to every block (with its halo, in order) and add up equal (part, lag).

    A block is a whole series only where series are measured to be short.
    """
    group = list(layout.group_cols)

    schema = T.StructType([
        *_group_schema(df, layout), T.StructField("part", T.StringType()),
        T.StructField("lag", T.LongType()), T.StructField("amount", T.DoubleType())])
    arrow_schema = to_arrow_schema(schema)

    def per_block(rows: pa.Table) -> pa.Table:
        # Key text stays in Arrow; only the numeric columns become arrays.
        numbers = rows.drop_columns(group).sort_by(INDEX).to_pandas()
        parts = sums(numbers)
        columns = [pa.array([rows[c][0].as_py()] * len(parts), arrow_schema.field(c).type) for c in group]
        columns += [pa.array([row[i] for row in parts], arrow_schema.field(len(group) + i).type) for i in range(3)]
        return pa.Table.from_arrays(columns, schema=arrow_schema)

    return (
        spread_blocks(df, layout, halo).groupBy(*group, BLOCK).applyInArrow(per_block, schema)
        .groupBy(*group, "part", "lag").agg(F.sum("amount").alias("amount"))
    )


def _numbered_values(complete: DataFrame, layout: SeriesLayout, value: str) -> DataFrame:
    """Series keys, index and value; nothing else is sorted or shuffled."""
    needed = dict.fromkeys([*layout.group_cols, *layout.order_cols, value])
    return number_rows(complete.select(*needed), layout).select(*layout.group_cols, INDEX, value)


def _own_start(rows: pd.DataFrame) -> int:
    """Number of halo rows at the front of a block."""
    return int(rows[HALO].sum())


def _lagged_dot(a: np.ndarray, b: np.ndarray, start: int, lag: int) -> float:
    """Sum of ``a[t] b[t-lag]`` over own rows whose lagged row exists."""
    first = max(start, lag)
    return float(a[first:] @ b[first - lag:len(b) - lag]) if first < len(a) else 0.0


# Augmented Dickey-Fuller

def _adf_max_lag(n):
    """Schwert's rule, and no more than the sample allows."""
    return F.least(F.ceil(12 * F.pow(n / 100, F.lit(0.25))), F.floor(n / 2) - 2)


def _adf_sums(rows: pd.DataFrame) -> list[tuple[str, int, float]]:
    n, p = int(rows["_n"].iloc[0]), int(rows["_max_lag"].iloc[0])
    z, index = rows["_z"].to_numpy(), rows[INDEX].to_numpy()
    start = _own_start(rows)
    if start == len(z):
        return []
    d = np.diff(z, prepend=z[0])
    first = max(start, 1)
    if index[0] > 0:
        d[0] = 0.0
    before = np.concatenate([[0.0], z[:-1]])  # z[t-1]
    out = [("zz", 0, float(before[first:] @ before[first:])), ("z", 0, float(before[first:].sum()))]
    for k in range(p + 1):
        out.append(("dd", k, _lagged_dot(d, d, first, k)))
        out.append(("zd", k, _lagged_dot(before, d, first, k)))
    own_index, own_z = index[start:], z[start:]
    out += [("head", int(i), float(v)) for i, v in zip(own_index, own_z) if i <= p] if own_index[0] <= p else []
    if own_index[-1] >= n - 1 - p:
        out += [("tail", int(i) - (n - 1 - p), float(v)) for i, v in zip(own_index, own_z) if i >= n - 1 - p]
    return out


def adf_test(df: DataFrame, layout: SeriesLayout, value: str = "price") -> DataFrame:
    """Dickey-Fuller test of the level with a constant, lag order by AIC.

    Lagged products are summed per block and lag; the regressions of all lag orders
    follow from those sums. NULL where a series is too short or constant.
    """
    group = list(layout.group_cols)
    complete = complete_rows(df, value)
    sizes = materialize(
        complete.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"), F.avg(value).alias("_mean"))
        .withColumn("_max_lag", _adf_max_lag(F.col("_n"))), "sizes")
    rows = attach_stats(_numbered_values(complete, layout, value), sizes, layout).select(
        *group, INDEX, "_n", "_max_lag", (F.col(value) - F.col("_mean")).alias("_z"))
    # The longest series bounds every lag order, and so the halo.
    halo = int(np.ceil(12 * (layout.longest / 100) ** 0.25)) + 1
    sums = _block_sums(rows.filter(F.col("_max_lag") >= 0), layout, halo, _adf_sums)
    schema = T.StructType([
        *_group_schema(df, layout), T.StructField("adf_statistic", T.DoubleType()),
        T.StructField("adf_p_value", T.DoubleType()), T.StructField("adf_lags_used", T.LongType())])

    def solve(parts: pd.DataFrame) -> pd.DataFrame:
        by_part = dict(list(parts.sort_values("lag").groupby("part")["amount"]))

        def values(part: str) -> np.ndarray:
            return by_part[part].to_numpy()

        found = adf_statistic(
            int(parts["_n"].iloc[0]), int(parts["_max_lag"].iloc[0]), values("dd"), values("zd"),
            values("zz")[0], values("z")[0], values("head"), values("tail"))
        key = [parts[c].iloc[0] for c in group]
        row = [*key, None, None, None] if found is None else [*key, found[0], adf_p_value(found[0]), found[1]]
        return pd.DataFrame([row], columns=schema.names)

    # Few bytes but much arithmetic per series: a fixed number of partitions keeps adaptive
    # execution from merging them into one task.
    partitions = max(1, min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), layout.series))
    solved = (
        join_series(sums, sizes.select(*group, "_n", "_max_lag"), group).repartition(partitions, *group)
        .groupBy(*group).applyInPandas(solve, schema)
    )
    return join_series(sizes.select(*group), solved, group, "left").withColumn(
        "adf_reject_h0_5pct", F.col("adf_p_value") < SIGNIFICANCE)


# KPSS

def _kpss_first_sums(rows: pd.DataFrame) -> list[tuple[str, int, float]]:
    """Autocovariance sums, and what a block adds to the squares of the running sum.

    If the residuals before a block add up to ``c``, and ``s`` are its own running sums, the
    block adds the sum of ``(c + s)**2``: its rows, ``s`` and ``s**2`` summed are enough.
    """
    e, start = rows["_e"].to_numpy(), _own_start(rows)
    if start == len(e):
        return []
    out = [("ee", k, _lagged_dot(e, e, start, k)) for k in range(int(rows["_cov_lags"].iloc[0]) + 1)]
    block, walk = int(rows[BLOCK].iloc[0]), np.cumsum(e[start:])
    return out + [("rows", block, float(len(walk))), ("end", block, float(walk[-1])),
                  ("walk", block, float(walk.sum())), ("squares", block, float(walk @ walk))]


def _walk_squares(sums: DataFrame, layout: SeriesLayout) -> DataFrame:
    """Sum of squares of the running residual sum, from the parts of the blocks in order."""
    group = list(layout.group_cols)

    def part(name: str):
        return F.sum(F.when(F.col("part") == name, F.col("amount"))).alias(f"_{name}")

    blocks = sums.filter(F.col("part") != "ee").groupBy(*group, "lag").agg(
        *[part(p) for p in ("rows", "end", "walk", "squares")])
    earlier = Window.partitionBy(*group).orderBy("lag").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("_start")
    return blocks.withColumn("_start", F.coalesce(F.sum("_end").over(earlier), F.lit(0.0))).groupBy(*group).agg(
        F.sum(F.col("_rows") * start * start + 2 * start * F.col("_walk") + F.col("_squares")).alias("_walk_squares"))


def _kpss_window_sums(rows: pd.DataFrame) -> list[tuple[str, int, float]]:
    """Sum of squared moving sums of ``lags + 1`` residuals.

    Divided by ``lags + 1`` that equals the autocovariance sum with weights
    ``1 - k / (lags + 1)``, in time that does not depend on the number of lags.
    """
    e, start = rows["_e"].to_numpy(), _own_start(rows)
    if start == len(e):
        return []
    lags, n = int(rows["kpss_lags_used"].iloc[0]), int(rows["_n"].iloc[0])
    upto = np.concatenate([[0.0], np.cumsum(e)])
    ends = np.arange(start, len(e))
    sums = upto[ends + 1] - upto[np.maximum(ends - lags, 0)]
    total = float(sums @ sums)
    if rows[INDEX].iloc[-1] == n - 1 and lags > 0:
        running_out = np.cumsum(e[::-1][:lags])
        total += float(running_out @ running_out)
    return [("windows", 0, total)]


def kpss_p_value(statistic: Column, trend: bool) -> Column:
    """p-value interpolated between the tabulated ones, which also bound it."""
    at = KPSS_TREND if trend else KPSS_LEVEL
    p = F.when(statistic <= at[0], KPSS_P[0])
    for low, high, p_low, p_high in zip(at, at[1:], KPSS_P, KPSS_P[1:]):
        p = p.when(statistic <= high, p_low + (p_high - p_low) * (statistic - low) / (high - low))
    return p.when(statistic > at[-1], KPSS_P[-1])


def kpss_test(df: DataFrame, layout: SeriesLayout, value: str = "price", trend: bool = True) -> DataFrame:
    """KPSS test around a linear trend, or around the mean; automatic bandwidth."""
    group = list(layout.group_cols)
    complete = complete_rows(df, value)
    numbered = _numbered_values(complete, layout, value)
    x, y, n = F.col(INDEX), F.col(value), F.col("_n")
    if trend:
        fits = numbered.groupBy(*group).agg(
            F.count(y).alias("_n"), F.regr_intercept(y, x).alias("_a"), F.regr_slope(y, x).alias("_b"))
    else:
        fits = complete.groupBy(*group).agg(F.count(y).alias("_n"), F.avg(y).alias("_a"), F.lit(0.0).alias("_b"))
    fits = materialize(fits.withColumn("_cov_lags", F.floor(F.pow(n, F.lit(2.0 / 9.0)))), "fits")
    residuals = attach_stats(numbered, fits, layout).select(
        *group, INDEX, "_n", "_cov_lags", (y - (F.col("_a") + F.col("_b") * x)).alias("_e")
    ).filter(F.col("_e").isNotNull())

    first_halo = int(max(layout.longest, 1) ** (2.0 / 9.0)) + 1
    # Small tables that several later steps read are stored, so the rows are not walked again.
    first = materialize(_block_sums(residuals, layout, first_halo, _kpss_first_sums), "sums")
    # gamma_k enters s0 once for k = 0 and twice for k > 0; s1 weighs it by k.
    double = F.col("amount") * F.when(F.col("lag") == 0, 1).otherwise(2) / n
    bandwidth = join_series(first.filter(F.col("part") == "ee"), fits.select(*group, "_n"), group).groupBy(*group).agg(
        F.first("_n").alias("_n"), F.sum(double).alias("_s0"), F.sum(double * F.col("lag")).alias("_s1"))
    ratio = F.try_divide(F.col("_s1"), F.col("_s0"))
    third = F.lit(1.0 / 3.0)
    lags = F.floor(1.1447 * F.pow(ratio * ratio, third) * F.pow(n, third))
    chosen = bandwidth.select(*group, F.least(F.greatest(lags, F.lit(0)), n - 1).alias("kpss_lags_used"))

    halo = 0
    if layout.blocked:
        halo = int(chosen.agg(F.coalesce(F.max("kpss_lags_used"), F.lit(0))).first()[0]) + 1
    tagged = attach_stats(residuals, chosen, layout).filter(F.col("kpss_lags_used").isNotNull())
    spread_sums = _block_sums(tagged, layout, halo, _kpss_window_sums).select(*group, F.col("amount").alias("_windows"))
    walks = _walk_squares(first, layout)

    variance = F.col("_windows") / (F.col("kpss_lags_used") + 1) / n
    joined = fits.select(*group, "_n")
    for side in (walks, chosen, spread_sums):
        joined = join_series(joined, side, group, "left")
    return (
        joined
        .withColumn("kpss_statistic", F.try_divide(F.col("_walk_squares") / (n * n), variance))
        .withColumn("kpss_p_value", kpss_p_value(F.col("kpss_statistic"), trend))
        .select(*group, "kpss_statistic", "kpss_p_value", "kpss_lags_used",
                (F.col("kpss_p_value") < SIGNIFICANCE).alias("kpss_reject_h0_5pct"))
    )


# Verdicts

def stationarity(adf: DataFrame, kpss: DataFrame, layout: SeriesLayout) -> DataFrame:
    """Both tests side by side, and what they say together."""
    a, k = F.col("adf_reject_h0_5pct"), F.col("kpss_reject_h0_5pct")
    return join_series(adf, kpss, layout.group_cols).withColumn(
        "interpretation",
        F.when(a & ~k, VERDICTS["adf only"]).when(~a & k, VERDICTS["kpss only"])
        .when(a & k, VERDICTS["both"]).when(~a & ~k, VERDICTS["neither"]))


def first_differences(df: DataFrame, layout: SeriesLayout, value: str = "price") -> DataFrame:
    """Change from the previous complete row, without the first row of each series."""
    def columns(frame: DataFrame, window: WindowSpec) -> DataFrame:
        return frame.withColumn("_difference", F.col(value) - F.lag(value).over(window))

    changed = with_lookback(complete_rows(df, value), layout, 1, columns)
    return changed.filter(F.col("_difference").isNotNull())


def diff_stationarity(df: DataFrame, layout: SeriesLayout, value: str = "price") -> DataFrame:
    """Both tests on first differences, KPSS around the mean."""
    changed = first_differences(df, layout, value)
    adf = adf_test(changed, layout, "_difference")
    kpss = kpss_test(changed, layout, "_difference", trend=False)
    return join_series(adf, kpss, layout.group_cols).select(
        *layout.group_cols,
        F.col("adf_p_value").alias("adf_p_value_diff_price"),
        F.col("kpss_p_value").alias("kpss_p_value_diff_price"),
        (F.col("adf_p_value") < SIGNIFICANCE).alias("adf_stationary_5pct"),
        (F.col("kpss_p_value") >= SIGNIFICANCE).alias("kpss_stationary_5pct"))


# Autocorrelation

def _acf_sums(rows: pd.DataFrame) -> list[tuple[str, int, float]]:
    x, start = rows["_x"].to_numpy(), _own_start(rows)
    return [("xx", k, _lagged_dot(x, x, start, k)) for k in range(int(rows["_lags"].iloc[0]) + 1)]


def acf(df: DataFrame, layout: SeriesLayout, value: str = "price", max_lags: int = MAX_LAGS) -> DataFrame:
    """Autocorrelations of lags 1 … min(max_lags, max(1, n//2 - 1)) with a 95 % band.

    Values are centred once; the products of all lags are summed per block.
    """
    group = list(layout.group_cols)
    complete = complete_rows(df, value)
    n = F.col("n")
    lags = F.least(F.lit(max_lags), F.greatest(F.lit(1), F.floor(n / 2) - 1), n - 1).cast("int")
    sizes = materialize(
        complete.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("_mean"))
        .withColumn("_lags", lags), "sizes")
    centred = attach_stats(_numbered_values(complete, layout, value), sizes, layout).filter(F.col("_lags").isNotNull()).select(
        *group, INDEX, "_lags", (F.col(value) - F.col("_mean")).alias("_x"))
    products = _block_sums(centred, layout, max_lags, _acf_sums)
    products = join_series(products, sizes.select(*group, "n"), group)

    # At most max_lags + 1 rows per series from here on.
    in_order = Window.partitionBy(*group).orderBy("lag")
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    scaled = products.withColumn("acf", F.try_divide(F.col("amount"), F.first("amount").over(in_order)))
    before = F.sum(F.when(F.col("lag") > 0, F.col("acf") * F.col("acf"))).over(earlier)
    return scaled.withColumn(
        "band", Z95 * F.sqrt((1 + 2 * F.coalesce(before, F.lit(0.0))) / n)
    ).filter(F.col("lag") > 0).select(*group, "n", F.col("lag").cast("int").alias("lag"), "acf", "band")


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _durbin_levinson(values: pd.Series) -> pd.Series:
    return values.map(partial_autocorrelations)


def pacf(acf_rows: DataFrame, layout: SeriesLayout) -> DataFrame:
    """Partial autocorrelations (Yule-Walker) from autocorrelations, with a 95 % band."""
    group = list(layout.group_cols)
    in_order = F.sort_array(F.collect_list(F.struct("lag", "acf")))
    return (
        acf_rows.filter(F.col("acf").isNotNull())
        .groupBy(*group, "n").agg(in_order.alias("_rows"))
        .select(*group, "n", F.posexplode(_durbin_levinson(F.col("_rows.acf"))).alias("_at", "pacf"))
        .select(*group, "n", (F.col("_at") + 1).alias("lag"), "pacf",
                (Z95 / F.sqrt(F.col("n"))).alias("band"))
    )
