"""Row order inside a series, for series of any length.

A series is the set of rows that share ``group_cols``, read in the order of
``order_cols``. ``order_cols`` must give a total order, so that lags and splits
have one answer.

``Window.partitionBy(series)`` puts a whole series in one task. That is the best
plan while the longest series is known to be short, and impossible when one series
holds a third of a very large table. ``measure_series`` counts once; every operator
here then takes one of two exact routes:

* short series: the plain window, one shuffle;
* long series: rows are range-partitioned on (series, order), numbered, cut into
  blocks of equal row count, and each block receives a copy of the last rows of the
  block before it (the halo). Windows then run per block, so the size of a task does
  not depend on how rows spread over series.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import materialize

GROUP_COLS = ("coin_id", "vs_currency")
ORDER_COLS = ("timestamp_unix_ms", "price")

# Longest series that one window task may hold.
PLAIN_LIMIT = 2_000_000
ROWS_PER_BLOCK = 262_144
# Per-series tables (means, limits, coefficients) are broadcast up to this many bytes.
BROADCAST_BYTES = 64 * 1024 * 1024
ROW_BYTES, NUMBER_BYTES = 16, 8

FIXED_SIZE = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)

INDEX = "_idx"
BLOCK = "_block"
HALO = "_halo"


@dataclass(frozen=True)
class SeriesLayout:
    """Measured shape of a table of series."""

    group_cols: tuple[str, ...]
    order_cols: tuple[str, ...]
    series: int
    longest: int
    rows: int
    key_bytes: int = 64
    plain_limit: int = PLAIN_LIMIT
    rows_per_block: int = ROWS_PER_BLOCK
    broadcast_bytes: int = BROADCAST_BYTES

    @property
    def blocked(self) -> bool:
        return self.longest > self.plain_limit

    def fits_broadcast(self, side: DataFrame, rows: int) -> bool:
        """Whether ``rows`` rows of series keys and fixed-size columns are small; other columns have no known size."""
        rest = [f.dataType for f in side.schema.fields if f.name not in self.group_cols]
        if not all(isinstance(t, FIXED_SIZE) for t in rest):
            return False
        return rows * (ROW_BYTES + self.key_bytes + NUMBER_BYTES * len(rest)) <= self.broadcast_bytes

    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.group_cols).orderBy(*self.order_cols)

    def ordered_by(self, *order_cols: str) -> SeriesLayout:
        return replace(self, order_cols=order_cols)


def measure_series(
    df: DataFrame,
    group_cols: Sequence[str] = GROUP_COLS,
    order_cols: Sequence[str] = ORDER_COLS,
    plain_limit: int = PLAIN_LIMIT,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> SeriesLayout:
    """Count rows per series (partial aggregation, key columns only) and reduce to one row."""
    key_bytes = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in group_cols), F.lit(0))
    row = (
        df.groupBy(*group_cols)
        .agg(F.count(F.lit(1)).alias("rows"))
        .agg(
            F.count(F.lit(1)).alias("series"),
            F.coalesce(F.max("rows"), F.lit(0)).alias("longest"),
            F.coalesce(F.sum("rows"), F.lit(0)).alias("all_rows"),
            F.coalesce(F.max(key_bytes), F.lit(0)).alias("key_bytes"),
        )
        .first()
    )
    return SeriesLayout(
        tuple(group_cols), tuple(order_cols), row["series"], row["longest"], row["all_rows"],
        row["key_bytes"], plain_limit, rows_per_block,
    )


def attach_stats(df: DataFrame, stats: DataFrame, layout: SeriesLayout) -> DataFrame:
    """Left join of one-row-per-series ``stats``; a missing key part is a key like any other.

    Broadcast when the measured number of series and the columns of ``stats`` bound its size;
    beyond that a shuffled join, whose hot series adaptive execution splits at run time.
    """
    return join_series(df, stats, layout.group_cols, "left", layout.fits_broadcast(stats, layout.series))


def series_stats(df: DataFrame, stats: Mapping[str, Column], layout: SeriesLayout) -> DataFrame:
    """Add aggregates over each row's whole series to rows that are grouped by series anyhow.

    Short series: window aggregates, which use the partitioning of the windows before them, so the
    rows are neither read nor shuffled again. Long ones: one aggregation with partial sums, joined.
    """
    if layout.blocked:
        return attach_stats(df, df.groupBy(*layout.group_cols).agg(*[c.alias(n) for n, c in stats.items()]), layout)
    whole = Window.partitionBy(*layout.group_cols)
    return df.withColumns({name: column.over(whole) for name, column in stats.items()})


def number_rows(df: DataFrame, layout: SeriesLayout, name: str = INDEX) -> DataFrame:
    """Add the 0-based position of each row in its series."""
    if not layout.blocked:
        return df.withColumn(name, (F.row_number().over(layout.window()) - 1).cast("long"))

    keys = [*layout.group_cols, *layout.order_cols]
    sorted_rows = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    stored = materialize(sorted_rows, "sorted").withColumn("_part", F.shiftright("_at", 33))
    # Rows are sorted, so there is one run per series plus at most one per partition edge.
    earlier = Window.partitionBy(*layout.group_cols).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = (
        stored.groupBy(*layout.group_cols, "_part")
        .agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
        .select(*layout.group_cols, "_part", "_first",
                F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    )
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    small = layout.fits_broadcast(runs, layout.series + partitions)
    return join_series(stored, runs, [*layout.group_cols, "_part"], small=small).select(
        *df.columns, (F.col("_at") - F.col("_first") + F.col("_before")).alias(name))


def spread_blocks(df: DataFrame, layout: SeriesLayout, halo: int) -> DataFrame:
    """Assign numbered rows to blocks, copying each block's last ``halo`` rows to the next.

    Short series stay whole: one block, no copies.
    """
    if not layout.blocked:
        return df.withColumns({BLOCK: F.lit(0).cast("long"), HALO: F.lit(False)})
    size = max(layout.rows_per_block, halo)
    own = F.floor(F.col(INDEX) / size).cast("long")
    homes = F.when(F.pmod(F.col(INDEX), F.lit(size)) >= size - halo, F.array(own, own + 1)).otherwise(F.array(own))
    return (
        df.withColumn("_own", own)
        .withColumn(BLOCK, F.explode(homes))
        .withColumn(HALO, F.col(BLOCK) != F.col("_own"))
        .drop("_own")
    )


def with_lookback(
    df: DataFrame,
    layout: SeriesLayout,
    rows: int,
    add_columns: Callable[[DataFrame, WindowSpec], DataFrame],
    keep_index: bool = False,
) -> DataFrame:
    """Run window expressions that look back at most ``rows`` rows.

    ``add_columns(frame, window)`` adds columns over the window it is given and must
    not drop rows. ``keep_index`` leaves the index that the long route needs anyway.
    """
    if not layout.blocked:
        return add_columns(df, layout.window())
    spread = spread_blocks(number_rows(df, layout), layout, rows)
    window = Window.partitionBy(*layout.group_cols, BLOCK).orderBy(INDEX)
    own_rows = add_columns(spread, window).filter(~F.col(HALO)).drop(HALO, BLOCK)
    return own_rows if keep_index else own_rows.drop(INDEX)


def running_total(
    df: DataFrame, layout: SeriesLayout, amount: Column, running: str, total: str
) -> DataFrame:
    """Add the running and the whole sum of ``amount`` along the series, and drop the index.

    Rows carry the series index where series are long; short ones may go by ``order_cols``.
    """
    group = list(layout.group_cols)
    if not layout.blocked:
        order = [INDEX] if INDEX in df.columns else layout.order_cols
        along = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumns({
            running: F.sum(amount).over(along),
            total: F.sum(amount).over(Window.partitionBy(*group)),
        }).drop(INDEX)

    size = layout.rows_per_block
    stored = materialize(df.withColumn("_amount", amount), "running")
    stored = stored.withColumn(BLOCK, F.floor(F.col(INDEX) / size).cast("long"))
    along = Window.partitionBy(*group, BLOCK).orderBy(INDEX).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*group).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        stored.groupBy(*group, BLOCK).agg(F.sum("_amount").alias("_sum"))
        .select(*group, BLOCK, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"),
                F.sum("_sum").over(Window.partitionBy(*group)).alias(total))
    )
    placed = stored.withColumn("_in_block", F.sum("_amount").over(along))
    return (
        join_series(placed, offsets, [*group, BLOCK],
                    small=layout.fits_broadcast(offsets, layout.series + layout.rows // size))
        .withColumn(running, F.col("_in_block") + F.col("_before"))
        .drop("_before", "_in_block", "_amount", BLOCK, INDEX)
    )


def join_series(
    df: DataFrame, side: DataFrame, keys: Sequence[str], how: str = "inner", small: bool = False
) -> DataFrame:
    """Join in which NULL keys meet, as they do in ``groupBy``, keeping ``df``'s key columns."""
    renamed = side.withColumnsRenamed({k: f"_side_{k}" for k in keys})
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_side_{k}"))
    joined = df.join(F.broadcast(renamed) if small else renamed, condition, how)
    return joined.drop(*[f"_side_{k}" for k in keys])


def discrete_percentiles(column: str, shares: Sequence[float]) -> Column:
    """An aggregate: the least values of ``column`` that at least these shares of its values do not exceed, as an array."""
    name = "`" + column.replace("`", "``") + "`"
    return F.expr(f"percentile_disc(array({', '.join(f'{s!r}D' for s in shares)})) WITHIN GROUP (ORDER BY {name})")


def series_quantiles(
    df: DataFrame, layout: SeriesLayout, value: str, quantiles: dict[str, float], discrete: bool = False
) -> DataFrame:
    """Exact quantiles of ``value`` per series, linearly interpolated, or ``discrete``: values that occur.

    The built-in ``percentile`` keeps a map of all values of a group, so it is used for
    short series only. For long ones equal values are counted first, the distinct values
    are put in order by the sort route above, and the running counts locate the two
    neighbours of each quantile.
    """
    group = list(layout.group_cols)
    rows = df.filter(F.col(value).isNotNull()).select(*group, value)
    if not layout.blocked:
        # One map of the values serves all quantiles.
        percentiles = (discrete_percentiles(value, list(quantiles.values())) if discrete
                       else F.percentile(value, F.array(*map(F.lit, quantiles.values()))))
        found = rows.groupBy(*group).agg(percentiles.alias("_at"))
        return found.select(*group, *[F.get("_at", F.lit(i)).alias(name) for i, name in enumerate(quantiles)])

    counted = rows.groupBy(*group, value).agg(F.count(F.lit(1)).alias("_copies"))
    by_value = layout.ordered_by(value)
    placed = running_total(number_rows(counted, by_value), by_value, F.col("_copies"), "_upto", "_n")

    def at(q: float) -> Column:
        rank = (F.col("_n") - 1) * F.lit(q)

        def value_at(position: Column) -> Column:
            here = (F.col("_upto") - F.col("_copies") <= position) & (position < F.col("_upto"))
            return F.max(F.when(here, F.col(value)))

        if discrete:
            return value_at(F.greatest(F.ceil(F.col("_n") * F.lit(q)) - 1, F.lit(0)))
        low = value_at(F.floor(rank))
        return low + (value_at(F.ceil(rank)) - low) * F.max(rank - F.floor(rank))

    return placed.groupBy(*group).agg(*[at(q).alias(name) for name, q in quantiles.items()])
