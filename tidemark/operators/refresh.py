"""Look-back features and moments that a new load extends instead of rebuilding.

Rows are stored with their features by day. An index holds, for each series and day, how many rows it has and the load
that wrote it last. A load reads the index, its own rows, and of the stored rows only the days it needs:

* a day is *dirty* if the load has rows for it, or if fewer than ``halo`` rows lie between it and the last day that has, so
  that a look-back from it may reach a new row; late rows make the days they fall into, and the next few, dirty;
* a day is *needed* if it is dirty, or if fewer than ``halo`` rows lie between it and the next dirty day.

Dirty days are computed again and written under the load's number; then the index gets their entries, which
makes them valid. A load that failed before that, or is run again, leaves no trace in what readers see. When all rows are newer
than the stored ones, what is read is the load and the last days of each series: its tail.

Moments of the complete rows are stored with the index by (series, day). The training rows of a series are its first 80 %, so
they are whole days and the beginning of one day: the moments of whole days are merged, and of the stored rows only
those of the one day are read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.features import TRAIN_RATIO
from tidemark.operators.moments import merge_moments, part_moments
from tidemark.operators.ordering import GROUP_COLS, INDEX, ORDER_COLS, join_series, measure_series, number_rows
from tidemark.operators.series import LAGS, add_lags, lag_names
from tidemark.session import materialize
from tidemark.sources.tables import path_exists, touched

DAY, LOAD = "_day", "_load"


def day_of(time_col: str) -> Column:
    return F.datediff(F.col(time_col).cast("date"), F.lit("1970-01-01").cast("date"))


@dataclass(frozen=True)
class FeatureStore:
    """Lag features under ``path``; all loads must have the same columns."""

    path: str
    value: str = "price"
    lags: Sequence[int] = LAGS
    group_cols: Sequence[str] = GROUP_COLS
    order_cols: Sequence[str] = ORDER_COLS
    time_col: str = "timestamp"
    plain_limit: int | None = None

    @property
    def key(self) -> list[str]:
        return [*self.group_cols, DAY]

    @property
    def names(self) -> list[str]:
        return lag_names(self.value, self.lags)

    def _rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/rows")

    def index(self, spark: SparkSession, below: int | None = None) -> DataFrame | None:
        """The valid entry of each series and day, of loads before ``below``: ``_rows, _load`` and the moments of its
        complete rows."""
        if not path_exists(spark, f"{self.path}/index"):
            return None
        entries = spark.read.parquet(f"{self.path}/index")
        if below is not None:
            entries = entries.filter(F.col(LOAD) < below)
        rest = [c for c in entries.columns if c not in self.key]
        latest = F.max(F.struct(LOAD, *[c for c in rest if c != LOAD])).alias("entry")
        return entries.groupBy(*self.key).agg(latest).select(*self.key, *[F.col(f"entry.{c}").alias(c) for c in rest])

    def plan(self, new_days: DataFrame, index: DataFrame | None) -> DataFrame:
        """``_dirty`` and ``_needed`` for each day of the series that ``new_days`` (key, ``_new``) touches."""
        if index is None:
            return new_days.select(*self.key, F.lit(True).alias("_dirty"), F.lit(False).alias("_needed"), F.lit(None).cast("long").alias(LOAD))
        halo = max(self.lags)
        series = new_days.select(*self.group_cols).distinct()
        old = join_series(index.select(*self.key, "_rows", LOAD), series, list(self.group_cols), "left_semi")
        both = old.withColumn("_new", F.lit(0).cast("long")).unionByName(
            new_days.withColumns({"_rows": F.lit(0).cast("long"), LOAD: F.lit(None).cast("long")}))
        days = both.groupBy(*self.key).agg(F.sum("_rows").alias("_rows"), F.sum("_new").alias("_new"), F.max(LOAD).alias(LOAD))
        along = Window.partitionBy(*self.group_cols).orderBy(DAY)
        before, after = along.rowsBetween(Window.unboundedPreceding, -1), along.rowsBetween(1, Window.unboundedFollowing)
        held = F.col("_rows") + F.col("_new")
        days = days.withColumn("_end", F.sum(held).over(along.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_begin", F.col("_end") - held)
        last_new = F.max(F.when(F.col("_new") > 0, F.col("_end"))).over(before)
        days = days.withColumn("_dirty", (F.col("_new") > 0) | F.coalesce(F.col("_begin") - last_new < halo, F.lit(False)))
        next_dirty = F.min(F.when(F.col("_dirty"), F.col("_begin"))).over(after)
        wanted = F.col("_dirty") | F.coalesce(next_dirty - F.col("_end") < halo, F.lit(False))
        return days.withColumn("_needed", wanted & F.col(LOAD).isNotNull()).select(*self.key, "_dirty", "_needed", LOAD)

    def _of(self, rows: DataFrame, entries: DataFrame) -> DataFrame:
        """Rows of the (series, day, load) that ``entries`` names."""
        return join_series(rows, entries.select(*self.key, LOAD), [*self.key, LOAD], "left_semi")

    def stored_rows(self, spark: SparkSession, entries: DataFrame) -> DataFrame:
        """The stored rows of ``entries``; days and loads that none names are not opened."""
        rows = touched(touched(self._rows(spark), DAY, entries), LOAD, entries)
        return self._of(rows, entries)

    def refresh(self, rows: DataFrame, load: int) -> DataFrame:
        """Add the rows of load number ``load`` (greater than all before); the days written, for a look at the work.

        Rows without a time are not stored: they have no place in a series.
        """
        spark = rows.sparkSession
        new = materialize(rows.filter(F.col(self.time_col).isNotNull()).withColumn(DAY, day_of(self.time_col)), "load")
        new_days = new.groupBy(*self.key).agg(F.count(F.lit(1)).alias("_new"))
        index = self.index(spark, load)
        plan = materialize(self.plan(new_days, index), "refresh-plan")
        every = new
        if index is not None:
            every = every.unionByName(self.stored_rows(spark, plan.filter("_needed")).select(*new.columns))
        options = {} if self.plain_limit is None else {"plain_limit": self.plain_limit}
        layout = measure_series(every, self.group_cols, self.order_cols, **options)
        made = add_lags(every, layout, self.value, self.lags)
        dirty = join_series(made, plan.filter("_dirty").select(*self.key), self.key, "left_semi")
        if plan.isEmpty():
            return plan
        dirty.hint("rebalance", DAY).write.mode("overwrite").partitionBy(DAY).parquet(f"{self.path}/rows/{LOAD}={load}")
        written = spark.read.parquet(f"{self.path}/rows/{LOAD}={load}")
        entries = written.groupBy(*self.key).agg(F.count(F.lit(1)).alias("_rows"))
        moments = part_moments(written.dropna(subset=self.names), [*self.names, self.value], self.key)
        join_series(entries, moments, self.key, "left").write.mode("overwrite").parquet(f"{self.path}/index/{LOAD}={load}")
        return plan

    def current(self, spark: SparkSession) -> DataFrame:
        """All rows with their features, each from the load that computed its day last."""
        return self._of(self._rows(spark), self.index(spark)).drop(DAY, LOAD)

    def train_moments(self, spark: SparkSession, ratio: float = TRAIN_RATIO) -> DataFrame:
        """Moments of the first ``floor(n * ratio)`` complete rows of each series."""
        along = Window.partitionBy(*self.group_cols).orderBy(DAY).rowsBetween(Window.unboundedPreceding, 0)
        days = self.index(spark).filter(F.col("n") > 0).withColumns({
            "_upto": F.sum("n").over(along), "_all": F.sum("n").over(Window.partitionBy(*self.group_cols))})
        days = materialize(days.withColumn("_train", F.floor(F.col("_all") * F.lit(ratio)).cast("long")), "train-days")
        whole = days.filter(F.col("_upto") <= F.col("_train")).select(*self.group_cols, "n", "means", "products")
        cut = days.filter((F.col("_upto") > F.col("_train")) & (F.col("_upto") - F.col("n") < F.col("_train"))).withColumn(
            "_take", F.col("_train") - F.col("_upto") + F.col("n"))
        rows = self.stored_rows(spark, cut).dropna(subset=self.names)
        layout = measure_series(rows, self.group_cols, self.order_cols)
        placed = join_series(number_rows(rows, layout), cut.select(*self.group_cols, "_take"), list(self.group_cols))
        part = part_moments(placed.filter(F.col(INDEX) < F.col("_take")), [*self.names, self.value], self.group_cols)
        return merge_moments(whole.unionByName(part), self.group_cols)
