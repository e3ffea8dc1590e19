"""Aggregates the built-in functions do not give in this form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def correlation(x: str, y: str) -> Column:
    """Pearson correlation over rows with both values; NULL where one does not vary.

    The built-in ``corr`` raises a division by zero for a constant column in ANSI mode,
    which would let one flat series stop the report of all.
    """
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    spread = F.stddev_pop(F.when(both, F.col(x))) * F.stddev_pop(F.when(both, F.col(y)))
    return F.try_divide(F.covar_pop(x, y), spread)


def limited(df: DataFrame, limit: int | None) -> DataFrame:
    """The first ``limit`` rows of an ordered report; all of them for None."""
    return df if limit is None else df.limit(limit)
