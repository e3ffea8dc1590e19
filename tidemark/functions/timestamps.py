"""Timestamp text, epochs and intervals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text form of the stored timestamps, a fixed value.
TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"


def epoch_ms_text(ms: Column) -> Column:
    """Millisecond epoch as text, whole seconds, in the session zone."""
    return F.from_unixtime(F.floor(ms / 1000), TEXT_FORMAT)


def parse_text(text: Column) -> Column:
    """Timestamp from text; NULL when the text does not parse."""
    return F.try_to_timestamp(text, F.lit(TEXT_FORMAT))


def minutes_between(later: Column, earlier: Column) -> Column:
    """Difference of whole-second epochs, in minutes."""
    return (F.unix_timestamp(later) - F.unix_timestamp(earlier)) / F.lit(60.0)
