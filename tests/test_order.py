"""Reports that promise an order keep it: rows are compared as they come, without sorting them first."""

import pytest
from workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"
SERIES = ("coin_id", "vs_currency")
# Columns to sort by, a leading minus for descending.
ORDERS = {
    "coverage": SERIES,
    "cadence_summary": SERIES,
    "interval_frequency": ("coin_id", "-count", "vs_currency", "interval_minutes"),
    "time_gaps": ("-interval_minutes", *SERIES, "timestamp"),
    "split_summary": (*SERIES, "dataset_type"),
    "forecast_metrics": (*SERIES, "dataset_type"),
    "out_of_control_summary": (*SERIES, "dataset_type"),
    "out_of_control": (*SERIES, "timestamp"),
    "return_outliers": (*SERIES, "timestamp"),
    "top_errors": ("-absolute_residual", *SERIES, "timestamp"),
    "top_test_errors": ("-absolute_residual", *SERIES, "timestamp"),
    "top_return_outliers": ("-absolute_return_pct", *SERIES, "timestamp"),
    "top_abs_returns": ("-absolute_return_pct", *SERIES, "timestamp"),
    "peek": (*SERIES, "timestamp", "event_id"),
    "dash_history": ("timestamp",),
}


@pytest.mark.parametrize("name", sorted(ORDERS))
def test_rows_come_in_order(spark, name):
    rows = QUERIES[name](spark, SF_DIR).collect()
    assert rows

    def key(row):
        return [-row[c[1:]].__float__() if c.startswith("-") else (row[c] is not None, row[c]) for c in ORDERS[name]]

    keys = [key(r) for r in rows]
    assert keys == sorted(keys)
