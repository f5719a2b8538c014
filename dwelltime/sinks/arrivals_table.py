"""Measured arrivals on disk: one partition a service day, replaced whole in one commit."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame

from dwelltime.operators.match import stored_columns
from dwelltime.sinks import day_table

ORDER = ["agency", "line", "trip_id", "stop_sequence"]


def write_arrivals(arrivals: DataFrame, path: str, days: Iterable[date] = ()) -> None:
    """Replace the days present in `arrivals` and the given ones; leave every other day alone.

    A given day without rows ends up empty. Until the commit readers see the days as they were,
    also where the write fails.
    """
    day_table.write_days(stored_columns(arrivals), path, days, order=ORDER)
