"""Collapses position reports to one row per trip stop."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from dwelltime import fixed_values as fixed

STOP_KEYS = ["service_date", "agency", "trip_id", "stop_sequence"]


def observed_stops(observations: DataFrame, keys: Sequence[str] = STOP_KEYS) -> DataFrame:
    """First and last stopped report, last approach, and the stop ids reported.

    The distinct count groups by stop id first and by key second. Both steps merge on the map
    side, so a key with any number of reports leaves each task as one row per stop id, and
    the second, small exchange is the one the join with the schedule needs anyway. Reports
    without a status or stop id count; of several stop ids the smallest is kept.
    """
    stopped = F.when(F.col("status") == fixed.STOPPED_AT, F.col("ts"))
    moving = F.when(F.col("status") == fixed.IN_TRANSIT_TO, F.col("ts"))
    return observations.groupBy(*keys).agg(
        F.min(stopped).alias("first_stopped"),
        F.max(stopped).alias("last_stopped"),
        F.max(moving).alias("last_approach"),
        (F.count(moving) > 0).alias("in_transit_seen"),
        F.count_distinct("stop_id").alias("distinct_stop_ids"),
        F.min("stop_id").alias("reported_stop_id"))
