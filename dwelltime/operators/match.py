"""Joins what happened to what was promised."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from dwelltime.operators.observe import STOP_KEYS
from dwelltime.schemas import ARRIVALS

# Where the time of a row came from.
ORIGIN_DEPARTURE, STOPPED, APPROACH, NONE = "origin_departure", "stopped_at", "approach", "none"


def _evidence() -> Column:
    """Origins are timed by their last stopped report, others by the first, else by the last approach."""
    origin = F.col("is_origin")
    return (F.when(origin & F.col("last_stopped").isNotNull(), ORIGIN_DEPARTURE)
            .when(~origin & F.col("first_stopped").isNotNull(), STOPPED)
            .when(~origin & F.col("last_approach").isNotNull(), APPROACH)
            .otherwise(NONE))


def _seen_at(source: Column) -> Column:
    return (F.when(source == ORIGIN_DEPARTURE, F.col("last_stopped"))
            .when(source == STOPPED, F.col("first_stopped"))
            .when(source == APPROACH, F.col("last_approach")))


def with_reports(scheduled: DataFrame, observed: DataFrame, keys: Sequence[str] = STOP_KEYS) -> DataFrame:
    """Every scheduled stop with what was reported there, if anything."""
    return scheduled.join(observed, list(keys), "left")


def timed(joined: DataFrame) -> DataFrame:
    """Actual time, delay and where they came from, for stops joined with their reports.

    An origin's delay is against its departure, while its scheduled_time is the arrival. The
    last two columns are for checking and are not stored.
    """
    source = F.col("source")
    due = F.when(F.col("is_origin"), F.col("scheduled_departure")).otherwise(F.col("scheduled_arrival"))
    seen = joined.withColumn("source", _evidence()).withColumn("seen_at", _seen_at(source))
    return seen.select(
        "service_date", "agency", "line", "route_id", "direction_id", "trip_id", "stop_id",
        "stop_sequence",
        F.timestamp_seconds("scheduled_arrival").alias("scheduled_time"),
        F.timestamp_seconds("seen_at").alias("actual_time"),
        (F.col("seen_at") - due).cast("int").alias("delay_seconds"),
        "source",
        F.coalesce("in_transit_seen", F.lit(False)).alias("in_transit_seen"),
        "is_origin", "is_terminus", "reported_stop_id", "distinct_stop_ids")


def match_arrivals(scheduled: DataFrame, observed: DataFrame,
                   keys: Sequence[str] = STOP_KEYS) -> DataFrame:
    """One row per scheduled stop, seen or not."""
    return timed(with_reports(scheduled, observed, keys))


def stored_columns(arrivals: DataFrame) -> DataFrame:
    return arrivals.select(*ARRIVALS.names)


def unmatched_observations(observed: DataFrame, scheduled: DataFrame,
                           keys: Sequence[str] = STOP_KEYS) -> DataFrame:
    """Observed stops the schedule does not know."""
    return observed.join(scheduled.select(*keys), list(keys), "left_anti")
