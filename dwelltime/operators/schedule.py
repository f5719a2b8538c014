"""Every stop every running trip was scheduled to make."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from dwelltime.functions import clock, text
from dwelltime.network import Network
from dwelltime.schemas import SCHEDULED

TRIP = ["feed", "version", "trip_id"]


def trip_ends(stop_times: DataFrame, keys: list[str] = TRIP) -> DataFrame:
    """First and last stop sequence of each trip.

    A grouping rather than a window: it merges on the map side, and it runs once per
    timetable version instead of once per service day.
    """
    return stop_times.groupBy(*keys).agg(
        F.min("stop_sequence").alias("first_sequence"), F.max("stop_sequence").alias("last_sequence"))


def flag_ends(stops: DataFrame, ends: DataFrame, keys: list[str] = TRIP) -> DataFrame:
    """Marks a trip's origin and terminus rows."""
    return (stops.join(ends, keys)
            .withColumn("is_origin", F.col("stop_sequence") == F.col("first_sequence"))
            .withColumn("is_terminus", F.col("stop_sequence") == F.col("last_sequence"))
            .drop("first_sequence", "last_sequence"))


def running_trips(trips: DataFrame, running: DataFrame) -> DataFrame:
    """Trips of each service day. Inner, since the day comes from the running services."""
    return trips.join(running, ["feed", "version", "service_id"]).select(
        *TRIP, "service_date", "route_id", F.col("direction_id").try_cast("int").alias("direction_id"))


def scheduled_stops(stop_times: DataFrame, trips: DataFrame, running: DataFrame,
                    network: Network) -> DataFrame:
    """One row per service day, trip and stop, both feeds together.

    `running` holds the services of the chosen versions only. A service's days are one value,
    so trips pass both joins as one row each; days are spread once a stop has its trip.
    """
    stops = stop_times.select(
        *TRIP, "stop_id", F.col("stop_sequence").try_cast("int").alias("stop_sequence"),
        clock.gtfs_seconds(F.col("arrival_time")).alias("arrives"),
        clock.gtfs_seconds(F.col("departure_time")).alias("departs"))
    ends = trip_ends(stop_times.select(
        *TRIP, F.col("stop_sequence").try_cast("int").alias("stop_sequence")))
    base = clock.day_base(F.col("service_date"), network.zone)
    service = ["feed", "version", "service_id"]
    days = running.groupBy(*service).agg(
        F.collect_list(F.struct("service_date", base.alias("base"))).alias("days"))
    own = trips.select(
        *TRIP, "service_id", "route_id", network.agency_of(F.col("feed")).alias("agency"),
        text.line_code(F.col("route_id")).alias("line"),
        F.col("direction_id").try_cast("int").alias("direction_id")).join(days, service).drop("service_id")
    spread = flag_ends(stops, own.join(ends, TRIP)).select(
        "agency", "line", "route_id", "direction_id", "trip_id", "stop_id", "stop_sequence",
        "arrives", "departs", "is_origin", "is_terminus", F.inline("days"))
    return spread.withColumns({
        "scheduled_arrival": F.col("base") + F.col("arrives"),
        "scheduled_departure": F.col("base") + F.col("departs")}).select(*SCHEDULED.names)
