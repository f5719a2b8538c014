"""Readable names of lines, directions and stops, from one chosen timetable per feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from dwelltime.functions import text
from dwelltime.network import Network


def of_versions(member: DataFrame, chosen: DataFrame) -> DataFrame:
    """A member's rows of the chosen versions only."""
    return member.join(chosen.select("feed", "version").distinct(), ["feed", "version"], "left_semi")


def line_labels(routes: DataFrame, network: Network) -> DataFrame:
    """Label, corridor and mode per line. Of several route rows, the smallest route_id speaks.

    Rail takes its long name and no corridor, all others their short name and description.
    """
    agency, rail = network.agency_of(F.col("feed")), network.is_rail(F.col("agency"))
    spoken = F.struct("route_id", "route_short_name", "route_long_name", "route_desc")
    one = (routes.select("*", agency.alias("agency"), text.line_code(F.col("route_id")).alias("line"))
           .groupBy("agency", "line").agg(F.min(spoken).alias("route")))
    return one.select(
        "agency", "line",
        F.when(rail, text.either(F.col("route.route_long_name"), F.col("line")))
        .otherwise(text.either(F.col("route.route_short_name"), F.col("line"))).alias("label"),
        F.when(rail, "").otherwise(
            text.readable(F.coalesce("route.route_desc", F.lit("")))).alias("via"),
        F.when(rail, "rail").otherwise("bus").alias("mode"))


def direction_names(stop_times: DataFrame, trips: DataFrame, network: Network) -> DataFrame:
    """The destination each line and direction is signed for most often, ties by name.

    Stops are counted per trip before they meet the trips, so the join carries a row per
    trip and destination instead of one per stop. All trips count, running or not.
    """
    trip = ["feed", "version", "trip_id"]
    signed = (stop_times.where(F.col("destination_code") != "")
              .groupBy(*trip, "destination_code").agg(F.count(F.lit(1)).alias("stops")))
    lined = trips.select(
        *trip, network.agency_of(F.col("feed")).alias("agency"),
        text.line_code(F.col("route_id")).alias("line"),
        F.col("direction_id").try_cast("int").alias("direction_id"))
    counted = (signed.join(lined, trip)
               .groupBy("agency", "line", "direction_id", "destination_code")
               .agg(F.sum("stops").alias("stops")))
    busiest = F.min_by("destination_code", F.struct(-F.col("stops"), F.col("destination_code")))
    return counted.groupBy("agency", "line", "direction_id").agg(
        text.strip(busiest).alias("to"))


def stop_names(stops: DataFrame, network: Network) -> DataFrame:
    """Name and place of each stop whose coordinates can be read."""
    return (stops.select(
        network.agency_of(F.col("feed")).alias("agency"), "stop_id",
        text.either(F.col("stop_name"), F.col("stop_id")).alias("name"),
        text.strip(F.col("stop_lat")).try_cast("double").alias("lat"),
        text.strip(F.col("stop_lon")).try_cast("double").alias("lon"))
        .where("lat IS NOT NULL AND lon IS NOT NULL")
        .groupBy("agency", "stop_id").agg(F.min(F.struct("name", "lat", "lon")).alias("stop"))
        .select("agency", "stop_id", "stop.*"))


def catalogue(members: dict[str, DataFrame], chosen: DataFrame, network: Network) -> dict[str, DataFrame]:
    """All three label tables for the chosen versions of both feeds."""
    held = {name: of_versions(members[name], chosen) for name in ("routes", "stop_times", "trips", "stops")}
    return {
        "lines": line_labels(held["routes"], network),
        "directions": direction_names(held["stop_times"], held["trips"], network),
        "stops": stop_names(held["stops"], network),
    }
