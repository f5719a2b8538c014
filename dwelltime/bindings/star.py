"""Reads the star schema in transit roles.

An order is a trip, its lines are the trip's stops, a supplier is a stop, an order priority
such as `1-URGENT` is a route id. Lines not returned are position reports. Events are feed
records and timetable versions, customers and orders are a service calendar and its
exceptions, parts are routes.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from dwelltime.fixed_values import WEEKDAY_COLUMNS
from dwelltime.network import Network
from dwelltime.operators import grains, match, observe, schedule
from dwelltime.schemas import SCHEDULED

NETWORK = Network(zone="UTC", feeds={"bus": "BUS", "rail": "RAIL"}, rail_agencies=("RAIL",))
CHANGING_ZONE = "America/Los_Angeles"
FEED_AGENCIES = [f"{kind}-{n}" for kind in ("click", "error", "purchase", "signup", "view") for n in range(10)]


def day_list(first: date, last: date) -> list[date]:
    return [first + timedelta(days=n) for n in range((last - first).days + 1)]


# The days the calendars are asked about.
CALENDAR_DAYS = day_list(date(1995, 1, 1), date(2001, 12, 31))
VERSION_DAYS = day_list(date(2023, 12, 28), date(2024, 2, 15))


# Read with their schemas given, which spares each query a pass over file footers.
SCHEMAS = {
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
                "l_returnflag string, l_linestatus string",
    "orders": "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, props string",
    "customer": "c_custkey long",
    "supplier": "s_suppkey long, s_name string, s_nationkey int",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def agency_of(key: Column) -> Column:
    return F.when(key % 10 == 0, "RAIL").otherwise("BUS")


def feed_of(key: Column) -> Column:
    return F.when(key % 10 == 0, "rail").otherwise("bus")


def _trips(spark, sf_dir) -> DataFrame:
    """Orders as trips, with the instant their first stop is counted from."""
    key = F.col("o_orderkey")
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").select(
        key.alias("trip"), day.alias("service_date"), agency_of(key).alias("agency"),
        F.split_part("o_orderpriority", F.lit("-"), F.lit(1)).alias("line"),
        F.col("o_orderpriority").alias("route_id"), (key % 2).cast("int").alias("direction_id"),
        (F.unix_date(day).cast("bigint") * 86400 + 21600 + (key % 1000) * 60).alias("day0"))


def _stop_offset() -> Column:
    return F.col("l_linenumber").cast("bigint") * 600


def _stops(spark, sf_dir) -> DataFrame:
    """One row per trip and stop sequence. Lines are grouped before they meet their orders."""
    return (table(spark, sf_dir, "lineitem")
            .groupBy(F.col("l_orderkey").alias("trip"), F.col("l_linenumber").alias("stop_sequence"))
            .agg(F.min("l_suppkey").cast("string").alias("stop_id")))


def _due(stops: DataFrame, spark, sf_dir) -> DataFrame:
    """Stops with their trip's attributes, scheduled instants and end flags."""
    ends = schedule.trip_ends(table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("trip"), F.col("l_linenumber").alias("stop_sequence")), ["trip"])
    due = F.col("day0") + F.col("stop_sequence").cast("bigint") * 600
    return (schedule.flag_ends(stops, ends.join(_trips(spark, sf_dir), "trip"), ["trip"])
            .withColumns({"trip_id": F.col("trip").cast("string"), "scheduled_arrival": due,
                          "scheduled_departure": due + 30}))


def scheduled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _due(_stops(spark, sf_dir), spark, sf_dir).select(*SCHEDULED.names)


def _reports(spark, sf_dir) -> DataFrame:
    """Lines as position reports, timed from their trip's first instant."""
    return table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") != "R").select(
        F.col("l_orderkey").alias("trip"), F.col("l_linenumber").alias("stop_sequence"),
        F.when(F.col("l_linestatus") == "F", "STOPPED_AT").otherwise("IN_TRANSIT_TO").alias("status"),
        F.col("l_suppkey").alias("stop_id"),
        (_stop_offset() + F.col("l_partkey") % 1500 - 300).alias("ts"))


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Position reports, one per line."""
    return _reports(spark, sf_dir).join(_trips(spark, sf_dir), "trip").select(
        "service_date", "agency", F.col("trip").cast("string").alias("trip_id"), "status",
        "stop_sequence", F.col("stop_id").cast("string").alias("stop_id"),
        (F.col("day0") + F.col("ts")).alias("ts"))


_INSTANTS = ["first_stopped", "last_stopped", "last_approach"]


def _collapsed(spark, sf_dir) -> DataFrame:
    """Reports collapsed per trip and stop sequence, in times relative to the trip.

    A trip's offset is the same for all its reports, so first and last can be taken before
    the orders give trips their day; that join then sees one row per stop however many
    reports a trip has.
    """
    return observe.observed_stops(_reports(spark, sf_dir), ["trip", "stop_sequence"]).withColumn(
        "reported_stop_id", F.col("reported_stop_id").cast("string"))


def _absolute(relative: DataFrame) -> DataFrame:
    return relative.withColumns({name: F.col("day0") + F.col(name) for name in _INSTANTS})


def observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = _absolute(_collapsed(spark, sf_dir).join(_trips(spark, sf_dir), "trip"))
    return dated.select(
        "service_date", "agency", F.col("trip").cast("string").alias("trip_id"), "stop_sequence",
        *_INSTANTS, "in_transit_seen", "distinct_stop_ids", "reported_stop_id")


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stops joined with their reports on the keys both were just grouped by, then given a day.

    Neither side moves again for that join, and the orders are joined once.
    """
    joined = match.with_reports(
        _stops(spark, sf_dir), _collapsed(spark, sf_dir), ["trip", "stop_sequence"])
    return match.timed(_absolute(_due(joined, spark, sf_dir)))


def view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grains.rider_view(arrivals(spark, sf_dir), NETWORK.zone)


def _bit(key: Column, n: int) -> Column:
    return (F.floor(key / (1 << n)) % 2).cast("string")


def _compact(day: Column) -> Column:
    return F.replace(day.cast("string"), F.lit("-"), F.lit(""))


def _version(key: Column) -> Column:
    return F.concat(feed_of(key), F.lit("-"), (key % 3).cast("string"))


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer is a service with a range of 5 to 9 days and a weekly pattern."""
    key = F.col("c_custkey")
    starts = F.date_add(F.lit(date(1995, 1, 1)), (key * 37 % 2300).cast("int"))
    return table(spark, sf_dir, "customer").select(
        feed_of(key).alias("feed"), _version(key).alias("version"), key.cast("string").alias("service_id"),
        _compact(starts).alias("start_date"),
        _compact(F.date_add(starts, (4 + key % 5).cast("int"))).alias("end_date"),
        *[_bit(key, n).alias(name) for n, name in enumerate(WEEKDAY_COLUMNS)])


def calendar_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order is an exception of its customer's service: 1 adds, 2 removes, 3 means nothing."""
    key = F.col("o_custkey")
    return table(spark, sf_dir, "orders").select(
        feed_of(key).alias("feed"), _version(key).alias("version"), key.cast("string").alias("service_id"),
        _compact(F.col("o_orderdate").cast("date")).alias("date"),
        (1 + F.col("o_orderkey") % 3).cast("string").alias("exception_type"))


def _clock(seconds: Column) -> Column:
    """`HH:MM:SS` text, hours not wrapped at 24."""
    two = lambda n: F.lpad(n.cast("string"), 2, "0")
    return F.concat_ws(":", two(F.floor(seconds / 3600)), two(F.floor(seconds / 60) % 60), two(seconds % 60))


def gtfs_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order as a timetable trip of its customer's service."""
    key, service = F.col("o_orderkey"), F.col("o_custkey")
    return table(spark, sf_dir, "orders").select(
        feed_of(service).alias("feed"), _version(service).alias("version"),
        key.cast("string").alias("trip_id"), F.col("o_orderpriority").alias("route_id"),
        service.cast("string").alias("service_id"), (key % 2).cast("string").alias("direction_id"))


def gtfs_stop_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as timetable stops, all text; clocks run past 24:00:00."""
    key = F.col("l_orderkey")
    arrives = 21600 + key % 1000 * 65 + _stop_offset()
    lines = table(spark, sf_dir, "lineitem").select(
        key.cast("string").alias("trip_id"), F.col("l_suppkey").cast("string").alias("stop_id"),
        F.col("l_linenumber").cast("string").alias("stop_sequence"),
        _clock(arrives).alias("arrival_time"), _clock(arrives + 30).alias("departure_time"),
        F.when(F.col("l_linenumber") == 7, "").otherwise(
            F.concat("l_returnflag", "l_linestatus")).alias("destination_code"))
    own = gtfs_trips(spark, sf_dir).select("trip_id", "feed", "version")
    return lines.join(own, "trip_id")


def routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A part is a route row of the line its size names."""
    key = F.col("p_partkey")
    size = F.col("p_size").cast("string")
    return table(spark, sf_dir, "part").select(
        feed_of(key).alias("feed"), F.lit("v1").alias("version"),
        F.concat(size, F.lit("-"), key.cast("string")).alias("route_id"),
        F.when(key % 3 == 0, "").otherwise(F.concat(F.lit(" "), size, F.lit("/"), "p_brand")).alias("route_short_name"),
        F.when(key % 4 != 0, F.concat(F.lit("Metro "), "p_name", F.lit(" "))).alias("route_long_name"),
        F.concat(F.upper("p_name"), F.lit(" - DOWNTOWN LA  VIA "), "p_type", F.lit("-"),
                 F.upper("p_brand"), F.lit(" 10TH USC'S")).alias("route_desc"),
        F.lit("3").alias("route_type"))


def gtfs_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A supplier is a stop; every ninth has no readable place."""
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        feed_of(key).alias("feed"), F.lit("v1").alias("version"), key.cast("string").alias("stop_id"),
        F.when(key % 7 == 0, "").otherwise(F.concat("s_name", F.lit(" "))).alias("stop_name"),
        F.when(key % 9 == 0, "n/a").otherwise(
            F.concat(F.lit(" "), F.col("s_nationkey").cast("string"), F.lit(".5"))).alias("stop_lat"),
        F.concat(F.lit(" -118."), (key % 10).cast("string")).alias("stop_lon"))


def _event_feed() -> Column:
    return F.when(F.col("user_id") % 2 == 0, "bus").otherwise("rail")


def _instant(column: str) -> Column:
    """The table's zoneless UTC timestamps as instants, whatever the session zone."""
    wall = F.col(column).cast("timestamp_ntz")
    whole = F.unix_date(wall.cast("date")).cast("bigint") * 86400 + F.hour(wall) * 3600 + F.minute(wall) * 60
    micros = whole * 1_000_000 + (F.extract(F.lit("SECOND"), wall) * 1_000_000).cast("bigint")
    return F.timestamp_micros(micros)


def timetable_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An event is a saved timetable version."""
    return table(spark, sf_dir, "events").select(
        _event_feed().alias("feed"), F.col("event_id").cast("string").alias("version"),
        F.get_json_object("props", "$.k").alias("source_etag"),
        _instant("ts").alias("fetched_at"), _instant("ts").alias("updated_at"))


def version_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each version's one service: eleven days from two before the save; every fourth lists none."""
    key = F.col("event_id")
    day = F.col("ts").cast("date")
    return table(spark, sf_dir, "events").select(
        _event_feed().alias("feed"), key.cast("string").alias("version"), F.lit("daily").alias("service_id"),
        _compact(F.date_sub(day, 2)).alias("start_date"), _compact(F.date_add(day, 8)).alias("end_date"),
        *[F.when(key % 4 == 0, "0").otherwise(_bit(key, n)).alias(name)
          for n, name in enumerate(WEEKDAY_COLUMNS)])


def no_exceptions(like: DataFrame) -> DataFrame:
    return like.where(F.lit(False)).select(
        "feed", "version", "service_id", F.lit("").alias("date"), F.lit("").alias("exception_type"))


def feed_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The window a version claims; every third says nothing."""
    day = F.col("ts").cast("date")
    key = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        _event_feed().alias("feed"), key.cast("string").alias("version"),
        _compact(day).alias("feed_start_date"),
        F.when(key % 3 != 0, _compact(F.date_add(day, 5))).otherwise("").alias("feed_end_date"))


def feed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as records received from one of fifty feeds, ten a kind of event."""
    return table(spark, sf_dir, "events").select(
        _instant("ts").alias("received_at"),
        F.concat_ws("-", "event_type", (F.col("user_id") % 10).cast("string")).alias("agency"), "props")
