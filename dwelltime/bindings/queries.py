"""Every operator as a named query over the star schema.

Days come out as text and instants as epoch seconds, so that other engines can be compared
without agreeing on date types.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from dwelltime.bindings import star
from dwelltime.fixed_values import GTFS_COLUMNS
from dwelltime.functions import clock, text
from dwelltime.operators import (documents, grains, labels, match, monitoring, quality, schedule,
                                 services, versions)
from dwelltime.plans import summarise, tallies
from dwelltime.sinks import site, sizes
from dwelltime.sinks.arrivals_table import write_arrivals
from dwelltime.sources import measured, positions, timetables
from dwelltime.streaming import alarms, landing, record
from dwelltime.workspace import fresh_path, materialise

Query = Callable[[SparkSession, str], DataFrame]
NETWORK = star.NETWORK
ZONE = NETWORK.zone


def plain(frame: DataFrame) -> DataFrame:
    """Dates as text, timestamps as epoch seconds."""
    def shown(field):
        kind = field.dataType.typeName()
        if kind == "date":
            return F.col(field.name).cast("string").alias(field.name)
        if kind == "timestamp":
            return F.unix_seconds(field.name).alias(field.name)
        return F.col(field.name)

    return frame.select(*[shown(field) for field in frame.schema.fields])


def _round6(frame: DataFrame, *names: str) -> DataFrame:
    return frame.withColumns({name: F.round(name, 6) for name in names})


# Matching -----------------------------------------------------------------------------

def observed_stops(spark, sf_dir):
    return plain(star.observed(spark, sf_dir))


def scheduled_flags(spark, sf_dir):
    return plain(star.scheduled(spark, sf_dir))


def scheduled_timetable(spark, sf_dir):
    """Timetable text to scheduled stops: exceptions, weekly pattern, trip ends, clocks past 24."""
    running = services.running_services(
        star.calendar(spark, sf_dir), star.calendar_dates(spark, sf_dir), star.CALENDAR_DAYS)
    return plain(schedule.scheduled_stops(
        star.gtfs_stop_times(spark, sf_dir), star.gtfs_trips(spark, sf_dir), running, NETWORK))


def arrivals(spark, sf_dir):
    return plain(star.arrivals(spark, sf_dir))


def unmatched_observations(spark, sf_dir):
    """Observed stops against a schedule that lost every trip's last stop."""
    known = star.scheduled(spark, sf_dir).where(~F.col("is_terminus"))
    return plain(match.unmatched_observations(star.observed(spark, sf_dir), known))


# Grains -------------------------------------------------------------------------------

def headlines(spark, sf_dir):
    return grains.headlines(star.view(spark, sf_dir))


def hour_of_week_profile(spark, sf_dir):
    return grains.profiles(star.view(spark, sf_dir))


def stop_totals(spark, sf_dir):
    return grains.stop_totals(star.view(spark, sf_dir))


def stop_dayparts(spark, sf_dir):
    return grains.stop_cells(star.view(spark, sf_dir))


def direction_totals(spark, sf_dir):
    return grains.direction_totals(grains.stop_totals(star.view(spark, sf_dir)))


def site_totals(spark, sf_dir):
    return grains.site_totals(star.view(spark, sf_dir))


def day_span(spark, sf_dir):
    return plain(grains.day_span(star.view(spark, sf_dir)))


# Quality ------------------------------------------------------------------------------

def _report_counts(spark, sf_dir, keys=quality.DAY) -> DataFrame:
    """Counted in one scan of the arrivals, then written."""
    return materialise(quality.report_counts(star.arrivals(spark, sf_dir), keys), "counts")


def _report(spark, sf_dir, counts: DataFrame) -> DataFrame:
    return quality.with_ratios(quality.report_of(counts), quality.observation_check(
        star.observed(spark, sf_dir), star.scheduled(spark, sf_dir)))


def daily_report(spark, sf_dir):
    report = _report(spark, sf_dir, _report_counts(spark, sf_dir))
    return plain(_round6(report, *quality.LEVELS, "join_rate", "stop_id_match",
                         "coverage", "stopped_pct", "median_delay_min", "absurd_pct", "early_pct"))


def agency_report(spark, sf_dir):
    """The report per feed over all days."""
    return _round6(quality.report_of(_report_counts(spark, sf_dir, ["agency"]), ["agency"]), *quality.LEVELS)


def observation_join_check(spark, sf_dir):
    known = star.scheduled(spark, sf_dir).where(~F.col("is_terminus"))
    return quality.observation_check(star.observed(spark, sf_dir), known, ["agency"])


def by_agency(spark, sf_dir):
    return plain(quality.by_agency(quality.line_counts(star.arrivals(spark, sf_dir))))


def silent_lines(spark, sf_dir):
    return plain(quality.silent_lines(quality.line_counts(star.arrivals(spark, sf_dir))))


def biggest_silent_lines(spark, sf_dir):
    return plain(quality.biggest_silent(
        quality.silent_lines(quality.line_counts(star.arrivals(spark, sf_dir)))))


def _quality(spark, sf_dir) -> dict[str, DataFrame]:
    """Report, feed counts, silent lines and checks over one written table of counts."""
    counts = _report_counts(spark, sf_dir)
    counted = quality.line_counts_of(counts)
    report = materialise(_report(spark, sf_dir, counts), "report")
    agencies, silent = quality.by_agency(counted), quality.silent_lines(counted)
    return {"report": report, "agencies": agencies, "silent": silent,
            "checks": quality.quality_checks(report, agencies, silent)}


def quality_checks(spark, sf_dir):
    return plain(_round6(_quality(spark, sf_dir)["checks"].drop("label"), "value"))


def quality_verdicts(spark, sf_dir):
    return plain(quality.verdicts(_quality(spark, sf_dir)["checks"]))


def report_text(spark, sf_dir):
    found = _quality(spark, sf_dir)
    return plain(quality.report_text(
        found["report"], found["agencies"], found["checks"], found["silent"]))


# Labels -------------------------------------------------------------------------------

def line_labels(spark, sf_dir):
    return labels.line_labels(star.routes(spark, sf_dir), NETWORK)


def stop_names(spark, sf_dir):
    return labels.stop_names(star.gtfs_stops(spark, sf_dir), NETWORK)


def direction_names(spark, sf_dir):
    return labels.direction_names(
        star.gtfs_stop_times(spark, sf_dir), star.gtfs_trips(spark, sf_dir), NETWORK)


# Timetable versions -------------------------------------------------------------------

def active_services(spark, sf_dir):
    return plain(services.running_services(
        star.calendar(spark, sf_dir), star.calendar_dates(spark, sf_dir), star.CALENDAR_DAYS))


def contradicting_exceptions(spark, sf_dir):
    return plain(services.contradicting_exceptions(
        star.calendar(spark, sf_dir), star.calendar_dates(spark, sf_dir), star.CALENDAR_DAYS))


def _chosen(spark, sf_dir):
    weekly = star.version_calendar(spark, sf_dir)
    running = services.running_services(weekly, star.no_exceptions(weekly), star.VERSION_DAYS)
    return versions.choose_versions(star.timetable_versions(spark, sf_dir), running, ZONE)


def version_as_of(spark, sf_dir):
    return plain(_chosen(spark, sf_dir))


def passed_over_versions(spark, sf_dir):
    return plain(versions.passed_over(
        star.timetable_versions(spark, sf_dir), _chosen(spark, sf_dir), ZONE).drop("fetched_at"))


def passed_over_counts(spark, sf_dir):
    return plain(versions.passed_over_counts(star.timetable_versions(spark, sf_dir), _chosen(spark, sf_dir), ZONE))


def missing_version_days(spark, sf_dir):
    days = F.explode(F.array(*[F.lit(day) for day in star.VERSION_DAYS])).alias("service_date")
    wanted = star.timetable_versions(spark, sf_dir).select("feed").distinct().select("feed", days)
    return plain(versions.missing_days(wanted, _chosen(spark, sf_dir)))


def coverage_warnings(spark, sf_dir):
    return plain(versions.coverage_warnings(
        _chosen(spark, sf_dir), star.feed_info(spark, sf_dir)).drop("fetched_at"))


def newest_version(spark, sf_dir):
    return plain(versions.newest_etags(star.timetable_versions(spark, sf_dir)))


def changed_versions(spark, sf_dir):
    """Events as offered timetables, against the newest of the saved ones."""
    offered = star.table(spark, sf_dir, "events").select(
        star._event_feed().alias("feed"), F.col("event_id").cast("string").alias("offer"),
        text.clean_etag(F.concat(F.lit('W/"'), F.get_json_object("props", "$.k"), F.lit('" '))).alias("source_etag"),
        F.col("ts").cast("date").alias("day"))
    changed = versions.changed_versions(offered, star.timetable_versions(spark, sf_dir))
    return changed.select("feed", "offer", "source_etag", versions.version_name(
        F.col("feed"), F.col("day"), F.col("source_etag")).alias("version"))


def line_drift(spark, sf_dir):
    """Lines of part routes against lines named by supplier nations."""
    published = versions.published_lines(star.routes(spark, sf_dir))
    recorded = star.table(spark, sf_dir, "supplier").select(
        star.feed_of(F.col("s_suppkey")).alias("feed"), F.col("s_nationkey").cast("string").alias("line"))
    return versions.line_drift(published, recorded, ["feed"])


# Monitoring ---------------------------------------------------------------------------

def _hourly_feeds(spark, sf_dir):
    return monitoring.interval_tally(star.feed_records(spark, sf_dir), F.col("received_at"), "1 hour")


def feed_tally(spark, sf_dir):
    return plain(monitoring.interval_tally(
        star.feed_records(spark, sf_dir), F.col("received_at"), "5 minutes"))


def stalled_feeds(spark, sf_dir):
    return plain(monitoring.stalled_feeds(_hourly_feeds(spark, sf_dir), star.FEED_AGENCIES))


# Scalars ------------------------------------------------------------------------------

def natural_order(spark, sf_dir):
    """Distinct lines with their place in natural order."""
    from pyspark.sql import Window

    lines = star.routes(spark, sf_dir).select(
        "feed", text.line_code(F.col("route_id")).alias("line")).distinct()
    order = Window.partitionBy("feed").orderBy(*text.natural_order(F.col("line")))
    return lines.select("feed", "line", F.row_number().over(order).alias("place"))


def gtfs_clock(spark, sf_dir):
    times = star.gtfs_stop_times(spark, sf_dir)
    return times.select(
        "trip_id", "stop_sequence", "stop_id", clock.gtfs_seconds(F.col("arrival_time")).alias("arrives"),
        clock.gtfs_seconds(F.col("departure_time")).alias("departs"))


def json_path(spark, sf_dir):
    return star.table(spark, sf_dir, "events").select(
        "event_id", F.get_json_object("props", "$.k").try_cast("int").alias("k"))


def clock_functions(spark, sf_dir):
    """Each event's instant as local parts, its service day in both spellings, and the day's base."""
    moments = star.table(spark, sf_dir, "events").select(
        "event_id", F.unix_seconds(star._instant("ts")).alias("epoch"),
        F.col("ts").cast("date").alias("day"), star._instant("ts").alias("moment"))
    wall = clock.local_wall(F.col("epoch"), ZONE)
    compact = clock.compact_date(F.col("day"))
    window = clock.day_window(F.col("day"), ZONE)
    return plain(moments.select(
        "event_id", "epoch", clock.day_of_week(wall).alias("dow"), F.hour(wall).alias("hr"),
        clock.hour_of_week(wall).alias("how"), clock.daypart(wall).alias("bucket"),
        compact.alias("compact"), clock.service_date(compact).alias("from_compact"),
        clock.service_date(F.col("day").cast("string")).alias("from_dashed"),
        window["starts"].alias("base"), window["ends"].alias("day_ends"),
        clock.iso_stamp(F.col("moment")).alias("stamp"),
        F.unix_micros(clock.iso_instant(clock.iso_stamp(F.col("moment")))).alias("micros"),
        clock.utc_day(F.col("moment")).alias("dt"), clock.utc_hour(F.col("moment")).alias("hh")))


def clock_changes(spark, sf_dir):
    """Instants and days of two years in a zone that changes its clocks, both change days of each among them."""
    key = F.col("event_id")
    moments = star.table(spark, sf_dir, "events").select(
        key, (F.lit(1678000000) + key * 28813 % 63072000).alias("epoch"),
        F.date_add(F.lit(date(2023, 3, 1)), (key % 730).cast("int")).alias("service_date"))
    wall = clock.local_wall(F.col("epoch"), star.CHANGING_ZONE)
    window = clock.day_window(F.col("service_date"), star.CHANGING_ZONE)
    return plain(moments.select(
        "event_id", "epoch", clock.day_of_week(wall).alias("dow"), F.hour(wall).alias("hr"),
        clock.hour_of_week(wall).alias("how"), clock.daypart(wall).alias("bucket"), "service_date",
        window["starts"].alias("base"), window["ends"].alias("day_ends")))


def local_profile(spark, sf_dir):
    """Hour-of-week profile of the arrivals, moved 28 years on, in a zone that changes its clocks."""
    later = star.arrivals(spark, sf_dir).withColumn(
        "scheduled_time", F.timestamp_seconds(F.unix_seconds("scheduled_time") + 883612800))
    return grains.profiles(grains.rider_view(later, star.CHANGING_ZONE))


def text_functions(spark, sf_dir):
    """Tags, archive names and fallbacks made from each event."""
    events = star.table(spark, sf_dir, "events")
    tag = F.concat(F.when(F.col("event_id") % 2 == 0, 'W/').otherwise(""), F.lit('"'), F.col("event_type"),
                   F.lit('" '))
    stamp = F.concat(clock.compact_date(F.col("ts").cast("date")), F.lit("T"),
                     F.lpad(F.hour("ts").cast("string"), 2, "0"), F.lit("0000Z"))
    name = F.concat(F.when(F.col("event_id") % 5 == 0, "vehicles-").otherwise("vehicle_positions-"),
                    stamp, F.lit(".jsonl.gz"))
    return plain(events.select(
        "event_id", text.clean_etag(tag).alias("etag"), text.archive_day(name).alias("dt"),
        text.archive_hour(name).alias("hh"),
        text.either(F.when(F.col("event_id") % 3 == 0, "").otherwise(F.concat(F.lit(" "), "event_type")),
                    F.lit("none")).alias("label"),
        F.array_join(F.array("event_type", F.col("user_id").cast("string")), ",").alias("codes")))


# Documents ----------------------------------------------------------------------------

def _counted(spark, sf_dir) -> DataFrame:
    """The histogram of the whole view, counted in one scan."""
    return summarise.counted_view(star.view(spark, sf_dir))


def _span(spark, sf_dir) -> documents.Span:
    return documents.Span.lazily(grains.day_span(star.view(spark, sf_dir)))


def _documents(spark, sf_dir):
    """The days are counted in the histogram's pass: the span needs no other one."""
    counts, days = summarise.counted_days(star.view(spark, sf_dir))
    profile = materialise(grains.profiles_of(counts), "profile")
    names = {
        "lines": labels.line_labels(star.routes(spark, sf_dir), NETWORK),
        "stops": labels.stop_names(star.gtfs_stops(spark, sf_dir), NETWORK),
        "directions": labels.direction_names(
            star.gtfs_stop_times(spark, sf_dir), star.gtfs_trips(spark, sf_dir), NETWORK),
    }
    stops = materialise(documents.stop_entries(
        grains.stop_totals_of(counts), grains.stop_cells_of(counts), names["stops"]), "stops")
    directions = materialise(
        documents.direction_entries(profile, stops, names["directions"]), "directions")
    return counts, profile, names, stops, directions, documents.Span.lazily(grains.day_span(days))


def site_stops(spark, sf_dir):
    """One JSON object per line, direction and stop."""
    counts = _counted(spark, sf_dir)
    named = labels.stop_names(star.gtfs_stops(spark, sf_dir), NETWORK)
    return documents.stop_entries(grains.stop_totals_of(counts), grains.stop_cells_of(counts), named)


def site_line_parts(spark, sf_dir):
    """The ordered parts of every line's document."""
    _, profile, names, stops, directions, span = _documents(spark, sf_dir)
    return documents.line_parts(profile, stops, directions, names, span)


def site_index(spark, sf_dir):
    counts, profile, names, _, directions, span = _documents(spark, sf_dir)
    entries = documents.index_entries(grains.headlines_of(counts), profile, directions, names)
    return documents.index_document(entries, span)


def site_index_parts(spark, sf_dir):
    """The ordered parts of the index."""
    counts, profile, names, _, directions, span = _documents(spark, sf_dir)
    entries = documents.index_entries(grains.headlines_of(counts), profile, directions, names)
    return documents.index_parts(entries, span)


def site_status(spark, sf_dir):
    return documents.status_document(grains.site_totals(star.view(spark, sf_dir)), _span(spark, sf_dir))


def site_file_sizes(spark, sf_dir):
    """Writes the line files and weighs them, one row per line."""
    _, profile, names, stops, directions, span = _documents(spark, sf_dir)
    path = fresh_path(spark, "lines")
    site.write_lines(documents.line_parts(profile, stops, directions, names, span), path)
    return sizes.document_sizes(spark, path)


# Sources and sinks --------------------------------------------------------------------

def _archive(spark, sf_dir) -> str:
    """Observations as a gzipped JSON archive, in files opened at the start of each UTC day."""
    path = fresh_path(spark, "archive")
    vehicle = F.struct(
        F.struct(clock.compact_date(F.col("service_date")).alias("startDate"),
                 F.col("trip_id").alias("tripId")).alias("trip"),
        F.col("status").alias("currentStatus"), F.col("stop_sequence").alias("currentStopSequence"),
        F.col("stop_id").alias("stopId"), F.col("ts").cast("string").alias("timestamp"))
    moment = F.timestamp_seconds("ts")
    raw = star.observations(spark, sf_dir).select(
        moment.alias("received_at"), "agency",
        F.to_json(F.struct(vehicle.alias("vehicle"))).alias("payload"))
    (landing.enveloped(raw).withColumn("hh", F.lit("00")).hint("rebalance", "dt").write.option("compression", "gzip")
     .partitionBy("dt", "hh").text(path))
    return path


def position_scan(spark, sf_dir):
    """The archive written, then read back as typed observations."""
    return plain(positions.observations(positions.read_positions(spark, _archive(spark, sf_dir))))


def _damaged_archive(spark, sf_dir) -> str:
    """Events as archive lines, by UTC day: some no JSON, some with a sequence, time or day that is none."""
    key = F.col("event_id") % 9
    moment = star._instant("ts")
    trip = F.struct(F.when(key == 4, "2024-13-45").otherwise(clock.compact_date(F.col("ts").cast("date"))).alias("startDate"),
                    F.col("user_id").cast("string").alias("tripId"))
    vehicle = F.struct(
        trip.alias("trip"), F.lit("STOPPED_AT").alias("currentStatus"),
        F.when(key == 2, "four").otherwise((F.col("event_id") % 40).cast("string")).alias("currentStopSequence"),
        F.col("event_type").alias("stopId"),
        F.when(key == 3, "soon").otherwise(F.unix_seconds(moment).cast("string")).alias("timestamp"))
    payload = F.to_json(F.struct(vehicle.alias("vehicle")))
    raw = star.table(spark, sf_dir, "events").select(
        moment.alias("received_at"), F.col("event_type").alias("agency"),
        F.when(key == 1, F.concat(F.lit("{"), payload)).otherwise(payload).alias("payload"))
    path = fresh_path(spark, "archive")
    (landing.enveloped(raw).withColumn("hh", F.lit("00")).hint("rebalance", "dt")
     .write.option("compression", "gzip").partitionBy("dt", "hh").text(path))
    return path


def position_quarantine(spark, sf_dir):
    """What of a damaged archive cannot be read, counted by day and reason."""
    records = positions.read_positions(spark, _damaged_archive(spark, sf_dir), keep_corrupt=True)
    return plain(positions.quarantine(records).groupBy("dt", "reason").agg(F.count(F.lit(1)).alias("records")))


def file_tally(spark, sf_dir):
    """Records per feed over all files of the archive; lines that are no JSON name none."""
    tally = positions.file_tally(positions.read_positions(spark, _damaged_archive(spark, sf_dir)))
    return tally.groupBy("agency").agg(F.sum("records").alias("records"), F.bool_and(
        F.col("file_name").endswith(".gz")).alias("archive_files"))


def archive_pruning(spark, sf_dir):
    """Records of two service days, read from the UTC days next to them only."""
    days = [date(2024, 1, 9), date(2024, 1, 20)]
    records = positions.read_positions(spark, _damaged_archive(spark, sf_dir), days)
    seen = positions.observations(records, days).join(records.select("dt").distinct().agg(
        F.count(F.lit(1)).alias("partitions")))
    return plain(seen.groupBy("service_date", "partitions").agg(
        F.count(F.lit(1)).alias("records"), F.sum("stop_sequence").alias("sequences")))


def prefiltered_records(spark, sf_dir):
    """Records and unreadable lines of two service days by reason; lines of other days are never parsed."""
    days = [date(2024, 1, 9), date(2024, 1, 20)]
    records = positions.read_day_records(spark, _damaged_archive(spark, sf_dir), days)
    good = positions.observations(records, days).groupBy("service_date").agg(
        F.count(F.lit(1)).alias("records"), F.sum("stop_sequence").alias("sequences"))
    bad = positions.quarantine(records).groupBy("reason").agg(F.count(F.lit(1)).alias("records"))
    return plain(good.select("service_date", F.lit("read").alias("kind"), "records", "sequences").unionByName(bad.select(
        F.lit(None).cast("date").alias("service_date"), F.col("reason").alias("kind"), "records",
        F.lit(None).cast("bigint").alias("sequences"))))


def listed_versions(spark, sf_dir):
    """Events as saves of some two hundred versions a feed; the newest save of each is listed."""
    saves = star.table(spark, sf_dir, "events").select(
        star._event_feed().alias("feed"), F.concat(F.lit("v"), F.col("event_id") % 401).alias("version"),
        F.get_json_object("props", "$.k").alias("source_etag"), F.col("event_type").alias("source_url"),
        F.when(F.col("event_id") % 3 != 0, star._instant("ts")).alias("fetched_at"),
        star._instant("ts").alias("updated_at"), F.concat_ws(",", "event_type", F.col("user_id").cast("string")).alias("route_codes"),
        F.col("event_id").cast("string").alias("path"))
    return plain(timetables.listed_versions(saves))


def largest_document(spark, sf_dir):
    """Writes the line files; how many, how large, and the largest."""
    _, profile, names, stops, directions, span = _documents(spark, sf_dir)
    path = fresh_path(spark, "lines")
    site.write_lines(documents.line_parts(profile, stops, directions, names, span), path)
    return sizes.largest_document(sizes.document_sizes(spark, path))


def stored_arrivals(spark, sf_dir):
    """Written by service day and read back."""
    path = fresh_path(spark, "arrivals")
    write_arrivals(star.arrivals(spark, sf_dir), path)
    return plain(measured.read_arrivals(spark, path))


def partition_overwrite(spark, sf_dir):
    """The table written, then the rail days of odd years written again: those days are replaced."""
    path = fresh_path(spark, "arrivals")
    whole = materialise(star.arrivals(spark, sf_dir), "matched")
    write_arrivals(whole, path)
    write_arrivals(whole.where((F.year("service_date") % 2 == 1) & (F.col("agency") == "RAIL")), path)
    return plain(measured.read_arrivals(spark, path).groupBy("service_date", "agency").agg(
        F.count(F.lit(1)).alias("rows")))


def incremental_summary(spark, sf_dir):
    """Months as days: all but the newest are measured and counted, the newest joins, an old one is measured anew
    with fewer rows and put right again. The total is brought up to date each time and read at three grains."""
    path, kept = fresh_path(spark, "arrivals"), fresh_path(spark, "tallies")
    month = materialise(star.arrivals(spark, sf_dir).withColumn(
        "service_date", F.trunc("service_date", "MM")), "months")
    first, last = month.agg(F.min("service_date"), F.max("service_date")).first()
    for rows in (month.where(F.col("service_date") < F.lit(last)), month.where(F.col("service_date") == F.lit(last)),
                 month.where((F.col("service_date") == F.lit(first)) & (F.col("agency") == "RAIL")),
                 month.where(F.col("service_date") == F.lit(first))):
        write_arrivals(rows, path)
        counts = tallies.refresh(spark, path, kept, NETWORK)
    grain = lambda name, frame: frame.select(F.lit(name).alias("grain"), "agency", "line", *[
        (F.col(key) if key in frame.columns else F.lit(None)).cast("string").alias(key)
        for key in ("direction_id", "how", "stop_id", "bucket")], "scheduled", "measured", "med", "p90", "pct5")
    return grain("line", grains.headlines_of(counts)).unionByName(
        grain("hour", grains.profiles_of(counts))).unionByName(grain("stop", grains.stop_cells_of(counts)))


def zip_members(spark, sf_dir):
    """Routes packed into timetable zips, a batch of rows each, and expanded again."""
    import io
    import zipfile

    import pandas as pd

    members = dict(GTFS_COLUMNS)

    def pack(batches):
        for batch in batches:
            for (feed, first), rows in batch.groupby(["feed", "bundle"]):
                buffer = io.BytesIO()
                with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as bundle:
                    for member, columns in members.items():
                        held = rows[columns[::-1]] if member == "routes" else pd.DataFrame(columns=columns)
                        bundle.writestr(f"{member}.txt", "﻿" + held.to_csv(index=False))
                    bundle.writestr("shapes.txt", "shape_id\n1\n")
                yield pd.DataFrame({"feed": [feed], "version": [f"{feed}-{first}"],
                                    "content": [buffer.getvalue()]})

    routes = star.routes(spark, sf_dir).withColumn(
        "bundle", F.floor(F.split_part("route_id", F.lit("-"), F.lit(2)).cast("bigint") / 500))
    zips = routes.mapInPandas(pack, "feed string, version string, content binary")
    return timetables.member(timetables.expand_zips(zips), "routes").drop("version")


# Streams ------------------------------------------------------------------------------

def _spool(spark, sf_dir) -> str:
    """Feed records as spool files of one day each."""
    path = fresh_path(spark, "spool")
    records = star.feed_records(spark, sf_dir)
    lines = landing.enveloped(records.select("received_at", "agency", F.col("props").alias("payload")))
    (lines.select("value", F.col("dt").alias("day")).hint("rebalance", "day")
     .write.option("compression", "gzip").partitionBy("day").text(path))
    return path


def landing_stream(spark, sf_dir):
    """Spool files streamed into the archive layout, then counted per partition and feed."""
    archive, checkpoint = fresh_path(spark, "archive"), fresh_path(spark, "landing")
    raw = spark.readStream.format("text").option("pathGlobFilter", "*.gz").load(_spool(spark, sf_dir))
    stamped = raw.select("value", landing.received_at(F.col("value")).alias("received_at"))
    placed = stamped.select(
        "value", clock.utc_day(F.col("received_at")).alias("dt"),
        F.lpad(clock.utc_hour(F.col("received_at")).cast("string"), 2, "0").alias("hh"))
    landing.start_landing(placed, archive, checkpoint, once=True).awaitTermination()
    landed = positions.read_positions(spark, archive, committed_only=True)
    return plain(landed.groupBy("dt", "hh", "agency").agg(F.count(F.lit(1)).alias("records")))


def _streamed_messages(spark, spool):
    raw = spark.readStream.format("text").option("pathGlobFilter", "*.gz").load(spool)
    return landing.messages(raw)


def _received(spark, spool):
    return landing.messages(spark.read.option("pathGlobFilter", "*.gz").text(spool))


def feed_tally_stream(spark, sf_dir):
    """Five-minute windows of the streamed records: those the stream closed, then those left open at its end."""
    out, checkpoint = fresh_path(spark, "tally"), fresh_path(spark, "tally-state")
    spool = _spool(spark, sf_dir)
    tallies = alarms.feed_tally(_streamed_messages(spark, spool), "5 minutes", "10 minutes")
    (tallies.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
     .outputMode("append").trigger(availableNow=True).start().awaitTermination())
    closed = spark.read.schema("interval timestamp, agency string, records long").parquet(out)
    left = alarms.open_records(_received(spark, spool), closed, "5 minutes")
    return plain(closed.unionByName(monitoring.interval_tally(left, F.col("received_at"), "5 minutes")))


def stalled_feeds_stream(spark, sf_dir):
    """Alarms over hourly windows: those of the stream's state, then those of the windows left open at its end."""
    out, checkpoint = fresh_path(spark, "silence"), fresh_path(spark, "silence-state")
    spool = _spool(spark, sf_dir)
    grid = alarms.feed_grid(_streamed_messages(spark, spool), star.FEED_AGENCIES, "1 hour", "10 minutes")
    alarms.start_silence(grid, out, checkpoint, once=True).awaitTermination()
    told = spark.read.schema(alarms.SILENCE).parquet(out)
    left = alarms.open_records(_received(spark, spool), told, "1 hour")
    tally = monitoring.interval_tally(left, F.col("received_at"), "1 hour")
    return plain(alarms.alarms_of(told).unionByName(monitoring.stalled_feeds(
        tally, star.FEED_AGENCIES, carried=monitoring.counters(told))))


def _recorded(spark, sf_dir, files_a_batch: int) -> str:
    """The record job over the spool of single days, several days a batch, newest file first, some lines damaged."""
    spool, out = fresh_path(spark, "spool"), fresh_path(spark, "recorded")
    records = star.feed_records(spark, sf_dir)
    lines = landing.enveloped(records.select("received_at", "agency", F.col("props").alias("payload"))).select(
        "value", F.date_add(F.lit(date(2024, 2, 28)), -F.dayofyear("dt")).alias("day"))
    damaged = F.when(F.get_json_object("value", "$.payload.k") == "7", F.concat(F.lit("{"), "value")).otherwise(
        F.when(F.get_json_object("value", "$.payload.k") == "8", F.replace("value", F.lit('"agency"'), F.lit('"nobody"')))
        .otherwise(F.col("value")))
    (lines.select(damaged.alias("value"), "day").hint("rebalance", "day")
     .write.option("compression", "gzip").partitionBy("day").text(spool))
    raw = (spark.readStream.format("text").option("pathGlobFilter", "*.gz").option("maxFilesPerTrigger", files_a_batch)
           .load(spool).select("value", F.col("_metadata.file_name").alias("file_name")))
    record.start_record(raw, out, fresh_path(spark, "record-state"), star.FEED_AGENCIES, once=True).awaitTermination()
    return out


def late_records(spark, sf_dir):
    """The streamed tally, records that came after their interval was closed among them, and the unreadable lines."""
    out = _recorded(spark, sf_dir, 6)
    bad = record.unreadable(spark, out).groupBy("reason").agg(F.count(F.lit(1)).alias("records"))
    return plain(record.tally(spark, out)).unionByName(bad.select(
        F.lit(None).cast("bigint").alias("interval"), F.col("reason").alias("agency"), "records"))


def recorded_archive(spark, sf_dir):
    """What the record job archived, read by the archive's reader and counted by partition and feed."""
    out = _recorded(spark, sf_dir, 12)
    landed = positions.read_positions(spark, f"{out}/archive")
    return plain(landed.groupBy("dt", "hh", "agency").agg(F.count(F.lit(1)).alias("records")))


QUERIES: dict[str, Query] = {
    query.__name__: query for query in (
        observed_stops, scheduled_flags, scheduled_timetable, arrivals, unmatched_observations,
        headlines, hour_of_week_profile, stop_totals, stop_dayparts, direction_totals, site_totals,
        day_span, daily_report, agency_report, observation_join_check, by_agency, silent_lines,
        biggest_silent_lines, quality_checks, quality_verdicts, report_text, line_labels, stop_names,
        direction_names, active_services, contradicting_exceptions, version_as_of,
        passed_over_versions, passed_over_counts, missing_version_days, coverage_warnings, newest_version,
        changed_versions, line_drift, feed_tally, stalled_feeds, natural_order, gtfs_clock, json_path,
        clock_functions, clock_changes, local_profile, text_functions, site_stops, site_line_parts, site_index, site_index_parts, site_status,
        site_file_sizes, position_scan, stored_arrivals, partition_overwrite, zip_members,
        incremental_summary, position_quarantine, file_tally, archive_pruning, prefiltered_records, listed_versions, largest_document,
        landing_stream, feed_tally_stream, stalled_feeds_stream, late_records, recorded_archive)
}
