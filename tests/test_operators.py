import random
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from frames import rows
from dwelltime import fixed_values as fixed
from dwelltime.network import LOS_ANGELES
from dwelltime.operators import (documents, grains, labels, match, monitoring, observe, quality, schedule,
                                 services, versions)
from dwelltime.plans import summarise
from dwelltime.schemas import HISTOGRAM, OBSERVATIONS, SCHEDULED

DAY = date(2026, 8, 18)
FLAGS = ", ".join(f"{d} string" for d in fixed.WEEKDAY_COLUMNS)
CALENDAR = f"feed string, version string, service_id string, start_date string, end_date string, {FLAGS}"
DATES = "feed string, version string, service_id string, date string, exception_type string"
EVERY, NEVER, TUESDAYS = ("1",) * 7, ("0",) * 7, ("0", "1", "0", "0", "0", "0", "0")


@pytest.fixture
def calendar(frame):
    return frame([
        ("gtfs_bus", "v1", "daily", "20260801", "20260831", *EVERY),
        ("gtfs_bus", "v1", "tue", "20260801", "20260831", *TUESDAYS),
        ("gtfs_bus", "v1", "school", "20260801", "20260831", *EVERY),
        ("gtfs_bus", "v1", "over", "20260801", "20260817", *EVERY),
        ("gtfs_bus", "v1", "extra", "20260801", "20260831", *NEVER),
    ], CALENDAR)


@pytest.fixture
def exceptions(frame):
    return frame([
        ("gtfs_bus", "v1", "school", "20260818", "2"), ("gtfs_bus", "v1", "extra", "20260818", "1"),
        ("gtfs_bus", "v1", "both", "20260818", "1"), ("gtfs_bus", "v1", "both", "20260818", "2"),
        ("gtfs_bus", "v1", "extra", "20260930", "1"), ("gtfs_bus", "v1", "daily", "2026081x", "2"),
    ], DATES)


def test_running_services(calendar, exceptions):
    found = rows(services.running_services(calendar, exceptions, [DAY]), "service_id")
    assert found == [("daily",), ("extra",), ("tue",)]


def test_running_services_of_scattered_days(calendar, exceptions):
    days = [date(2026, 8, 17), date(2026, 8, 25), date(2026, 9, 30)]
    found = rows(services.running_services(calendar, exceptions, days), "service_date", "service_id")
    assert found == [
        (days[0], "daily"), (days[0], "over"), (days[0], "school"),
        (days[1], "daily"), (days[1], "school"), (days[1], "tue"), (days[2], "extra")]


def test_contradicting_exceptions(calendar, exceptions):
    assert rows(services.contradicting_exceptions(calendar, exceptions, [DAY]), "service_id") == [("both",)]


def _at(day, hour=12):
    return datetime(2026, 8, day, hour, tzinfo=timezone.utc)


def _versions(frame, listed):
    return frame([("gtfs_bus", name, stamp) for name, stamp in listed],
                 "feed string, version string, fetched_at timestamp")


def _running(frame, names, day=DAY):
    return frame([("gtfs_bus", name, day, "s") for name in names],
                 "feed string, version string, service_date date, service_id string")


@pytest.mark.parametrize("serving, chosen, in_force", [
    (["v16", "v17", "v18", "v19"], "v17", True),      # v18 came at noon of the day itself
    (["v16", "v18", "v19"], "v16", True),             # v17 lists no service
    (["v18", "v19"], "v18", False),                   # nothing earlier survives: nearest later
])
def test_choose_versions(frame, serving, chosen, in_force):
    listed = _versions(frame, [(f"v{d}", _at(d)) for d in (16, 17, 18, 19)])
    out = versions.choose_versions(listed, _running(frame, serving), "America/Los_Angeles").first()
    assert (out.version, out.in_force, out.service_date) == (chosen, in_force, DAY)


def test_passed_over_versions(frame):
    listed = _versions(frame, [(f"v{d}", _at(d)) for d in (15, 16, 17, 18, 19)])
    first = versions.choose_versions(listed, _running(frame, ["v15", "v19"]), "America/Los_Angeles")
    assert rows(versions.passed_over(listed, first, "America/Los_Angeles"), "version") == [("v16",), ("v17",)]
    later = versions.choose_versions(listed, _running(frame, ["v19"]), "America/Los_Angeles")
    assert rows(versions.passed_over(listed, later, "America/Los_Angeles"), "version") == [
        ("v15",), ("v16",), ("v17",), ("v18",)]


def test_newest_and_changed_versions(frame):
    saved = frame([
        ("bus", "bus-1", "aaa", _at(1)), ("bus", "bus-2", "bbb", _at(2)), ("rail", "rail-1", "", _at(3)),
    ], "feed string, version string, source_etag string, updated_at timestamp")
    assert rows(versions.newest_etags(saved), "feed", "source_etag") == [("bus", "bbb"), ("rail", "")]
    offered = frame([("bus", "bbb"), ("bus", "aaa"), ("rail", "")], "feed string, source_etag string")
    # A tag seen before but since replaced is a change; a missing tag proves nothing.
    changed = versions.changed_versions(offered, saved)
    assert rows(changed, "feed", "source_etag") == [("bus", "aaa"), ("rail", "")]


def test_coverage_warnings(frame):
    chosen = frame([("b", DAY, "v1"), ("b", DAY, "v2"), ("b", DAY, "v3")], "feed string, service_date date, version string")
    info = frame([("b", "v1", "20260801", "20260831"), ("b", "v2", "20260901", "20260930"), ("b", "v3", "20260801", None)],
                 "feed string, version string, feed_start_date string, feed_end_date string")
    assert rows(versions.coverage_warnings(chosen, info), "version", "covers") == [("v1", True), ("v2", False), ("v3", None)]


def test_line_drift_and_recorded_lines(spark, frame):
    recorded = versions.recorded_lines(spark)
    assert recorded.count() == 120 and recorded.where("event_only").count() == 6
    published = recorded.where("line <> '720'").select("agency", "line").union(
        frame([("LACMTA", "999")], "agency string, line string"))
    assert rows(versions.line_drift(published, recorded, ["agency"])) == [
        ("LACMTA", "720", "gone"), ("LACMTA", "999", "added")]


@pytest.fixture
def timetable(frame):
    stop_times = frame([
        ("gtfs_bus", "v1", "t1", "s1", "1", "23:50:00", "23:55:00", "Santa Monica"),
        ("gtfs_bus", "v1", "t1", "s2", "2", "24:10:00", "24:10:00", "Santa Monica"),
        ("gtfs_bus", "v1", "t1", "s3", "3", "25:30:00", "25:30:00", " Westwood"),
        ("gtfs_bus", "v1", "t2", "s1", "1", "08:00:00", "08:00:00", ""),
        ("gtfs_rail", "r1", "t1", "s1", "1", "08:00:00", "08:00:00", None),
        ("gtfs_rail", "r1", "t1", "s9", "7", "08:20:00", "08:21:00", "Azusa"),
    ], "feed string, version string, trip_id string, stop_id string, stop_sequence string, "
       "arrival_time string, departure_time string, destination_code string")
    trips = frame([
        ("gtfs_bus", "v1", "t1", "720-13201", "daily", "0"), ("gtfs_bus", "v1", "t2", "720-13201", "school", "0"),
        ("gtfs_rail", "r1", "t1", "801", "rail", "1"),
    ], "feed string, version string, trip_id string, route_id string, service_id string, direction_id string")
    running = frame([("gtfs_bus", "v1", DAY, "daily"), ("gtfs_rail", "r1", DAY, "rail"),
                     ("gtfs_rail", "r1", date(2026, 8, 19), "rail")],
                    "feed string, version string, service_date date, service_id string")
    return stop_times, trips, running


def test_stops_meet_trips_before_days_are_spread(timetable):
    plan = schedule.scheduled_stops(*timetable, LOS_ANGELES)._jdf.queryExecution().optimizedPlan().toString()
    nodes = [line.strip(" :+-").split()[0] for line in plan.splitlines()]
    assert "Generate" in nodes and nodes.index("Generate") < nodes.index("Join")


def test_scheduled_stops(timetable):
    due = schedule.scheduled_stops(*timetable, LOS_ANGELES)
    assert due.schema.names == SCHEDULED.names
    assert [f.dataType for f in due.schema] == [f.dataType for f in SCHEDULED]
    base = 1787036400
    got = rows(due.where(F.col("service_date") == DAY), "agency", "line", "direction_id", "trip_id", "stop_sequence",
               "scheduled_arrival", "scheduled_departure", "is_origin", "is_terminus")
    assert got == [
        ("LACMTA", "720", 0, "t1", 1, base + 85800, base + 86100, True, False),
        ("LACMTA", "720", 0, "t1", 2, base + 87000, base + 87000, False, False),
        ("LACMTA", "720", 0, "t1", 3, base + 91800, base + 91800, False, True),
        ("LACMTA_Rail", "801", 1, "t1", 1, base + 28800, base + 28800, True, False),
        ("LACMTA_Rail", "801", 1, "t1", 7, base + 30000, base + 30060, False, True)]
    assert due.where(F.col("service_date") == date(2026, 8, 19)).count() == 2


def test_labels(frame, timetable):
    stop_times, trips, _ = timetable
    assert rows(labels.direction_names(stop_times, trips, LOS_ANGELES)) == [
        ("LACMTA", "720", 0, "Santa Monica"), ("LACMTA_Rail", "801", 1, "Azusa")]
    routes = frame([
        ("gtfs_bus", "v1", "10-2", "10/48", None, "MELROSE VIA LA"), ("gtfs_bus", "v1", "10-1", "10", "", None),
        ("gtfs_bus", "v1", "22-1", None, None, "Dodger Stadium"), ("gtfs_rail", "r1", "801", "", "Metro A Line ", "X")],
        "feed string, version string, route_id string, route_short_name string, route_long_name string, route_desc string")
    assert rows(labels.line_labels(routes, LOS_ANGELES)) == [
        ("LACMTA", "10", "10", "", "bus"), ("LACMTA", "22", "22", "Dodger Stadium", "bus"),
        ("LACMTA_Rail", "801", "Metro A Line", "", "rail")]
    stops = frame([
        ("gtfs_bus", "v1", "s1", "Main / 1st ", " 34.05", "-118.2"), ("gtfs_bus", "v1", "s2", None, "34", "-118"),
        ("gtfs_bus", "v1", "s3", "Nowhere", "", "-118"), ("gtfs_rail", "r1", "s1", "Union", "34.1", "-118.3")],
        "feed string, version string, stop_id string, stop_name string, stop_lat string, stop_lon string")
    assert rows(labels.stop_names(stops, LOS_ANGELES)) == [
        ("LACMTA", "s1", "Main / 1st", 34.05, -118.2), ("LACMTA", "s2", "s2", 34.0, -118.0),
        ("LACMTA_Rail", "s1", "Union", 34.1, -118.3)]


def _obs(frame, reports):
    return frame([(DAY, "A", trip, status, seq, stop, ts) for trip, status, seq, stop, ts in reports], OBSERVATIONS)


def test_observed_stops(frame):
    observed = observe.observed_stops(_obs(frame, [
        ("t", "STOPPED_AT", 1, "a", 100), ("t", "STOPPED_AT", 1, "a", 160), ("t", "IN_TRANSIT_TO", 1, "a", 90),
        ("t", "STOPPED_AT", 2, "c", 300), ("t", "STOPPED_AT", 2, "b", 310), ("t", None, 3, None, 400)]))
    assert rows(observed.drop("service_date", "agency")) == [
        ("t", 1, 100, 160, 90, True, 1, "a"), ("t", 2, 300, 310, None, False, 2, "b"),
        ("t", 3, None, None, None, False, 0, None)]


@pytest.fixture
def matched(frame):
    due = lambda seq, arrival, origin=False, end=False, agency="A": (
        DAY, agency, "7", "7-1", 0, "t", f"s{seq}", seq, arrival, arrival + 30, origin, end)
    scheduled = frame([due(1, 1000, origin=True), due(2, 2000), due(3, 3000), due(4, 4000), due(5, 5000, end=True),
                       due(1, 1000, origin=True, agency="B")], SCHEDULED)
    observed = observe.observed_stops(_obs(frame, [
        ("t", "STOPPED_AT", 1, "s1", 400), ("t", "STOPPED_AT", 1, "s1", 1100),   # layover, then departure
        ("t", "STOPPED_AT", 2, "s2", 2060), ("t", "STOPPED_AT", 2, "s2", 2090),  # dwell
        ("t", "IN_TRANSIT_TO", 2, "s2", 2095),
        ("t", "IN_TRANSIT_TO", 3, "x3", 2950), ("t", "IN_TRANSIT_TO", 3, "s3", 2990),
        ("t", "IN_TRANSIT_TO", 5, "s5", 5400), ("t", "STOPPED_AT", 9, "s9", 1)]))
    return scheduled, observed, match.match_arrivals(scheduled, observed)


def test_match_arrivals(matched):
    scheduled, observed, arrivals = matched
    assert rows(arrivals, "agency", "stop_sequence", "delay_seconds", "source", "in_transit_seen") == [
        ("A", 1, 70, "origin_departure", False), ("A", 2, 60, "stopped_at", True), ("A", 3, -10, "approach", True),
        ("A", 4, None, "none", False), ("A", 5, 400, "approach", True), ("B", 1, None, "none", False)]
    # An origin's scheduled time stays the arrival though its delay is against the departure.
    first = arrivals.where("agency = 'A' AND stop_sequence = 1").select(
        F.unix_seconds("scheduled_time"), F.unix_seconds("actual_time")).first()
    assert tuple(first) == (1000, 1100)
    assert arrivals.count() == scheduled.count()
    assert arrivals.where("(source = 'none') <> (delay_seconds IS NULL)").isEmpty()
    assert rows(match.unmatched_observations(observed, scheduled), "stop_sequence") == [(9,)]


def test_origin_never_uses_the_approach(frame):
    scheduled = frame([(DAY, "A", "7", "7-1", 0, "t", "s", 1, 10, 20, True, False)], SCHEDULED)
    out = match.match_arrivals(scheduled, observe.observed_stops(_obs(frame, [("t", "IN_TRANSIT_TO", 1, "s", 5)])))
    assert rows(out, "source", "delay_seconds", "actual_time", "in_transit_seen") == [("none", None, None, True)]


def test_quality(matched):
    scheduled, observed, arrivals = matched
    report = quality.with_ratios(quality.daily_report(arrivals), quality.observation_check(observed, scheduled))
    row = report.first()
    assert (row.scheduled_stops, row.measured, row.stopped, row.approached, row.terminus_approach) == (6, 4, 1, 2, 1)
    assert (row.observations, row.joined, row.stop_match, row.ambiguous) == (5, 4, 4, 1)
    assert (row.median_delay, row.trips, row.lines, row.join_rate) == (60.0, 1, 1, 80.0)
    counted = quality.line_counts(arrivals)
    silent = quality.silent_lines(counted)
    assert rows(silent, "agency", "line", "scheduled_stops") == [("B", "7", 1)]
    agencies = quality.by_agency(counted)
    assert rows(agencies, "agency", "lines", "scheduled_stops", "measured") == [("A", 1, 5, 4), ("B", 1, 1, 0)]
    checks = quality.quality_checks(report, agencies, silent)
    failed = {r.check for r in checks.where("NOT ok").collect()}
    assert failed == {"join_rate", "stopped_pct", "ambiguous", "silent"}
    assert not quality.verdicts(checks).first().ok
    lines = [r.text for r in quality.report_text(report, agencies, checks, silent).orderBy("section", "item").collect()]
    assert "scheduled_stops=6 measured=4 stopped=1 approached=2 terminus_approach=1 lines=1 trips=1" in lines
    assert any(line.startswith("median_delay=60 p75=") for line in lines)
    assert "OUTSIDE 99.9..100.0 80.00" in lines and "B 7 scheduled_stops=1" in lines


def test_report_without_any_delay(matched):
    _, observed, arrivals = matched
    nothing = arrivals.where("delay_seconds IS NULL")
    empty = observed.where("false")
    row = quality.with_ratios(quality.daily_report(nothing), quality.observation_check(empty, nothing)).first()
    assert (row.coverage, row.join_rate, row.median_delay, row.median_delay_min) == (0.0, 0.0, None, 0.0)


def test_silence_counts_only_delivering_intervals(frame):
    at = lambda n: datetime(2026, 8, 18, 0, 5 * n, tzinfo=timezone.utc)
    tallies = frame([(at(0), "bus", 5), (at(0), "rail", 1), (at(1), "bus", 4), (at(3), "bus", 4), (at(4), "bus", 4),
                     (at(5), "bus", 1), (at(5), "rail", 1)], "interval timestamp, agency string, records long")
    stalled = monitoring.stalled_feeds(tallies, ["bus", "rail"])
    assert rows(stalled.select("agency", F.minute("interval"), "silent")) == [("rail", 20, 3)]
    # Carried counters continue where an earlier stretch ended.
    late = tallies.where(F.minute("interval") >= 15)
    carried = frame([("rail", 1), ("bus", 0)], "agency string, silent int")
    assert rows(monitoring.stalled_feeds(late, ["bus", "rail"], carried=carried).select(
        "agency", F.minute("interval"), "silent")) == [("rail", 20, 3)]


def test_silence_over_many_days_equals_counting_one_by_one(frame):
    rng, feeds, start = random.Random(6), ["a", "b", "c"], datetime(2026, 8, 17, 22, 0, tzinfo=timezone.utc)
    given, expected, silent = [], [], {"a": 2, "b": 0, "c": 0}
    for n in range(400):  # ten-minute intervals over three days, c quiet for more than one of them
        at = start + timedelta(minutes=10 * n)
        held = {f: rng.randrange(1, 9) for f in feeds if rng.random() < {"a": 0.5, "b": 0.9, "c": 0.02}[f]}
        given += [(at, f, r) for f, r in held.items()]
        if held:
            for f in feeds:
                silent[f] = 0 if f in held else silent[f] + 1
                expected.append((at.replace(tzinfo=None), f, held.get(f, 0), silent[f]))
    found = monitoring.silence(frame(given, "interval timestamp, agency string, records long"), feeds,
                               frame([("a", 2)], "agency string, silent int"))
    assert max(e[3] for e in expected) > 60
    assert rows(found.select(F.unix_seconds("interval"), "agency", "records", "silent")) == sorted(
        [(int(at.replace(tzinfo=timezone.utc).timestamp()), *rest) for at, *rest in expected],
        key=lambda row: tuple((True, str(v)) for v in row))


def test_no_window_holds_a_feeds_whole_history(frame):
    at = datetime(2026, 8, 18, tzinfo=timezone.utc)
    found = monitoring.silence(frame([(at, "a", 1)], "interval timestamp, agency string, records long"), ["a", "b"])
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # Rows are windowed by feed and day; only a day's sums by feed alone.
    windows = [line for line in plan.splitlines() if "Window [" in line and "records" in line]
    assert all("segment" in line.split("], [")[1] for line in windows)


@pytest.mark.parametrize("seed", range(3))
def test_passed_over_equals_comparing_every_pair(frame, seed):
    rng, zone = random.Random(seed), "America/Los_Angeles"
    at = {f"v{n:02d}": _at(rng.randrange(12, 22), rng.choice([3, 7, 7, 15])) for n in range(24)}
    manifest, expected = _versions(frame, list(at.items())), []
    days = [date(2026, 8, d) for d in range(11, 24)]
    running = [_running(frame, [v for v in at if rng.random() < 0.2], day) for day in days]
    whole = running[0]
    for more in running[1:]:
        whole = whole.unionByName(more)
    chosen = versions.choose_versions(manifest, whole, zone)
    for row in chosen.collect():
        starts = datetime.combine(row.service_date, datetime.min.time(), timezone.utc) + timedelta(hours=7)
        # In force at the start, newest first, then the nearest later one; equal times by name.
        better = lambda v: (at[v] > starts, abs(starts - at[v]), v)
        expected += [(row.service_date, v) for v in at if better(v) < better(row.version)]
    assert rows(versions.passed_over(manifest, chosen, zone), "service_date", "version") == sorted(expected)
    counts = {r.service_date: r.passed_over for r in versions.passed_over_counts(manifest, chosen, zone).collect()}
    assert expected and counts == {r.service_date: sum(d == r.service_date for d, _ in expected) for r in chosen.collect()}


def test_documents_nest_and_keep_thin_stops(spark, frame):
    import json

    columns = ("service_date date, agency string, line string, direction_id int, trip_id string, stop_id string, "
               "stop_sequence int, scheduled_time timestamp, delay_seconds int, is_origin boolean")
    when = datetime(2026, 8, 18, 15, 30, tzinfo=timezone.utc)  # Tuesday 08:30 local
    rows_in = [(DAY, "LACMTA", "2", 0, "t", stop, seq, when, delay, seq == 1) for stop, seq, delay in
               [("s1", 1, 900), ("s2", 2, 60), ("s2", 2, 400), ("s4", 4, None), ("s3", 3, 30)]]
    rows_in += [(DAY, "LACMTA", "2", 5, "u", "s9", 2, when, 10, False), (DAY, "LACMTA", "10", 1, "v", "s2", 2, when, 0, False),
                (DAY, "LACMTA", "30", 0, "w", "s2", 2, when, None, False)]
    view = grains.rider_view(frame(rows_in, columns), "America/Los_Angeles")
    names = {
        "lines": frame([("LACMTA", "2", 'The "2"', "Sunset", "bus")], "agency string, line string, label string, via string, mode string"),
        "stops": frame([("LACMTA", "s2", "Main", 34.0, -118.5)], "agency string, stop_id string, name string, lat double, lon double"),
        "directions": frame([("LACMTA", "2", 0, "Downtown")], "agency string, line string, direction_id int, to string"),
    }
    profile = grains.profiles(view)
    stops = documents.stop_entries(grains.stop_totals(view), grains.stop_cells(view), names["stops"])
    directions = documents.direction_entries(profile, stops, names["directions"])
    span = documents.Span.of(DAY, DAY, 1)
    parts = documents.line_parts(profile, stops, directions, names, span)
    texts = {}
    for row in parts.orderBy("agency", "line", *documents.PART_ORDER).collect():
        texts.setdefault(row.line, []).append(row.part)
    docs = {line: json.loads("\n".join(chunks)) for line, chunks in texts.items()}
    assert set(docs) == {"2", "10"}  # nothing was measured on line 30
    two = docs["2"]
    assert (two["label"], two["via"], two["days"], two["first_day"]) == ('The "2"', "Sunset", 1, "2026-08-18")
    (only,) = two["directions"]  # direction 5 is not shown
    assert (only["id"], only["n"], only["sched"], only["to"]) == (0, 3, 4, "Downtown")
    assert only["profile"] == [{"h": 32, "med": 60, "n": 3, "p90": 332, "pct5": 33.3, "sched": 4}]
    assert [s["id"] for s in only["stops"]] == ["s2", "s3", "s4"]
    assert only["stops"][0] == {
        "cells": [{"d": "wk-am", "med": 230, "n": 2, "p90": 366, "pct5": 50.0, "sched": 2}], "id": "s2", "lat": 34.0,
        "lon": -118.5, "n": 2, "name": "Main", "sched": 2, "seq": 2}
    assert only["stops"][2] == {"cells": [], "id": "s4", "lat": None, "lon": None, "n": 0, "name": "s4", "sched": 1, "seq": 4}
    assert docs["10"]["label"] == "10" and docs["10"]["mode"] == "bus"

    entries = documents.index_entries(grains.headlines(view), profile, directions, names)
    document = documents.index_document(entries, span).first().document
    index = json.loads(document)
    parts = lambda of: [r.part for r in documents.index_parts(of, span).orderBy(*documents.INDEX_ORDER).collect()]
    assert "".join(parts(entries)) == document and len(parts(entries)) == 4
    assert json.loads("".join(parts(entries.where("false"))))["lines"] == []
    plan = documents.index_parts(entries, span)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("collect_list") == 1  # a line's signs, at most two; never all lines
    assert [entry["line"] for entry in index["lines"]] == ["2", "10"]
    assert index["lines"][0]["to"] == ["Downtown"] and index["lines"][0]["n"] == 4
    status = json.loads(documents.status_document(grains.site_totals(view), span).first().document)
    assert status["scheduled_stops"] == 7 and status["measured_arrivals"] == 5 and status["coverage_pct"] == 71.4


def test_site_totals_of_nothing(frame):
    view = grains.rider_view(frame([], "agency string, line string, trip_id string, scheduled_time timestamp, "
                                       "delay_seconds int, is_origin boolean"), "UTC")
    row = grains.site_totals(view).first()
    assert (row.scheduled_stops, row.coverage_pct) == (0, None)


def test_days_are_counted_in_the_pass_of_the_histogram(spark):
    base = spark.range(40).selectExpr(
        "'A' AS agency", "'7' AS line", "0 AS direction_id", "CAST(id % 3 AS STRING) AS stop_id", "CAST(id % 9 AS INT) AS how",
        "'wk-am' AS bucket", "CAST(id % 4 AS INT) AS stop_sequence", "CAST(id AS STRING) AS trip_id",
        "IF(id % 5 = 0, NULL, CAST(id AS INT)) AS delay_seconds", "DATE_ADD(DATE'2026-08-18', CAST(id % 6 AS INT)) AS service_date")
    for view in (base, base.where("false")):
        counts, days = summarise.counted_days(view)
        assert rows(grains.day_span(days)) == rows(grains.day_span(view))
        assert rows(counts) == rows(grains.histogram(view))


def test_cells_of_a_stop_need_one_exchange(spark):
    counts = spark.createDataFrame([], HISTOGRAM)
    cells = grains.stop_cells_of(counts).groupBy(*grains.STOP).agg(F.collect_list("bucket"))
    assert cells._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
