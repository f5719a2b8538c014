"""Raw archive and timetable zips in, arrivals and site out, through the real files."""

import gzip
import json
import zipfile
from datetime import date, datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from frames import rows
from dwelltime import workspace
from dwelltime.operators import grains, versions
from dwelltime.plans import intake, measure, summarise, tallies
from dwelltime.schemas import OBSERVATIONS, TALLIES
from dwelltime.sinks import day_table, site, sizes
from dwelltime.sinks.arrivals_table import write_arrivals
from dwelltime.sources import measured, positions, timetables

DAY, NEXT = date(2026, 8, 18), date(2026, 8, 19)
BASE = 1787036400  # local midnight of DAY
LINES = [("720-1", "bus"), ("2-1", "bus"), ("801", "rail")]


def _zip(path, members):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as bundle:
        for name, text in members.items():
            bundle.writestr(name, text)


def _members(feed, start="20260801", end="20260930"):
    week = "1,1,1,1,1,1,1"
    trips, times = [], []
    for route, kind in LINES:
        if kind != feed:
            continue
        for n in range(2):
            trip = f"{route}-{n}"
            trips.append(f"{route},daily,{trip},{n}")
            times += [f"{trip},{7 + n}:{10 * s:02d}:00,{7 + n}:{10 * s:02d}:30,s{s},{s},End {n}" for s in range(1, 5)]
    return {
        # Column order is free, and a byte order mark may lead.
        "calendar.txt": "﻿service_id,monday,tuesday,wednesday,thursday,friday,saturday,sunday,start_date,end_date\n"
                        f"daily,{week},{start},{end}\n",
        "trips.txt": "route_id,service_id,trip_id,direction_id\n" + "\n".join(trips) + "\n",
        "stop_times.txt": "trip_id,arrival_time,departure_time,stop_id,stop_sequence,destination_code\n" + "\n".join(times) + "\n",
        "stops.txt": "stop_id,stop_name,stop_lat,stop_lon\n" + "".join(f's{s},"Stop, {s}", 34.{s},-118.{s}\n' for s in range(1, 5)),
        "routes.txt": "route_id,route_short_name,route_long_name,route_desc,route_type\n" + "".join(
            f"{r},{r.split('-')[0] if k == 'bus' else ''},{'Metro A Line' if k == 'rail' else ''},DOWNTOWN LA,3\n"
            for r, k in LINES if k == feed),
        "shapes.txt": "unused\n",
    }


def _report(day, trip, agency, status, seq, stop, ts):
    vehicle = {"trip": {"startDate": f"{day:%Y%m%d}", "tripId": trip}, "currentStatus": status,
               "currentStopSequence": seq, "stopId": stop, "timestamp": str(ts), "bearing": 1.5}
    return ts, json.dumps({"received_at": datetime.fromtimestamp(ts, timezone.utc).isoformat().replace("+00:00", "Z"),
                           "agency": agency, "payload": {"vehicle": vehicle}})


@pytest.fixture(scope="module")
def world(tmp_path_factory, spark):
    """Two service days of reports, two saved versions per feed, the newer listing no service yet."""
    root = tmp_path_factory.mktemp("world")
    lines = []
    for n_day, day in enumerate((DAY, NEXT)):
        for route, kind in LINES:
            agency = "LACMTA" if kind == "bus" else "LACMTA_Rail"
            for n in range(2):
                for s in range(1, 5):
                    due = BASE + n_day * 86400 + (7 + n) * 3600 + s * 600
                    if (route, s) == ("2-1", 2):
                        continue  # never seen
                    status = "IN_TRANSIT_TO" if s == 4 else "STOPPED_AT"
                    lines.append(_report(day, f"{route}-{n}", agency, status, s, f"s{s}", due + 60 * s))
    evening = _report(DAY, "720-1-9", "LACMTA", "STOPPED_AT", 1, "s1", BASE + 86400)  # joins nothing
    lines += [evening, (BASE, "{broken"), _report(DAY, None, "LACMTA", "STOPPED_AT", 1, "s1", BASE)]
    archive = root / "raw" / "vehicle_positions"
    by_hour = {}
    for ts, line in lines:
        stamp = datetime.fromtimestamp(ts, timezone.utc)
        by_hour.setdefault(stamp.strftime("%Y%m%dT%H0000Z"), []).append(line)
    for stamp, held in by_hour.items():
        folder = archive / f"dt={stamp[:4]}-{stamp[4:6]}-{stamp[6:8]}" / f"hh={stamp[9:11]}"
        folder.mkdir(parents=True, exist_ok=True)
        with gzip.open(folder / f"vehicle_positions-{stamp}.jsonl.gz", "wt") as out:
            out.write("\n".join(held) + "\n")
    far = archive / "dt=2026-09-30" / "hh=00"
    far.mkdir(parents=True)
    (far / "vehicle_positions-20260930T000000Z.jsonl.gz").write_bytes(b"not gzip: must never be opened")

    offers = root / "offers"
    offers.mkdir()
    _zip(offers / "bus-a.zip", _members("bus"))
    _zip(offers / "rail-a.zip", _members("rail"))
    _zip(offers / "bus-b.zip", _members("bus", start="20260901"))
    schema = intake.OFFERED
    at = lambda day: datetime(2026, 8, day, 12, tzinfo=timezone.utc)
    manifest, landed = str(root / "manifest"), str(root / "landed")
    first = intake.take_in(spark, spark.createDataFrame([
        ("gtfs_bus", 'W/"aaaaaaaa11"', "u", at(16), str(offers / "bus-a.zip")),
        ("gtfs_rail", '"rrrrrrrr11"', "u", at(16), str(offers / "rail-a.zip"))], schema), manifest, landed)
    second = intake.take_in(spark, spark.createDataFrame([
        ("gtfs_bus", '"bbbbbbbb11"', "u", at(17), str(offers / "bus-b.zip")),
        ("gtfs_rail", '"rrrrrrrr11"', "u", at(17), str(offers / "rail-a.zip"))], schema), manifest, landed)
    return {"root": root, "raw": str(root / "raw"), "manifest": manifest, "landed": landed,
            "out": str(root / "arrivals"), "first": first, "second": second}


def test_intake_keeps_changed_versions_and_reports_drift(spark, world):
    assert rows(world["first"].saved, "version") == [
        ("gtfs_bus-2026-08-16-aaaaaaaa11",), ("gtfs_rail-2026-08-16-rrrrrrrr11",)]
    assert rows(world["second"].saved, "version") == [("gtfs_bus-2026-08-17-bbbbbbbb11",)]
    assert world["first"].saved.where("feed = 'gtfs_bus'").first().route_codes == "2,720"
    assert world["first"].drifted()
    gone = world["first"].drift
    assert gone.where("change = 'added'").isEmpty() and gone.where("agency = 'LACMTA'").count() == 112
    assert timetables.read_manifest(spark, world["manifest"]).count() == 3
    again = intake.take_in(spark, spark.createDataFrame(
        [("gtfs_bus", "bbbbbbbb11", "u", datetime(2026, 8, 18), "gone.zip")], intake.OFFERED), world["manifest"], world["landed"])
    assert again.saved.isEmpty() and not again.drifted()


def _offer(root, kind, folder, name, tag, day):
    (root / folder).mkdir(exist_ok=True)
    _zip(root / folder / name, _members(kind))
    return (f"gtfs_{kind}", tag, "u", datetime(2026, 8, day, 12, tzinfo=timezone.utc), str(root / folder / name))


def test_files_of_one_name_keep_their_feeds_apart(spark, tmp_path):
    offers = [_offer(tmp_path, "bus", "bus", "gtfs.zip", "b1", 16), _offer(tmp_path, "rail", "rail", "gtfs.zip", "r1", 16)]
    landed = str(tmp_path / "landed")
    intake.take_in(spark, spark.createDataFrame(offers, intake.OFFERED), str(tmp_path / "manifest"), landed)
    trips = timetables.read_landed(spark, landed)["trips"]
    assert rows(trips.select("feed", "route_id").distinct()) == [
        ("gtfs_bus", "2-1"), ("gtfs_bus", "720-1"), ("gtfs_rail", "801")]


def test_offers_of_one_call_are_taken_in_order(spark, tmp_path):
    one = _offer(tmp_path, "bus", "a", "bus.zip", "t1", 16)
    offers = [one, one, _offer(tmp_path, "bus", "b", "bus.zip", "t1", 17), _offer(tmp_path, "bus", "c", "bus.zip", "t2-longer-tag", 18),
              _offer(tmp_path, "bus", "d", "bus.zip", "t1", 19), _offer(tmp_path, "bus", "e", "bus.zip", "", 19)]
    manifest, landed = str(tmp_path / "manifest"), str(tmp_path / "landed")
    saved = intake.take_in(spark, spark.createDataFrame(offers, intake.OFFERED), manifest, landed).saved
    names = [r.version for r in saved.orderBy("fetched_at", "version").collect()]
    assert names[:2] == ["gtfs_bus-2026-08-16-t1", "gtfs_bus-2026-08-18-t2-longer-tag"]
    assert len(names) == 4 and len(set(names)) == 4 and "gtfs_bus-2026-08-19-t1" in names
    trips = timetables.read_landed(spark, landed)["trips"]
    assert trips.groupBy("version").count().select("count").distinct().collect()[0][0] == 4
    assert timetables.read_manifest(spark, manifest).count() == 4


def test_an_empty_rerun_empties_the_day(spark, tmp_path, run):
    out = str(tmp_path / "again")
    write_arrivals(run.arrivals.select("*", F.lit(None).alias("x")), out, [DAY, NEXT])
    write_arrivals(run.arrivals.where("false").select("*", F.lit(None).alias("x")), out, [DAY])
    assert rows(measured.read_arrivals(spark, out).select("service_date").distinct()) == [(NEXT,)]


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        workspace.shared_folder(Session())


def test_zip_expansion_reads_by_name_and_skips_the_rest(spark, world):
    members = timetables.read_landed(spark, world["landed"])
    assert members["feed_info"].isEmpty() and members["calendar_dates"].isEmpty()
    stop = members["stops"].where("stop_id = 's2'").first()
    assert (stop.stop_name, stop.stop_lat) == ("Stop, 2", " 34.2")
    assert members["routes"].where("feed = 'gtfs_rail'").first().route_short_name is None


def test_zip_without_calendar_is_an_error(spark, tmp_path):
    _zip(tmp_path / "gtfs_bus-2026-08-16-x.zip", {"trips.txt": "trip_id\n"})
    with pytest.raises(Exception, match="has no calendar.txt"):
        timetables.expand_zips(timetables.read_zips(spark, str(tmp_path))).collect()


def test_read_folder_matches_zip(spark, world, tmp_path):
    for name, text in _members("bus").items():
        (tmp_path / name).write_text(text, encoding="utf-8")
    folder = timetables.read_folder(spark, str(tmp_path), "gtfs_bus", "gtfs_bus-2026-08-16-aaaaaaaa11")
    for name, frame in timetables.read_landed(spark, world["landed"]).items():
        frame = frame.where(F.col("version") == "gtfs_bus-2026-08-16-aaaaaaaa11")
        assert rows(folder[name]) == rows(frame), name
    both = timetables.join_folders([folder, folder])
    assert both["trips"].count() == 2 * folder["trips"].count()
    (tmp_path / "calendar.txt").rename(tmp_path / "kept.txt")
    with pytest.raises(Exception, match="calendar.txt"):
        timetables.read_folder(spark, str(tmp_path), "gtfs_bus", "v")


def test_position_scan_prunes_partitions_and_quarantines(spark, world):
    assert positions.archive_days([DAY]) == [date(2026, 8, 17), DAY, NEXT]
    frame = positions.read_positions(spark, world["raw"], [DAY], keep_corrupt=True)
    plan = frame._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    kept = positions.observations(positions.read_positions(spark, world["raw"], [DAY]), [DAY])
    assert kept.count() == 6 * 4 - 2 + 1
    assert rows(positions.quarantine(frame), "reason", "line") == [("not JSON", "{broken")]
    counted = positions.file_tally(positions.read_positions(spark, world["raw"], [DAY]))
    assert counted.where("file_name NOT LIKE 'vehicle_positions-2026%.jsonl.gz'").isEmpty()
    with pytest.raises(FileNotFoundError):
        positions.read_positions(spark, world["raw"], [date(2030, 1, 1)])


def test_numbers_in_any_spelling(spark, tmp_path):
    folder = tmp_path / "dt=2026-08-18" / "hh=00"
    folder.mkdir(parents=True)
    make = lambda seq, ts: json.dumps({"agency": "A", "payload": {"vehicle": {
        "trip": {"startDate": "20260818", "tripId": "t"}, "currentStopSequence": seq, "timestamp": ts}}})
    with gzip.open(folder / "a.jsonl.gz", "wt") as out:
        out.write("\n".join([make(1, "10"), make("2", 20), make("3.0", 30), make("four", 40)]) + "\n")
    found = positions.read_positions(spark, str(tmp_path), [DAY], keep_corrupt=True)
    assert rows(positions.observations(found), "stop_sequence", "ts") == [(1, 10), (2, 20), (3, 30)]
    assert rows(positions.quarantine(found), "reason", "sequence") == [("bad currentStopSequence", "four")]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        positions.observations(found, strict=True).collect()


def test_bronze_keeps_service_days(spark, world, tmp_path):
    kept = positions.observations(positions.read_positions(spark, world["raw"], [DAY, NEXT]), [DAY, NEXT])
    positions.write_bronze(kept, str(tmp_path / "bronze"))
    back = positions.read_bronze(spark, str(tmp_path / "bronze"), [DAY])
    assert rows(back, *kept.columns) == rows(kept.where(F.col("service_date") == DAY))


@pytest.fixture(scope="module")
def run(spark, world):
    return measure.measure_archive(spark, world["raw"], world["landed"], world["manifest"], [DAY, NEXT], world["out"])


def test_measure_days(spark, world, run):
    # The bus version saved on the 17th lists no service in August, so the older one stands.
    assert rows(run.chosen, "feed", "version") == [
        ("gtfs_bus", "gtfs_bus-2026-08-16-aaaaaaaa11")] * 2 + [("gtfs_rail", "gtfs_rail-2026-08-16-rrrrrrrr11")] * 2
    listed = timetables.listed_versions(timetables.read_manifest(spark, world["manifest"]))
    assert rows(versions.passed_over(listed, run.chosen, "America/Los_Angeles"), "version") == [
        ("gtfs_bus-2026-08-17-bbbbbbbb11",)] * 2
    got = rows(run.arrivals.where(F.col("service_date") == DAY), "line", "trip_id", "stop_sequence", "source", "delay_seconds")
    expected = []
    for route, _ in LINES:
        for n in range(2):
            for s in range(1, 5):
                source = {1: "origin_departure", 4: "approach"}.get(s, "stopped_at")
                delay = 60 * s - (30 if s == 1 else 0)
                if (route, s) == ("2-1", 2):
                    source, delay = "none", None
                expected.append((route.split("-")[0], f"{route}-{n}", s, source, delay))
    assert got == sorted(expected, key=lambda row: tuple((v is not None, str(v)) for v in row))
    report = {r.service_date: r for r in run.report.collect()}
    assert (report[DAY].observations, report[DAY].joined, report[NEXT].join_rate) == (23, 22, 100.0)
    assert not run.ok()
    assert any("scheduled_stops=" in r.text for r in run.text().collect())
    # The broken line is counted in the pass over the archive and kept beside.
    assert run.malformed == 1 and rows(run.quarantined, "reason", "line") == [("not JSON", "{broken")]
    assert rows(run.passed_over, "version") == [("gtfs_bus-2026-08-17-bbbbbbbb11",)] * 2
    assert {r.covers for r in run.coverage.collect()} == {None}


def test_rerun_of_one_day_replaces_only_that_day(spark, world, run):
    before = rows(measured.read_arrivals(spark, world["out"]))
    parts = lambda: {p: p.stat().st_mtime_ns for p in (world["root"] / "arrivals" / f"service_date={NEXT}").rglob("*.parquet")}
    files = parts()
    measure.measure_archive(spark, world["raw"], world["landed"], world["manifest"], [DAY], world["out"])
    assert rows(measured.read_arrivals(spark, world["out"])) == before
    assert files and files == parts()
    live = day_table.live_folders(spark, world["out"])
    weight = sizes.table_size(spark, live, measured.read_arrivals(spark, world["out"])).first()
    assert weight.rows == 48 and weight.bytes_per_row > 0


def test_day_without_timetable_is_fatal(spark, world, tmp_path):
    with pytest.raises(measure.NoTimetable, match="gtfs_bus on 2027-01-01"):
        measure.measure_days(spark, spark.createDataFrame([], OBSERVATIONS),
            timetables.read_landed(spark, world["landed"]), timetables.read_manifest(spark, world["manifest"]),
            [date(2027, 1, 1)], str(tmp_path / "out"))


def _build(spark, out):
    return Path(site.live(spark, str(out)))


def _site_files(build):
    found = {}
    for path in sorted((build / "lines").rglob("*.json")):
        found.setdefault((path.parent.name, path.stem), []).append(path.read_text())
    return found


def test_summarise_writes_a_site_that_reruns_identically(spark, world, run):
    out = world["root"] / "site"
    (span,) = summarise.summarise(spark, world["out"], world["landed"], world["manifest"], str(out)).collect()
    assert (span.first_day, span.last_day, span.days, span.provisional) == (DAY, NEXT, 2, True)
    build = _build(spark, out)
    files = _site_files(build)
    assert set(files) == {("LACMTA", "2"), ("LACMTA", "720"), ("LACMTA_Rail", "801")}
    assert all(len(texts) == 1 for texts in files.values())
    rail = json.loads(files[("LACMTA_Rail", "801")][0])
    assert (rail["label"], rail["via"], rail["mode"]) == ("Metro A Line", "", "rail")
    bus = json.loads(files[("LACMTA", "2")][0])
    assert bus["via"] == "Downtown LA" and [d["to"] for d in bus["directions"]] == ["End 0", "End 1"]
    first = bus["directions"][0]
    assert [(s["id"], s["n"], s["sched"]) for s in first["stops"]] == [("s2", 0, 2), ("s3", 2, 2), ("s4", 2, 2)]
    assert first["n"] == sum(s["n"] for s in first["stops"]) == 4
    assert first["stops"][1]["name"] == "Stop, 3" and first["stops"][0]["cells"] == []
    index = json.loads((build / "index.json").read_text())
    assert [entry["line"] for entry in index["lines"]] == ["2", "720", "801"]
    status = json.loads((build / "status.json").read_text())
    assert (status["scheduled_stops"], status["measured_arrivals"], status["coverage_pct"]) == (36, 32, 88.9)
    weights = {r.kind: r for r in summarise.site_sizes(spark, str(out)).collect()}
    assert weights["plain"].documents == 3 and weights["gzip"].bytes < weights["plain"].bytes
    summarise.summarise(spark, world["out"], world["landed"], world["manifest"], str(out))
    assert _site_files(_build(spark, out)) == files and _build(spark, out) != build


def test_vanished_lines_leave_the_site(spark, world, run, tmp_path):
    kept = measured.read_arrivals(spark, world["out"]).where("line <> '2'")
    again = str(tmp_path / "fewer")
    write_arrivals(kept.select("*", F.lit(None).alias("x")), again)
    out = world["root"] / "site"
    summarise.summarise(spark, again, world["landed"], world["manifest"], str(out), gzip_copy=False)
    build = _build(spark, out)
    assert set(_site_files(build)) == {("LACMTA", "720"), ("LACMTA_Rail", "801")}
    assert not (build / "lines_gzip").exists()  # no older copy outlives the run


def test_a_failing_write_leaves_the_day_as_it_was(spark, tmp_path, run, monkeypatch):
    out = str(tmp_path / "table")
    whole = run.arrivals.select("*", F.lit(None).alias("x"))
    write_arrivals(whole, out, [DAY, NEXT])
    before = rows(measured.read_arrivals(spark, out))
    broken = whole.where("service_date = '2026-08-18'").withColumn(
        "line", F.when(F.col("trip_id") == "801-1", F.raise_error(F.lit("lost"))).otherwise(F.col("line")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        write_arrivals(broken, out, [DAY, NEXT])
    assert rows(measured.read_arrivals(spark, out)) == before

    def dies(*_):
        raise RuntimeError("killed before the commit")

    monkeypatch.setattr(day_table, "commit", dies)
    with pytest.raises(RuntimeError, match="killed"):
        write_arrivals(whole.where("line = '801'"), out, [DAY, NEXT])
    monkeypatch.undo()
    assert rows(measured.read_arrivals(spark, out)) == before
    write_arrivals(whole.where("line = '801'"), out, [DAY, NEXT])
    assert measured.read_arrivals(spark, out).count() == 16
    # What two newer manifests no longer name is gone, and so are the manifests.
    write_arrivals(whole.where("line = '801'"), out, [DAY, NEXT])
    assert len(list((tmp_path / "table" / "_manifest").glob("*.json"))) == day_table.KEPT_MANIFESTS


def test_two_writers_of_one_manifest_conflict(spark, tmp_path):
    path = str(tmp_path / "table")
    day_table.commit(spark, path, {DAY: day_table.Entry("a")})
    day_table.write_small(spark, f"{path}/_manifest/000000000002.json", '{"days": {}}')
    with pytest.raises(day_table.Conflict):
        day_table.write_small(spark, f"{path}/_manifest/000000000002.json", '{"days": {}}')
    assert day_table.entries(spark, path) == {}


def test_a_broken_publish_leaves_the_site_and_no_leftovers(spark, world, run, tmp_path, monkeypatch):
    out = tmp_path / "site"
    paths = world["out"], world["landed"], world["manifest"], str(out)
    summarise.summarise(spark, *paths)
    build, files = _build(spark, out), _site_files(_build(spark, out))

    def dies(*_):
        raise RuntimeError("killed before the switch")

    monkeypatch.setattr(site, "_switch", dies)
    with pytest.raises(RuntimeError, match="killed"):
        summarise.summarise(spark, *paths)
    monkeypatch.undo()
    assert _build(spark, out) == build and _site_files(build) == files
    summarise.summarise(spark, *paths)
    kept = {path.name for path in (out / "builds").iterdir()}
    assert _site_files(_build(spark, out)) == files and kept == {build.name, _build(spark, out).name}


def test_a_new_day_reads_one_day_and_equals_a_rebuild(spark, run, world, tmp_path, monkeypatch):
    path, kept = str(tmp_path / "arrivals"), str(tmp_path / "tallies")
    whole = run.arrivals.select("*", F.lit(None).alias("x"))
    late = whole.withColumns({"service_date": F.date_add("service_date", 2), "delay_seconds": (F.col("delay_seconds") + 7).cast("int")})
    read, plain_read = [], day_table.read_entries

    def watched(session, table, schema, wanted):
        wanted = list(wanted)
        if table == path:
            read.append(sorted(day for day, _ in wanted))
        return plain_read(session, table, schema, wanted)

    def refreshed():
        counts = tallies.refresh(spark, path, kept, measure.LOS_ANGELES)
        monkeypatch.setattr(day_table, "read_entries", plain_read)
        view = grains.rider_view(measured.read_arrivals(spark, path), measure.LOS_ANGELES.zone)
        rebuilt = grains.histogram(view)
        assert rows(counts) == rows(rebuilt.select(*counts.columns))
        assert rows(tallies.span(spark, kept)) == rows(grains.day_span(view))
        monkeypatch.setattr(day_table, "read_entries", watched)
        return counts

    monkeypatch.setattr(day_table, "read_entries", watched)
    write_arrivals(whole, path)
    counts = refreshed()
    full, summary = summarise.summarise_view(grains.rider_view(run.arrivals, measure.LOS_ANGELES.zone)), summarise.summary_of(counts)
    for name in ("profile", "heads", "cells", "totals", "site"):
        assert rows(getattr(full, name)) == rows(getattr(summary, name)), name
    write_arrivals(late.where("service_date = '2026-08-20'"), path)  # a new day
    refreshed()
    write_arrivals(whole.where("service_date = '2026-08-18' AND line = '2'"), path)  # a day measured anew
    refreshed()
    write_arrivals(whole.where("false"), path, [NEXT])  # a day that goes
    refreshed()
    refreshed()  # nothing new
    assert read == [[DAY, NEXT], [date(2026, 8, 20)], [DAY], []]
    # Without the old snapshot of a replaced day the total is summed anew.
    day_table.commit(spark, f"{kept}/days", {})
    day_table.commit(spark, f"{kept}/days", {})
    write_arrivals(whole.where("service_date = '2026-08-18'"), path)
    refreshed()
    assert read[-1] == [DAY]


def test_a_changed_day_leaves_the_total_unwritten(spark, tmp_path):
    kept = str(tmp_path / "tallies")
    counted = {}

    def counts_of(day, n):
        counted[day] = n
        day_table.write_days(spark.createDataFrame(
            [(date(2026, 8, day), "trips", "A", "7", None, None, None, None, None, None, str(trip), n, 1) for trip in range(2)],
            TALLIES), f"{kept}/days", [date(2026, 8, day)])

    def checked():
        got = rows(tallies.total(spark, kept), "trip_id", "n", "seen")
        assert got == [(str(trip), sum(counted.values()), len(counted)) for trip in range(2)]
        manifests = day_table.numbered(spark, f"{kept}/total/_manifest")
        return json.loads(day_table.read_small(spark, manifests[max(manifests)]))["folder"]

    for day in range(1, 8):
        counts_of(day, day)
    first = checked()
    for day, n in ((8, 3), (2, 50), (2, 60)):
        counts_of(day, n)
        assert checked() == first
    for day in range(1, 7):
        counts_of(day, 90 + day)
    second = checked()
    assert second != first
    counts_of(1, 1)
    assert checked() == second
    folders = {path.name for path in (tmp_path / "tallies/total").iterdir()}
    assert first not in folders and second in folders


def test_summarise_from_kept_tallies_writes_the_same_site(spark, world, run, tmp_path):
    whole, kept = tmp_path / "whole", tmp_path / "kept"
    paths = world["out"], world["landed"], world["manifest"]
    summarise.summarise(spark, *paths, str(whole), gzip_copy=False)
    for _ in range(2):
        (span,) = summarise.summarise(spark, *paths, str(kept), gzip_copy=False, tallies=str(tmp_path / "tallies")).collect()
        assert (span.first_day, span.last_day, span.days, span.provisional) == (DAY, NEXT, 2, True)
    a, b = _build(spark, whole), _build(spark, kept)
    assert _site_files(a) == _site_files(b)
    for name in ("index.json", "status.json"):
        assert (a / name).read_text() == (b / name).read_text()
