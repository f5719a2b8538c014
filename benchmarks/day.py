"""One whole service day at the published size: builds an archive, then times measuring it.

    python benchmarks/day.py build FOLDER [share]     # share of the 43 million records, default 1
    python benchmarks/day.py measure FOLDER

The build writes gzipped JSON lines of three UTC days, of which two thirds belong to the
measured day, and two timetable zips with about 880,000 stops. Give it a fresh folder.
"""

from __future__ import annotations

import json
import sys
import time
import zipfile
from datetime import date, datetime, timezone
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from dwelltime.plans import intake, measure  # noqa: E402
from dwelltime.session import build_session  # noqa: E402
from dwelltime.streaming.landing import envelope  # noqa: E402

DAY, BASE = date(2026, 8, 18), 1787036400
TRIPS, STOPS, RECORDS = 14_588, 60, 43_000_000


def session():
    spark = build_session("day", zone="America/Los_Angeles", shuffle_partitions=64, master="local[8]", **{
        "spark.driver.memory": "16g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _clock(seconds: int) -> str:
    return f"{seconds // 3600:02d}:{seconds // 60 % 60:02d}:{seconds % 60:02d}"


def _write_zip(path: Path, trips: range, prefix: str) -> None:
    week = "1,1,1,1,1,1,1"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as bundle:
        bundle.writestr("calendar.txt", "service_id,monday,tuesday,wednesday,thursday,friday,saturday,sunday,"
                                        f"start_date,end_date\ndaily,{week},20260801,20260930\n")
        bundle.writestr("trips.txt", "route_id,service_id,trip_id,direction_id\n" + "".join(
            f"{prefix}{t % 114}-1,daily,{t},{t % 2}\n" for t in trips))
        bundle.writestr("stops.txt", "stop_id,stop_name,stop_lat,stop_lon\n")
        bundle.writestr("routes.txt", "route_id,route_short_name,route_long_name,route_desc,route_type\n" + "".join(
            f"{prefix}{line}-1,{line},,MAIN ST,3\n" for line in range(114)))
        bundle.writestr("stop_times.txt", "trip_id,arrival_time,departure_time,stop_id,stop_sequence,destination_code\n" + "".join(
            f"{t},{_clock(t * 5 % 72000 + 14400 + s * 60)},{_clock(t * 5 % 72000 + 14430 + s * 60)},{t % 97 * 100 + s},{s},Downtown\n"
            for t in trips for s in range(1, STOPS + 1)))


def build(folder: str, share: float) -> None:
    spark, records = session(), int(RECORDS * share)
    rail = TRIPS // 20
    trip = F.pmod(F.xxhash64("id"), F.lit(TRIPS))
    sequence = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(STOPS)) + 1
    shift = F.when(F.col("id") % 100 < 65, 0).when(F.col("id") % 100 < 85, 1).otherwise(-1)
    frame = spark.range(0, records, 1, 864).select("id", trip.alias("trip"), sequence.alias("seq"), shift.alias("shift"))
    frame = frame.withColumn("ts", BASE + F.col("shift") * 86400 + F.col("trip") * 5 % 72000 + 14400 + F.col("seq") * 60
                             + F.pmod(F.xxhash64("id", F.lit(2)), F.lit(240)) - 60)
    vehicle = F.struct(
        F.struct(F.date_format(F.date_add(F.lit(DAY), F.col("shift")), "yyyyMMdd").alias("startDate"),
                 F.col("trip").cast("string").alias("tripId"), F.concat(F.col("trip") % 114, F.lit("-1")).alias("routeId"),
                 F.lit("SCHEDULED").alias("scheduleRelationship")).alias("trip"),
        F.struct((F.lit(34.0) + F.col("id") % 1000 / 9999).alias("latitude"), (F.lit(-118.0) - F.col("id") % 777 / 9999).alias("longitude"),
                 F.lit(90.0).alias("bearing"), F.lit(8.9408).alias("speed")).alias("position"),
        F.when(F.col("id") % 3 == 0, "STOPPED_AT").otherwise("IN_TRANSIT_TO").alias("currentStatus"),
        F.col("seq").alias("currentStopSequence"), (F.col("trip") % 97 * 100 + F.col("seq")).cast("string").alias("stopId"),
        F.col("ts").cast("string").alias("timestamp"), F.struct(F.col("trip").cast("string").alias("id")).alias("vehicle"))
    agency = F.when(F.col("trip") < rail, "LACMTA_Rail").otherwise("LACMTA")
    moment = F.timestamp_seconds("ts")
    from dwelltime.functions import clock
    lines = frame.select(
        envelope(moment, agency, F.to_json(F.struct(F.col("id").cast("string").alias("id"), vehicle.alias("vehicle")))).alias("value"),
        clock.utc_day(moment).alias("dt"), F.lpad(clock.utc_hour(moment).cast("string"), 2, "0").alias("hh"), (F.col("ts") % 3600 / 300).cast("int").alias("slot"))
    (lines.repartition(288, "dt", "hh", "slot").select("value", "dt", "hh")
     .write.option("compression", "gzip").partitionBy("dt", "hh").text(f"{folder}/raw"))
    _write_zip(Path(folder) / "bus.zip", range(rail, TRIPS), "")
    _write_zip(Path(folder) / "rail.zip", range(rail), "80")
    at = datetime(2026, 8, 17, tzinfo=timezone.utc)
    intake.take_in(spark, spark.createDataFrame([
        ("gtfs_bus", "aaaaaaaa", "u", at, f"{folder}/bus.zip"), ("gtfs_rail", "rrrrrrrr", "u", at, f"{folder}/rail.zip")],
        intake.OFFERED), f"{folder}/manifest", f"{folder}/landed")


def time_measure(folder: str) -> None:
    spark = session()
    started = time.monotonic()
    run = measure.measure_archive(spark, f"{folder}/raw", f"{folder}/landed", f"{folder}/manifest", [DAY], f"{folder}/arrivals")
    wrote = time.monotonic() - started
    report = run.report.first()
    run.checks.collect()
    print(json.dumps({"metric": "measure_one_day", "value": round(time.monotonic() - started, 2), "unit": "sec",
                      "until_written": round(wrote, 2), "scheduled_stops": report.scheduled_stops,
                      "measured": report.measured, "observations": report.observations, "joined": report.joined}))


if __name__ == "__main__":
    if sys.argv[1] == "build":
        build(sys.argv[2], float(sys.argv[3]) if len(sys.argv) > 3 else 1.0)
    else:
        time_measure(sys.argv[2])
