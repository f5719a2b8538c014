"""Measure service days: archive and timetables in, one partition of arrivals a day out."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from dwelltime.functions import clock
from dwelltime.network import LOS_ANGELES, Network
from dwelltime.operators import match, observe, quality, schedule, services, versions
from dwelltime.sinks.arrivals_table import write_arrivals
from dwelltime.sources import measured, positions, timetables
from dwelltime.workspace import materialise


class NoTimetable(RuntimeError):
    """Feeds and days that no saved version serves; `days` is the whole table of them."""

    def __init__(self, message: str, days: DataFrame):
        super().__init__(message)
        self.days = days


@dataclass(frozen=True)
class Timetable:
    """The choice of version per feed and day, and the members to read it from."""

    members: dict[str, DataFrame]
    running: DataFrame
    chosen: DataFrame


def choose_timetables(members: dict[str, DataFrame], manifest: DataFrame, days: Sequence[date],
                      network: Network) -> Timetable:
    """The version in force per feed and day. A feed and day without one is an error."""
    spark = manifest.sparkSession
    listed = timetables.listed_versions(manifest).where(F.col("feed").isin(list(network.feeds)))
    running = materialise(
        services.running_services(members["calendar"], members["calendar_dates"], days), "running")
    chosen = materialise(versions.choose_versions(listed, running, network.zone), "chosen")

    literals = lambda values: F.explode(F.array(*[F.lit(value) for value in values]))
    wanted = spark.range(1).select(literals(network.feeds).alias("feed")).select(
        "feed", literals(days).alias("service_date"))
    lacking = materialise(versions.missing_days(wanted, chosen), "lacking")
    count = lacking.count()
    if count:
        first = lacking.orderBy("service_date", "feed").first()
        raise NoTimetable(f"no saved timetable lists any service for {count} feeds and days, the first of them "
                          f"{first.feed} on {first.service_date}", lacking)

    # A row per feed and day at most, so the versions become a literal partition filter.
    pairs = [(row.feed, row.version) for row in chosen.select("feed", "version").distinct().collect()]
    needed = F.lit(False)
    for feed in network.feeds:
        needed = needed | ((F.col("feed") == feed) & F.col("version").isin([v for f, v in pairs if f == feed]))
    return Timetable({name: frame.where(needed) for name, frame in members.items()},
                     running.join(chosen.select("feed", "version", "service_date"),
                                  ["feed", "version", "service_date"], "left_semi"), chosen)


@dataclass(frozen=True)
class Measured:
    """What a run leaves behind. Every frame reads a written table."""

    arrivals: DataFrame
    observed: DataFrame
    chosen: DataFrame
    report: DataFrame
    agencies: DataFrame
    silent: DataFrame
    checks: DataFrame
    coverage: DataFrame
    passed_over: DataFrame
    malformed: int = 0
    quarantined: DataFrame | None = None

    def ok(self) -> bool:
        return quality.verdicts(self.checks).where(~F.col("ok")).isEmpty()

    def text(self) -> DataFrame:
        return quality.report_text(self.report, self.agencies, self.checks, self.silent).orderBy(
            "service_date", "section", "item")


def measure_days(spark: SparkSession, observations: DataFrame, members: dict[str, DataFrame],
                 manifest: DataFrame, days: Sequence[date], out: str,
                 network: Network = LOS_ANGELES) -> Measured:
    """Measure the given service days in one job and replace their partitions under `out`.

    The archive is read once: its collapsed form, a thirtieth of the records, is written to
    the shared folder and feeds both the match and the observation check. The report counts
    the days just written in one scan.
    """
    days = sorted(set(days))
    timetable = choose_timetables(members, manifest, days, network)
    observed = materialise(observe.observed_stops(observations), "observed")
    due = schedule.scheduled_stops(
        timetable.members["stop_times"], timetable.members["trips"], timetable.running, network)
    write_arrivals(match.match_arrivals(due, observed), out, days)

    arrivals = measured.read_arrivals(spark, out, days)
    counts = materialise(quality.report_counts(arrivals), "counts")
    lines = materialise(quality.line_counts_of(counts), "lines")
    agencies, silent = quality.by_agency(lines), quality.silent_lines(lines)
    report = materialise(quality.with_ratios(
        quality.report_of(counts), quality.observation_check(observed, arrivals)), "report")
    checks = quality.quality_checks(report, agencies, silent, len(network.feeds))
    coverage = versions.coverage_warnings(timetable.chosen, timetable.members["feed_info"])
    passed = versions.passed_over(timetables.listed_versions(manifest), timetable.chosen, network.zone)
    return Measured(arrivals, observed, timetable.chosen, report, agencies, silent, checks, coverage, passed)


def measure_archive(spark: SparkSession, raw: str, landed: str, manifest: str, days: Sequence[date],
                    out: str, network: Network = LOS_ANGELES, committed_only: bool = False) -> Measured:
    """`measure_days` from paths: raw archive, timetable tables, version manifest.

    Lines stamped with another day leave before they are parsed. Records that cannot be read are
    counted in the pass that reads all others; only if there are any, a second pass writes them
    to the shared folder.
    """
    records = positions.read_day_records(spark, raw, days, committed_only)
    seen = Observation("records")
    watched = records.observe(seen, F.count_if(positions.problem().isNotNull()).alias("malformed"))
    members = timetables.read_landed(spark, landed)
    run = measure_days(spark, positions.observations(watched, days), members,
                       timetables.read_manifest(spark, manifest), days, out, network)
    malformed = seen.get["malformed"]
    aside = materialise(positions.quarantine(records), "quarantine") if malformed else None
    return replace(run, malformed=malformed, quarantined=aside)


def default_days(network: Network = LOS_ANGELES) -> list[date]:
    return [clock.default_service_date(network.zone)]
