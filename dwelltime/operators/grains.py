"""Summaries of measured arrivals, each at the grain one question needs.

Origins are left out throughout: they time a departure. Every row carries what was
scheduled next to what was measured.

All summaries can be read from one histogram, which one pass over the arrivals counts: rows by
line, hour and delay, by stop, daypart and delay, by stop and place along the route, and by trip.
Histograms of days add up, so a new day is counted alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from dwelltime import fixed_values as fixed
from dwelltime.functions import clock, metrics

LINE = ["agency", "line"]
DIRECTION = [*LINE, "direction_id"]
STOP = [*DIRECTION, "stop_id"]
PROFILE = [*DIRECTION, "how"]
CELL = [*STOP, "bucket"]
TRIP = [*LINE, "trip_id"]

HOURS, PARTS, PLACES, TRIPS, DAYS = "hours", "parts", "places", "trips", "days"
#: What the histogram counts rows by; the last column of the first three is the value that is ranked.
GRAINS = {HOURS: [*PROFILE, metrics.DELAY], PARTS: [*CELL, metrics.DELAY], PLACES: [*STOP, "stop_sequence"], TRIPS: TRIP}
_COLUMNS = list(dict.fromkeys(column for keys in GRAINS.values() for column in keys))
HISTOGRAM = ["grain", *_COLUMNS, "n", "seen"]


def rider_view(arrivals: DataFrame, zone: str) -> DataFrame:
    """Arrivals without origins, with day of week, hour, hour of week and daypart, local."""
    wall = clock.local_wall(F.unix_seconds("scheduled_time"), zone)
    return (arrivals.where(~F.col("is_origin")).withColumn("wall", wall)
            .withColumn("dow", clock.day_of_week(F.col("wall")))
            .withColumn("hr", F.hour("wall"))
            .withColumn("how", clock.hour_of_week(F.col("wall")))
            .withColumn("bucket", clock.daypart(F.col("wall")))
            .drop("wall"))


def profiles(view: DataFrame) -> DataFrame:
    """Hour-of-week shape of each line and direction, pooled over its stops."""
    return metrics.delay_metrics(view, PROFILE)


def headlines(view: DataFrame) -> DataFrame:
    """One row per line."""
    return metrics.delay_metrics(view, LINE)


def stop_cells(view: DataFrame) -> DataFrame:
    """Per stop and part of day; cells in which nothing was measured are dropped."""
    return metrics.delay_metrics(view, CELL)


def stop_totals(view: DataFrame) -> DataFrame:
    """Per stop over every scheduled row, with its median place along the route.

    Not a sum of cells: stops whose dayparts saw nothing must still count as scheduled.
    """
    return totals_of(view.groupBy(*STOP, "stop_sequence").agg(
        F.count(F.lit(1)).alias("n"), F.count(metrics.DELAY).alias("seen")))


def totals_of(places: DataFrame) -> DataFrame:
    """`stop_totals` from rows counted by stop and place."""
    return metrics.ranked(places, STOP, "stop_sequence").groupBy(*STOP).agg(
        F.round(metrics.level(0.5, "stop_sequence")).cast("int").alias("seq"),
        F.sum("n").alias("scheduled"), F.sum("seen").alias("measured"))


def direction_totals(totals: DataFrame) -> DataFrame:
    return totals.groupBy(*DIRECTION).agg(
        F.sum("scheduled").alias("scheduled"), F.sum("measured").alias("measured"))


def site_totals(view: DataFrame) -> DataFrame:
    """Rows, measured rows, lines, trips and coverage over all days, one row.

    Counted per trip first, so the distinct counts run over trips, not stops. `lines_by_code`
    counts codes regardless of agency, `lines` counts lines.
    """
    return site_totals_of(view.groupBy(*TRIP).agg(
        F.count(F.lit(1)).alias("n"), F.count(metrics.DELAY).alias("seen")))


def site_totals_of(trips: DataFrame) -> DataFrame:
    """`site_totals` from rows counted by trip."""
    coverage = F.bround(metrics.share(F.col("measured_arrivals"), F.col("scheduled_stops")), 1)
    return trips.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("scheduled_stops"),
        F.coalesce(F.sum("seen"), F.lit(0)).alias("measured_arrivals"),
        F.count_distinct("agency", "line").alias("lines"),
        F.count_distinct("line").alias("lines_by_code"),
        F.count_distinct("trip_id").alias("trips"),
    ).withColumn("coverage_pct", coverage)


def day_span(view: DataFrame) -> DataFrame:
    """First and last measured day and how many there are; too few makes the rest provisional."""
    return view.agg(
        F.min("service_date").alias("first_day"), F.max("service_date").alias("last_day"),
        F.count_distinct("service_date").alias("days"),
    ).withColumn("provisional", F.col("days") < fixed.SETTLED_DAYS)


# One histogram ------------------------------------------------------------------------

def histogram(view: DataFrame, by: Sequence[str] = (), days: bool = False) -> DataFrame:
    """Rows and measured rows of all GRAINS from one pass, optionally per `by` (such as the day) as well.

    A row of the view becomes four on the map side and merges there; only counts are shuffled. With `days`
    rows are counted by service day too, as a grain of its own, and the day is the last column.
    """
    grains = GRAINS | {DAYS: ["service_date"]} if days else GRAINS
    columns = [*by, *_COLUMNS, *(["service_date"] if days else [])]
    sets = [[*by, *keys] for keys in grains.values()]
    # Which columns a set lacks, as the bits that grouping_id gives it.
    lacks = {grain: sum(1 << at for at, column in enumerate(reversed(columns)) if column not in keys)
             for grain, keys in zip(grains, sets, strict=True)}
    grain = F.element_at(F.create_map(*[F.lit(x) for pair in lacks.items() for x in pair[::-1]]), F.col("lacks"))
    grouped = view.groupingSets(sets, *columns).agg(
        F.grouping_id().cast("int").alias("lacks"), F.count(F.lit(1)).alias("n"),
        F.count(metrics.DELAY).alias("seen"))
    return grouped.select(*by, grain.alias("grain"), *_COLUMNS, "n", "seen", *(["service_date"] if days else []))


def added(histograms: DataFrame) -> DataFrame:
    """One histogram from those of several days."""
    return histograms.groupBy("grain", *_COLUMNS).agg(F.sum("n").alias("n"), F.sum("seen").alias("seen"))


def _of(counts: DataFrame, grain: str) -> DataFrame:
    return counts.where(F.col("grain") == grain)


def profiles_of(counts: DataFrame) -> DataFrame:
    return metrics.metrics_of(_of(counts, HOURS).select(*GRAINS[HOURS], "n"), PROFILE)


def headlines_of(counts: DataFrame) -> DataFrame:
    return metrics.metrics_of(metrics.merged(_of(counts, HOURS), LINE), LINE)


def stop_cells_of(counts: DataFrame) -> DataFrame:
    """Dealt by stop, which holds a row a daypart and delay: what a stop's cells are gathered into needs no other exchange."""
    return metrics.metrics_of(_of(counts, PARTS).select(*GRAINS[PARTS], "n").repartition(*STOP), CELL)


def stop_totals_of(counts: DataFrame) -> DataFrame:
    return totals_of(_of(counts, PLACES).select(*GRAINS[PLACES], "n", "seen"))


def all_site_totals_of(counts: DataFrame) -> DataFrame:
    return site_totals_of(_of(counts, TRIPS).select(*GRAINS[TRIPS], "n", "seen"))
