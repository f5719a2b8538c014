"""Summarise every measured day into the documents a web page reads."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from dwelltime.network import LOS_ANGELES, Network
from dwelltime.operators import documents, grains, labels
from dwelltime.plans.measure import choose_timetables
from dwelltime.plans.tallies import read_total, refresh, span
from dwelltime.sinks import site, sizes
from dwelltime.sources import measured, timetables
from dwelltime.workspace import fresh_path, materialise


@dataclass(frozen=True)
class Summary:
    """The grouped tables behind the site, each written once."""

    profile: DataFrame
    heads: DataFrame
    cells: DataFrame
    totals: DataFrame
    site: DataFrame


def summary_of(histogram: DataFrame) -> Summary:
    """All grains of one histogram; the arrivals are not read again."""
    return Summary(
        materialise(grains.profiles_of(histogram), "profile"),
        materialise(grains.headlines_of(histogram), "headlines"),
        materialise(grains.stop_cells_of(histogram), "cells"),
        materialise(grains.stop_totals_of(histogram), "totals"),
        materialise(grains.all_site_totals_of(histogram), "site_totals"))


def counted_view(view: DataFrame) -> DataFrame:
    """The histogram of a rider view, counted in one pass and written once, a folder a grain."""
    return counted_days(view)[0]


def counted_days(view: DataFrame) -> tuple[DataFrame, DataFrame]:
    """`counted_view`, and the rows of each service day from the same pass."""
    spark, path = view.sparkSession, fresh_path(view.sparkSession, "histogram")
    grains.histogram(view, days=True).write.partitionBy("grain").parquet(path)
    days = spark.read.schema("grain string, service_date date, n long").parquet(path)
    return (read_total(spark, path).where(F.col("grain") != grains.DAYS),
            days.where(F.col("grain") == grains.DAYS).select("service_date", "n"))


def summarise_view(view: DataFrame) -> Summary:
    """All grains of a rider view from one scan of it."""
    return summary_of(counted_view(view))


def write_site(summary: Summary, names: dict[str, DataFrame], span: documents.Span, out: str,
               gzip_copy: bool = False) -> str:
    """Line files, index and status as a build of their own under `out`, then named the current one."""
    spark, built = summary.totals.sparkSession, site.new_build(out)
    stops = materialise(documents.stop_entries(summary.totals, summary.cells, names["stops"]), "stops")
    directions = materialise(
        documents.direction_entries(summary.profile, stops, names["directions"]), "directions")
    parts = documents.line_parts(summary.profile, stops, directions, names, span)
    site.write_lines(parts, f"{built}/lines")
    if gzip_copy:
        site.write_lines(parts, f"{built}/lines_gzip", "gzip")
    entries = documents.index_entries(summary.heads, summary.profile, directions, names)
    site.write_parts(documents.index_parts(entries, span), f"{built}/index", documents.INDEX_ORDER)
    site.write_document(documents.status_document(summary.site, span), f"{built}/status")
    return site.publish(spark, built, out)


def summarise(spark: SparkSession, arrivals: str, landed: str, manifest: str, out: str,
              network: Network = LOS_ANGELES, gzip_copy: bool = True, tallies: str | None = None) -> DataFrame:
    """Build the site from every measured day; returns the span row with its provisional flag.

    `tallies` is a folder that keeps the days' counts between runs: then only days measured since the
    last run are read. Names come from the timetable in force on the last measured day.
    """
    if tallies:
        histogram = refresh(spark, arrivals, tallies, network)
        measured_days = span(spark, tallies)
    else:
        view = grains.rider_view(measured.read_arrivals(spark, arrivals), network.zone)
        histogram = None
        measured_days = materialise(grains.day_span(view), "span")
    known = measured_days.first()
    if known is None or not known.days:
        raise ValueError(f"no measured arrivals under {arrivals}")
    members = timetables.read_landed(spark, landed)
    timetable = choose_timetables(
        members, timetables.read_manifest(spark, manifest), [known.last_day], network)
    names = {key: materialise(frame, key) for key, frame in labels.catalogue(
        timetable.members, timetable.chosen, network).items()}
    write_site(summarise_view(view) if histogram is None else summary_of(histogram), names,
               documents.Span.of(known.first_day, known.last_day, known.days), out, gzip_copy)
    return measured_days


def site_sizes(spark: SparkSession, out: str) -> DataFrame:
    """Largest line file and totals, plain and gzipped."""
    out = site.live(spark, out)
    label = lambda kind, frame: frame.select(F.lit(kind).alias("kind"), "*")
    return label("plain", sizes.largest_document(sizes.document_sizes(spark, f"{out}/lines"))).unionByName(
        label("gzip", sizes.largest_document(sizes.document_sizes(spark, f"{out}/lines_gzip"))))
