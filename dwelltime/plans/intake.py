"""Take in offered timetables: keep changed ones as new versions, report line drift."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from dwelltime.functions import clock, text
from dwelltime.network import LOS_ANGELES, Network
from dwelltime.operators import versions
from dwelltime.schemas import TIMETABLE_VERSIONS
from dwelltime.sources import timetables
from dwelltime.workspace import full_path, materialise

OFFERED = "feed string, etag string, source_url string, fetched_at timestamp, path string"


@dataclass(frozen=True)
class Intake:
    saved: DataFrame
    drift: DataFrame

    def drifted(self) -> bool:
        return not self.drift.isEmpty()


def take_in(spark: SparkSession, offered: DataFrame, manifest: str, landed: str,
            network: Network = LOS_ANGELES, recorded: DataFrame | None = None) -> Intake:
    """Save the offered zips whose tag differs from the one before of their feed, offered or saved.

    `offered` has a row per downloaded zip (OFFERED). Changed versions are expanded into the
    timetable tables first and listed in the manifest last, so a listed version is complete.
    """
    try:
        known = timetables.read_manifest(spark, manifest)
        known.limit(0).count()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        known = spark.createDataFrame([], TIMETABLE_VERSIONS)

    fresh = offered.withColumn("source_etag", text.clean_etag(F.col("etag")))
    changed = materialise(versions.new_versions(fresh, known), "changed")

    # A row per offered feed: this is the list of files to open.
    paths = {row.path: full_path(spark, row.path) for row in changed.select("path").distinct().collect()}
    if not paths:
        nothing = spark.createDataFrame([], "agency string, line string, change string")
        return Intake(spark.createDataFrame([], TIMETABLE_VERSIONS), nothing)

    # Whole paths: files of one name may lie in several folders.
    content = spark.read.format("binaryFile").load(sorted(set(paths.values()))).select(
        F.col("path").alias("file"), "content")
    spelled = spark.createDataFrame(list(paths.items()), "path string, file string")
    named = changed.join(spelled, "path").join(content, "file", "left").withColumn(
        "version", versions.version_name(
            F.col("feed"), clock.utc_day(F.col("fetched_at")), F.col("source_etag"), F.col("content")))
    named = materialise(named, "named")
    lacking = [row.path for row in named.where("content IS NULL").select("path").distinct().collect()]
    if lacking:
        raise FileNotFoundError(f"offered timetables without content: {lacking}")
    # A version that is offered again after another one is listed twice and landed once.
    timetables.land_timetables(
        named.dropDuplicates(["feed", "version"]).select("feed", "version", "content"), landed)
    changed = named.drop("content", "file")

    wanted = changed.select("feed", "version")
    routes = timetables.read_landed(spark, landed)["routes"].join(
        wanted, ["feed", "version"], "left_semi")
    published = materialise(versions.published_lines(routes), "published")
    # One text, as the manifest keeps it: the codes in natural order, with commas between.
    codes = published.groupBy("feed", "version").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct(F.length("line").alias("width"), F.col("line")))),
        lambda entry: entry["line"]), ",").alias("route_codes"))
    saved = materialise(changed.join(codes, ["feed", "version"], "left").withColumn(
        "updated_at", F.col("fetched_at")).select(*TIMETABLE_VERSIONS.names), "saved")
    saved.write.mode("append").parquet(manifest)

    agency = network.agency_of(F.col("feed")).alias("agency")
    recorded = versions.recorded_lines(spark) if recorded is None else recorded
    ours = recorded.join(wanted.select(agency).distinct(), "agency", "left_semi")
    theirs = published.select(agency, "line").distinct()
    return Intake(saved, versions.line_drift(theirs, ours, ["agency"]))
