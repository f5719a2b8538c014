"""Timetables: zips expanded into Parquet tables, unpacked folders, the version manifest."""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from dwelltime import fixed_values as fixed
from dwelltime.schemas import TIMETABLE_VERSIONS
from dwelltime.workspace import materialise, partition_folder, remove

MEMBER_ROWS = "feed string, version string, member string, fields array<string>"
OPTIONAL_FILES = {"calendar_dates.txt", "feed_info.txt"}
_BATCH = 20_000
ROWS_PER_FILE = 200_000


def read_zips(spark: SparkSession, path: str) -> DataFrame:
    """Zip files named `<version>.zip`, one row each; the feed is the version's leading name.

    Versions are named `<feed>-<date>-<tag>`, so the feed is what precedes the date.
    """
    name = F.regexp_extract(F.col("path"), r"([^/]+)\.zip$", 1)
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path)
            .select(F.regexp_extract(name, r"^(.+)-\d{4}-\d{2}-\d{2}-", 1).alias("feed"),
                    name.alias("version"), F.col("modificationTime").alias("updated_at"),
                    F.col("path"), F.col("content")))


def expand_zips(zips: DataFrame) -> DataFrame:
    """One row per member line: feed, version, member, fields in the order of GTFS_COLUMNS.

    Lines stream out of the zip in batches, columns by name and empty text as missing.
    Unneeded members are never unpacked. A zip without a required member is an error. The
    function is self-contained, so workers need no copy of this package.
    """
    wanted, optional, size = dict(fixed.GTFS_COLUMNS), set(OPTIONAL_FILES), _BATCH

    def member_rows(version: str, content: bytes) -> Iterator[tuple[str, list]]:
        with zipfile.ZipFile(io.BytesIO(content)) as bundle:
            names = set(bundle.namelist())
            for name, columns in wanted.items():
                if f"{name}.txt" not in names:
                    if f"{name}.txt" in optional:
                        continue
                    raise ValueError(f"timetable {version} has no {name}.txt")
                with bundle.open(f"{name}.txt") as handle:
                    lines = csv.reader(io.TextIOWrapper(handle, "utf-8-sig", newline=""))
                    header = {column.strip(): at for at, column in enumerate(next(lines, []))}
                    places = [header.get(column, -1) for column in columns]
                    for row in lines:
                        if row:
                            yield name, [(row[i] or None) if 0 <= i < len(row) else None for i in places]

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frame = lambda rows: pd.DataFrame(rows, columns=["feed", "version", "member", "fields"])
        for batch in batches:
            for feed, version, content in zip(batch["feed"], batch["version"], batch["content"]):
                held: list[tuple] = []
                for name, fields in member_rows(version, content):
                    held.append((feed, version, name, fields))
                    if len(held) == size:
                        yield frame(held)
                        held = []
                if held:
                    yield frame(held)

    return zips.select("feed", "version", "content").mapInPandas(unpack, MEMBER_ROWS)


def member(expanded: DataFrame, name: str) -> DataFrame:
    """One member of every version as named text columns, with feed and version.

    A member that no version ships is an empty frame.
    """
    columns = fixed.GTFS_COLUMNS[name]
    return expanded.where(F.col("member") == name).select(
        "feed", "version", *[F.get("fields", F.lit(i)).alias(c) for i, c in enumerate(columns)])


def land_timetables(zips: DataFrame, path: str) -> None:
    """Add versions to the timetable tables, one table a member; a version already there is replaced.

    Zips are opened once. Tables have named columns, so a reader fetches the ones it needs,
    and files small enough that a big version is read by several tasks.
    """
    spark = zips.sparkSession
    expanded = materialise(expand_zips(zips), "expanded")
    # A row per landed version: also a member that the new copy lacks must not outlive the old one.
    landed = [(row.feed, row.version) for row in zips.select("feed", "version").distinct().collect()]
    for name in fixed.GTFS_COLUMNS:
        for feed, version in landed:
            remove(spark, partition_folder(spark, f"{path}/{name}", feed=feed, version=version))
        (member(expanded, name).hint("rebalance", "feed", "version").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", ROWS_PER_FILE)
         .option("compression", "zstd").partitionBy("feed", "version").parquet(f"{path}/{name}"))


def read_landed(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The timetable tables by member. Feed and version are partitions."""
    def table(name: str) -> DataFrame:
        columns = [*fixed.GTFS_COLUMNS[name], "feed", "version"]
        frame = spark.read.schema(", ".join(f"`{c}` string" for c in columns)).parquet(f"{path}/{name}")
        return frame.select("feed", "version", *fixed.GTFS_COLUMNS[name])

    return {name: table(name) for name in fixed.GTFS_COLUMNS}


def read_folder(spark: SparkSession, path: str, feed: str, version: str) -> dict[str, DataFrame]:
    """One unpacked timetable. All text, columns by name; only calendar_dates and feed_info may be absent."""
    out = {}
    for name, columns in fixed.GTFS_COLUMNS.items():
        try:
            frame = (spark.read.option("header", True).option("encoding", "UTF-8")
                     .csv(f"{path.rstrip('/')}/{name}.txt"))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND" or f"{name}.txt" not in OPTIONAL_FILES:
                raise
            frame = spark.createDataFrame([], ", ".join(f"`{c}` string" for c in columns))
        present = {c.strip(): c for c in frame.columns}
        picked = [F.col(f"`{present[c]}`").alias(c) if c in present
                  else F.lit(None).cast("string").alias(c) for c in columns]
        out[name] = frame.select(F.lit(feed).alias("feed"), F.lit(version).alias("version"), *picked)
    return out


def join_folders(folders: Iterable[dict[str, DataFrame]]) -> dict[str, DataFrame]:
    """Several unpacked timetables as one set of members."""
    out: dict[str, DataFrame] = {}
    for folder in folders:
        for name, frame in folder.items():
            out[name] = out[name].unionByName(frame) if name in out else frame
    return out


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TIMETABLE_VERSIONS).parquet(path)


def listed_versions(manifest: DataFrame) -> DataFrame:
    """One row per version, its newest save. The fetch time falls back to the upload time."""
    saved = F.struct("updated_at", "source_etag", "source_url", "fetched_at", "route_codes", "path")
    newest = manifest.groupBy("feed", "version").agg(
        F.max_by(saved, F.struct("updated_at", "fetched_at", "path")).alias("saved"))
    return newest.select("feed", "version", "saved.*").withColumn(
        "fetched_at", F.coalesce("fetched_at", "updated_at"))
