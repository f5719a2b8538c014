"""Tables of days in committed snapshots: written beside, then switched by a manifest.

A day's rows lie under service_date=<day>/snapshot=<run>. A manifest is one small JSON file that
names each day's snapshot; manifests are numbered and only the newest counts. A writer adds
folders nobody knows of, then the next manifest in one rename, so a reader sees a run's days all
or not at all, and a run that dies leaves what was there. A manifest holds a line a day. Superseded snapshots stay while
one of the newest manifests names them, for readers that have just resolved theirs.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from dwelltime.workspace import remove

DAY, SNAPSHOT = "service_date", "snapshot"
KEPT_MANIFESTS = 2


class Conflict(RuntimeError):
    """Another writer has committed meanwhile; nothing of this run is visible."""


@dataclass(frozen=True)
class Entry:
    """The folder that holds a day, and the snapshot of another table it was made from, if any."""

    snapshot: str
    source: str | None = None


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration())


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """A small file whole or not at all; an existing one is a Conflict."""
    files, beside = _files(spark, path), f"{path}.{uuid.uuid4().hex}.tmp"
    out = files.create(_path(spark, beside), False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if files.exists(_path(spark, path)) or not files.rename(_path(spark, beside), _path(spark, path)):
        files.delete(_path(spark, beside), False)
        raise Conflict(f"{path} is there already")


def read_small(spark: SparkSession, path: str) -> str:
    stream = _files(spark, path).open(_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def numbered(spark: SparkSession, folder: str) -> dict[int, str]:
    """The numbered JSON files of a folder by number, oldest first."""
    files = _files(spark, folder)
    if not files.exists(_path(spark, folder)):
        return {}
    names = [status.getPath().getName() for status in files.listStatus(_path(spark, folder))]
    return {int(name[:-5]): f"{folder}/{name}" for name in sorted(names)
            if name.endswith(".json") and name[:-5].isdigit()}


def _manifests(path: str) -> str:
    return f"{path.rstrip('/')}/_manifest"


def _parsed(spark: SparkSession, manifest: str) -> dict[date, Entry]:
    days = json.loads(read_small(spark, manifest))["days"]
    return {date.fromisoformat(day): Entry(**held) for day, held in days.items()}


def entries(spark: SparkSession, path: str) -> dict[date, Entry]:
    """The committed days; empty where nothing has been committed."""
    known = numbered(spark, _manifests(path))
    return _parsed(spark, known[max(known)]) if known else {}


def folder(path: str, day: date, entry: Entry) -> str:
    return f"{path.rstrip('/')}/{DAY}={day}/{SNAPSHOT}={entry.snapshot}"


def commit(spark: SparkSession, path: str, changes: Mapping[date, Entry | None]) -> None:
    """The next manifest: the newest with these days replaced, None for a day that goes."""
    known = numbered(spark, _manifests(path))
    days = _parsed(spark, known[max(known)]) if known else {}
    days = {day: entry for day, entry in {**days, **changes}.items() if entry is not None}
    spelled = {str(day): {"snapshot": entry.snapshot, "source": entry.source} for day, entry in sorted(days.items())}
    number = max(known, default=0) + 1
    write_small(spark, f"{_manifests(path)}/{number:012d}.json", json.dumps({"days": spelled}))
    _expire(spark, path)


def _expire(spark: SparkSession, path: str) -> None:
    """Remove what only manifests older than the newest few name, and these manifests."""
    known = list(numbered(spark, _manifests(path)).values())
    old, new = known[:-KEPT_MANIFESTS], known[-KEPT_MANIFESTS:]
    if not old:
        return
    held = {folder(path, day, entry) for manifest in new for day, entry in _parsed(spark, manifest).items()}
    for manifest in old:
        for day, entry in _parsed(spark, manifest).items():
            if folder(path, day, entry) not in held:
                remove(spark, folder(path, day, entry))
        remove(spark, manifest)


def write_days(frame: DataFrame, path: str, days: Iterable[date] = (),
               sources: Mapping[date, str] | None = None, order: Iterable[str] = ()) -> dict[date, Entry]:
    """Replace the days present in `frame` and the given ones; a given day without rows ends up empty.

    Rebalancing sizes the files at run time: an ordinary day is one file, a crowded day is split
    over tasks. Rows are sorted within files, which is what makes them compress.
    """
    spark, path, run = frame.sparkSession, path.rstrip("/"), uuid.uuid4().hex
    (frame.withColumn(SNAPSHOT, F.lit(run)).hint("rebalance", DAY)
     .sortWithinPartitions(DAY, *order)
     .write.mode("append").option("compression", "zstd").partitionBy(DAY, SNAPSHOT).parquet(path))
    # A folder a written day.
    found = _files(spark, path).globStatus(_path(spark, f"{path}/{DAY}=*/{SNAPSHOT}={run}"))
    written = {date.fromisoformat(status.getPath().getParent().getName().partition("=")[2]) for status in found or []}
    sources = sources or {}
    changes = dict.fromkeys(days) | {day: Entry(run, sources.get(day)) for day in written}
    commit(spark, path, changes)
    return changes


def read_entries(spark: SparkSession, path: str, schema: T.StructType, wanted: Iterable[tuple[date, Entry]]) -> DataFrame:
    """The rows of the given days and snapshots, each folder read by its own path."""
    folders = [folder(path, day, entry) for day, entry in sorted(wanted, key=lambda pair: pair[0])]
    if not folders:
        return spark.createDataFrame([], schema)
    leaves = T.StructType([*schema.fields, T.StructField(SNAPSHOT, T.StringType())])
    return spark.read.schema(leaves).option("basePath", path).parquet(*folders).select(*schema.names)


def read_days(spark: SparkSession, path: str, schema: T.StructType, days: Iterable[date] | None = None) -> DataFrame:
    """Every committed day, or the given ones."""
    known = entries(spark, path)
    asked = known if days is None else set(days)
    return read_entries(spark, path, schema, [(day, entry) for day, entry in known.items() if day in asked])


def live_folders(spark: SparkSession, path: str) -> list[str]:
    return [folder(path, day, entry) for day, entry in entries(spark, path).items()]
