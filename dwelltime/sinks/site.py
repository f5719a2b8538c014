"""Writing the site's files. Each run builds a folder of its own; a small file names the one that counts.

Under the site's root lie builds/<run>/ with lines/<agency>/<line>.json, lines_gzip/<agency>/<line>.json.gz,
index.json and status.json, and current.json, which names the run. A page reads current.json first. It is
replaced in one step once a build is whole, so there is always a site, and never half of one.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from dwelltime.operators.documents import PART_ORDER
from dwelltime.sinks.day_table import read_small, write_small
from dwelltime.workspace import remove


def write_lines(parts: DataFrame, path: str, compression: str = "none") -> None:
    """One file per line at agency=<agency>/line=<line>, its parts in order.

    A line's parts meet in one task because they are one file; they stream through sorted,
    and are not gathered. Line breaks between parts are blanks to a JSON reader.
    """
    (parts.repartition("agency", "line")
     .sortWithinPartitions("agency", "line", *PART_ORDER)
     .select("agency", "line", "part")
     .write.mode("overwrite").option("partitionOverwriteMode", "static")
     .option("compression", compression).partitionBy("agency", "line").text(path))


def write_document(document: DataFrame, path: str) -> None:
    """A one-row document as one file."""
    document.select("document").coalesce(1).write.mode("overwrite").text(path)


def write_parts(parts: DataFrame, path: str, order: list[str]) -> None:
    """Parts of one document as one file, in order. They meet in one task because they are one file, and stream
    through it sorted, spilling where they must."""
    parts.coalesce(1).sortWithinPartitions(*order).select("part").write.mode("overwrite").text(path)


def _part(files, folder):
    """The one data file of a folder a writer has filled."""
    found = [entry.getPath() for entry in files.listStatus(folder) if entry.getPath().getName().startswith("part-")]
    if len(found) != 1:
        raise RuntimeError(f"{folder} holds {len(found)} files where one was written")
    return found[0]


def _move(files, source, target) -> None:
    if not files.rename(source, target):
        raise RuntimeError(f"{source} could not be moved to {target}")


def new_build(out: str) -> str:
    """Where a run puts its parts before `publish`."""
    return f"{out.rstrip('/')}/builds/{uuid.uuid4().hex}-parts"


def live(spark: SparkSession, out: str) -> str | None:
    """The folder of the build that counts, None before the first."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{out.rstrip('/')}/current.json")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    return f"{out.rstrip('/')}/builds/{json.loads(read_small(spark, str(path)))['build']}"


def _switch(spark: SparkSession, out: str, build: str) -> None:
    """current.json replaced in one step."""
    jvm, beside = spark._jvm, f"{out}/current.{build}.tmp"
    write_small(spark, beside, json.dumps({"build": build}))
    replace = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    replace[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    source, target = jvm.org.apache.hadoop.fs.Path(beside), jvm.org.apache.hadoop.fs.Path(f"{out}/current.json")
    qualified = source.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(source)
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(qualified.toUri(), spark._jsc.hadoopConfiguration()).rename(
        source, target, replace)


def publish(spark: SparkSession, built: str, out: str) -> str:
    """Give the files under `built` their addresses in a build of its own, name it, and return its folder.

    There is a file a line, so the renames are few. Afterwards this build and the one before are kept, for
    pages that have just read its name; what other runs have left, broken ones too, goes.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    out, before, build = out.rstrip("/"), live(spark, out), uuid.uuid4().hex
    files, ready = path(built).getFileSystem(spark._jsc.hadoopConfiguration()), f"{out}/builds/{build}"
    files.mkdirs(path(ready))
    for tree, ending in (("lines", ".json"), ("lines_gzip", ".json.gz")):
        if not files.exists(path(f"{built}/{tree}")):
            continue
        for agency in files.globStatus(path(f"{built}/{tree}/agency=*")):
            target = f"{ready}/{tree}/{agency.getPath().getName().partition('=')[2]}"
            files.mkdirs(path(target))
            for line in files.globStatus(path(agency.getPath(), "line=*")):
                name = line.getPath().getName().partition("=")[2]
                _move(files, _part(files, line.getPath()), path(f"{target}/{name}{ending}"))
    for name in ("index", "status"):
        _move(files, _part(files, path(f"{built}/{name}")), path(f"{ready}/{name}.json"))
    _switch(spark, out, build)
    kept = {build, before.rpartition("/")[2] if before else build}
    for held in files.listStatus(path(f"{out}/builds")):
        if held.getPath().getName() not in kept:
            remove(spark, held.getPath().toString())
    return ready
