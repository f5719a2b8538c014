"""The position archive: gzipped JSON lines under dt=YYYY-MM-DD/hh=HH, UTC."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from dwelltime.functions import clock
from dwelltime.schemas import POSITION

CORRUPT = "_corrupt"
_PARTITIONS = [T.StructField("dt", T.DateType()), T.StructField("hh", T.IntegerType())]


def archive_days(service_dates: Iterable[date]) -> list[date]:
    """UTC days that can hold records of the given service days: each day and its neighbours.

    A service day is local, so about a third of its records sit in the next UTC day.
    """
    near = {day + timedelta(days=shift) for day in service_dates for shift in (-1, 0, 1)}
    return sorted(near)


def _archive_folders(spark: SparkSession, root: str, days: list[date] | None, read) -> DataFrame:
    """`read(base, path)` of the partitions the days need, of whichever layout is there; none is an error."""
    spelled = "*" if days is None else "{" + ",".join(str(day) for day in days) + "}"
    for base in (root, f"{root}/vehicle_positions"):
        try:
            return read(base, f"{base}/dt={spelled}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    raise FileNotFoundError(f"no raw files under {root} for {spelled}")


def _needed_days(service_dates: Iterable[date] | None) -> list[date] | None:
    days = archive_days(service_dates) if service_dates is not None else None
    if days is not None and not days:
        raise ValueError("no service days given")
    return days


def read_positions(spark: SparkSession, root: str, service_dates: Iterable[date] | None = None,
                   keep_corrupt: bool = False, committed_only: bool = False) -> DataFrame:
    """Typed records of the archive, only from the partitions the service days need.

    Only those partitions are listed. `committed_only` lists through the landing stream's
    commit log instead, which hides files of failed batches. `keep_corrupt` adds the text of
    lines that are no JSON as `_corrupt`. No matching files is an error.
    """
    leaves = list(POSITION.fields) + _PARTITIONS
    if keep_corrupt:
        leaves.append(T.StructField(CORRUPT, T.StringType()))
    reader = (spark.read.schema(T.StructType(leaves))
              .option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", CORRUPT))
    root, days = root.rstrip("/"), _needed_days(service_dates)
    if committed_only:
        frame = reader.json(root)
    else:
        reader = reader.option("pathGlobFilter", "*.gz")
        frame = _archive_folders(spark, root, days, lambda base, path: reader.option("basePath", base).json(path))
    return frame if days is None else frame.where(F.col("dt").isin(days))


def read_lines(spark: SparkSession, root: str, service_dates: Iterable[date] | None = None,
               committed_only: bool = False) -> DataFrame:
    """The archive's lines as they are, with dt and hh, from the partitions the service days need."""
    reader = spark.read.schema(T.StructType([T.StructField("value", T.StringType()), *_PARTITIONS]))
    root, days = root.rstrip("/"), _needed_days(service_dates)
    if committed_only:
        frame = reader.text(root)
    else:
        reader = reader.option("pathGlobFilter", "*.gz")
        frame = _archive_folders(spark, root, days, lambda base, path: reader.option("basePath", base).text(path))
    return frame if days is None else frame.where(F.col("dt").isin(days))


_STAMP = '"startDate":"'


def stamped_day(line: Column) -> Column:
    """The service day a line is plainly stamped with; NULL unless it is a whole object with one such stamp.

    A test on text that costs a fraction of parsing. Blanks around the colon, escapes, a second
    stamp, a cut line: all give NULL, and only parsing can tell.
    """
    at = F.locate(_STAMP, line)
    text = F.substr(line, at + len(_STAMP), F.lit(11))
    day = F.when(F.substring(text, 9, 1) == '"', F.substring(text, 1, 8)).when(
        F.substring(text, 11, 1) == '"', F.substring(text, 1, 10))
    whole = line.startswith("{") & line.endswith("}") & (at > 0)
    once = F.length(F.replace(line, F.lit(_STAMP))) == F.length(line) - len(_STAMP)
    return F.when(whole & once, clock.service_date(day))


def read_day_records(spark: SparkSession, root: str, service_dates: Iterable[date],
                     committed_only: bool = False) -> DataFrame:
    """`read_positions` with `keep_corrupt`, without the lines that are plainly another day's.

    About a third of three UTC days belongs to the service days around the one asked for. Those lines
    leave on their stamp before any is parsed; what can't be told by it is parsed. So a run answers
    for its own days: a damaged line that is stamped counts in the run of its day, an unstamped one
    in every run that meets it.
    """
    days = list(service_dates)
    lines = read_lines(spark, root, days, committed_only)
    theirs = stamped_day(F.col("value"))
    kept = lines.where((F.trim("value") != "") & (theirs.isNull() | theirs.isin(days)))
    schema = T.StructType([*POSITION.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return kept.select(parsed.alias("record"), "dt", "hh").select("record.*", "dt", "hh")


def _leaf(path: str) -> Column:
    return F.col(f"payload.vehicle.{path}")


def _whole(text: Column, kind: str) -> Column:
    """A whole number from `12`, ` 12` or `12.0`."""
    return F.coalesce(text.try_cast(kind), F.round(text.try_cast("double")).try_cast(kind))


def _fields(strict: bool) -> list[Column]:
    number = (lambda text, kind: text.cast(kind)) if strict else _whole
    return [
        clock.service_date(_leaf("trip.startDate")).alias("service_date"),
        F.col("agency"),
        _leaf("trip.tripId").alias("trip_id"),
        _leaf("currentStatus").alias("status"),
        number(_leaf("currentStopSequence"), "int").alias("stop_sequence"),
        _leaf("stopId").alias("stop_id"),
        number(_leaf("timestamp"), "bigint").alias("ts"),
    ]


def observations(positions: DataFrame, service_dates: Iterable[date] | None = None,
                 strict: bool = False) -> DataFrame:
    """Records of the service days that name a trip, a stop sequence and a time.

    The day a record belongs to is the one stamped on it, not its partition. Status and
    stop id may be missing. `strict` fails on a number that is none; otherwise such a record
    is left out here and shows up in `quarantine`.
    """
    kept = positions
    if service_dates is not None:
        # Compared as text, both spellings, so rows of other days leave before any parsing.
        days = list(service_dates)
        spelled = [f"{day:%Y%m%d}" for day in days] + [str(day) for day in days]
        kept = kept.where(_leaf("trip.startDate").isin(spelled))
    return kept.select(*_fields(strict)).where(
        F.col("service_date").isNotNull() & F.col("trip_id").isNotNull()
        & F.col("stop_sequence").isNotNull() & F.col("ts").isNotNull())


def problem() -> Column:
    """What keeps a record from being read, NULL for a good one."""
    unread = lambda text, value: text.isNotNull() & value.isNull()
    day, sequence, stamp = (_leaf(p) for p in ("trip.startDate", "currentStopSequence", "timestamp"))
    return (
        F.when(F.col(CORRUPT).isNotNull(), "not JSON")
        .when(unread(day, clock.service_date(day)), "bad startDate")
        .when(unread(sequence, _whole(sequence, "int")), "bad currentStopSequence")
        .when(unread(stamp, _whole(stamp, "bigint")), "bad timestamp"))


def quarantine(positions: DataFrame) -> DataFrame:
    """Lines that are no JSON, and records with a number or date that cannot be read."""
    day, sequence, stamp = (_leaf(p) for p in ("trip.startDate", "currentStopSequence", "timestamp"))
    return (positions.withColumn("reason", problem()).where("reason IS NOT NULL")
            .select("dt", "hh", "agency", "reason", F.col(CORRUPT).alias("line"),
                    day.alias("start_date"), sequence.alias("sequence"), stamp.alias("stamp")))


def file_tally(positions: DataFrame) -> DataFrame:
    """Records per feed in each archive file."""
    return (positions.select(F.col("_metadata.file_name").alias("file_name"), "agency")
            .groupBy("file_name", "agency").agg(F.count(F.lit(1)).alias("records")))


def write_bronze(observed: DataFrame, path: str) -> None:
    """Keep parsed records as Parquet by their own service day, for repeated backfills.

    One later read then touches one partition a day and parses no JSON. Rebalancing splits a
    crowded day over many files and merges thin ones.
    """
    (observed.hint("rebalance", "service_date")
     .sortWithinPartitions("service_date", "agency", "trip_id", "stop_sequence")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("compression", "zstd").partitionBy("service_date").parquet(path))


def read_bronze(spark: SparkSession, path: str,
                service_dates: Iterable[date] | None = None) -> DataFrame:
    frame = spark.read.parquet(path)
    return frame if service_dates is None else frame.where(
        F.col("service_date").isin(list(service_dates)))
