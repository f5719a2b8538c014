"""The record job: one stream of spool lines, every output of it by batch number.

A batch archives its lines, sets aside the unreadable ones, tallies records per interval and feed,
and raises alarms. Nothing is lost: a line is archived or set aside, and a record that comes after
its interval was closed is tallied as late. Interval counts add up, so tally and late rows together
are the batch tally of all lines, in whatever order they came.

Each output is a partition a batch, overwritten when a batch is run again, so a replay changes
nothing. What a batch needs of the one before (how far time had come, the counts of open intervals
and the feeds' counters) is a few rows under its number; older state is dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from dwelltime import fixed_values as fixed
from dwelltime.functions import clock
from dwelltime.operators import monitoring
from dwelltime.streaming import batches
from dwelltime.streaming.landing import received_at
from dwelltime.workspace import materialise

COUNTED = "interval timestamp, agency string, records long, late boolean"
ALARMS = "interval timestamp, agency string, records long, silent int"
UNREADABLE = "value string, file_name string, reason string"
MARK = "seen timestamp"
OPEN = "interval timestamp, agency string, records long"
COUNTERS = "agency string, silent int"


def read_lines(lines: DataFrame) -> DataFrame:
    """value, file_name, received_at, agency, and why a line can't be taken in, NULL for a good one."""
    told = lines.select("value", "file_name", received_at(F.col("value")).alias("received_at"),
                        F.get_json_object("value", "$.agency").alias("agency"))
    return told.withColumn("reason", F.when(F.get_json_object("value", "$").isNull(), "not JSON")
                           .when(F.col("received_at").isNull(), "no receive time")
                           .when(F.col("agency").isNull(), "no feed"))


def _archive(good: DataFrame, path: str, batch: int) -> None:
    """Lines as they came, by UTC day and hour; the batch is a folder below, so a replay rewrites its own files."""
    placed = good.select(
        "value", clock.utc_day(F.col("received_at")).alias("dt"),
        F.lpad(clock.utc_hour(F.col("received_at")).cast("string"), 2, "0").alias("hh"), F.lit(batch).alias("batch"))
    (placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "gzip")
     .partitionBy("dt", "hh", "batch").text(path))


def take_batch(lines: DataFrame, batch: int, out: str, agencies: Sequence[str], interval: str, lateness: str,
               threshold: int) -> None:
    """All outputs of one batch of (value, file_name)."""
    spark = lines.sparkSession
    told = materialise(read_lines(lines), "record")
    good, bad = told.where("reason IS NULL"), told.where("reason IS NOT NULL")
    _archive(good, f"{out}/archive", batch)
    batches.replace(bad.select("value", "file_name", "reason"), f"{out}/unreadable", batch)

    # Time only moves on between batches: what one batch has seen closes intervals for the next.
    seen = batches.read(spark, f"{out}/mark", MARK, batch - 1)
    before = seen.first()
    behind = F.expr(f"INTERVAL {lateness}")
    ends = F.col("interval") + F.expr(f"INTERVAL {interval}")
    closed_before = F.lit(before.seen if before else None).cast("timestamp") - behind
    tally = monitoring.interval_tally(good, F.col("received_at"), interval).withColumn(
        "late", F.coalesce(ends <= closed_before, F.lit(False)))
    batches.replace(tally, f"{out}/tally", batch)
    tally = batches.read(spark, f"{out}/tally", COUNTED, batch)
    batches.replace(good.agg(F.max("received_at").alias("seen")).unionByName(seen).agg(F.max("seen").alias("seen"))
                    .where("seen IS NOT NULL"), f"{out}/mark", batch)

    now = batches.read(spark, f"{out}/mark", MARK, batch).first()
    closes = F.coalesce(ends <= F.lit(now.seen if now else None).cast("timestamp") - behind, F.lit(False))
    pending = batches.read(spark, f"{out}/open", OPEN, batch - 1).unionByName(
        tally.where("NOT late").drop("late")).groupBy("interval", "agency").agg(F.sum("records").alias("records"))
    pending = materialise(pending, "pending")
    batches.replace(pending.where(~closes), f"{out}/open", batch)

    carried = batches.read(spark, f"{out}/counters", COUNTERS, batch - 1)
    silent = materialise(monitoring.silence(pending.where(closes), agencies, carried), "silence")
    after = monitoring.counters(silent).select("agency", F.col("silent").alias("now"))
    batches.replace(carried.join(after, "agency", "full_outer").select(
        "agency", F.coalesce("now", "silent").alias("silent")), f"{out}/counters", batch)
    batches.replace(silent.where(F.col("silent") >= threshold), f"{out}/alarms", batch)
    for state in ("mark", "open", "counters"):
        # The batch before is still needed, should this one be run again.
        batches.forget(spark, f"{out}/{state}", batch - 2)


def start_record(lines: DataFrame, out: str, checkpoint: str, agencies: Sequence[str],
                 interval: str = f"{fixed.INTERVAL_MINUTES} minutes", lateness: str = "10 minutes",
                 threshold: int = fixed.SILENT_INTERVALS, once: bool = False) -> StreamingQuery:
    """Run the job on a stream of (value, file_name) spool lines."""
    def handle(batch_lines: DataFrame, batch: int) -> None:
        take_batch(batch_lines, batch, out, agencies, interval, lateness, threshold)

    writer = lines.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once
            else writer.trigger(processingTime=f"{fixed.INTERVAL_MINUTES} minutes")).start()


def tally(spark: SparkSession, out: str, late: bool | None = None) -> DataFrame:
    """Records per interval and feed so far: all, or only those that came in time, or only late ones."""
    rows = batches.every(spark, f"{out}/tally", COUNTED)
    rows = rows if late is None else rows.where(F.col("late") == late)
    return rows.groupBy("interval", "agency").agg(F.sum("records").alias("records"))


def alarms(spark: SparkSession, out: str) -> DataFrame:
    """Alarms raised so far, of closed intervals."""
    return batches.every(spark, f"{out}/alarms", ALARMS).drop("batch")


def unreadable(spark: SparkSession, out: str) -> DataFrame:
    return batches.every(spark, f"{out}/unreadable", UNREADABLE)
