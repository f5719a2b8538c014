"""Lands raw messages in the archive layout, byte for byte."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from dwelltime.functions import clock, text


def envelope(received_at: Column, agency: Column, payload: Column) -> Column:
    """One archive line. The payload is spliced in as text and never re-encoded."""
    return F.concat(F.lit('{"received_at":"'), clock.iso_stamp(received_at), F.lit('","agency":"'),
                    agency, F.lit('","payload":'), payload, F.lit("}"))


def spool_lines(spark: SparkSession, spool: str) -> DataFrame:
    """A stream of finished spool files: one row per line, with the name of its file."""
    return (spark.readStream.format("text").option("pathGlobFilter", "*.gz").load(spool)
            .select("value", F.col("_metadata.file_name").alias("file_name")))


def placed_lines(lines: DataFrame) -> DataFrame:
    """Lines with the partition their file name calls for, NULL where the name is no archive name."""
    return lines.select(
        "value", "file_name", text.archive_day(F.col("file_name")).alias("dt"),
        F.lpad(text.archive_hour(F.col("file_name")).cast("string"), 2, "0").alias("hh"))


def messages(lines: DataFrame) -> DataFrame:
    """Receive time and feed of each line; the payload is not parsed."""
    return (lines.select(received_at(F.col("value")).alias("received_at"),
                         F.get_json_object("value", "$.agency").alias("agency"))
            .where("received_at IS NOT NULL AND agency IS NOT NULL"))


def received_at(line: Column) -> Column:
    return clock.iso_instant(F.get_json_object(line, "$.received_at"))


def enveloped(raw: DataFrame) -> DataFrame:
    """Archive lines from (received_at, agency, payload) rows, placed by their receive time."""
    return raw.select(
        envelope(F.col("received_at"), F.col("agency"), F.col("payload")).alias("value"),
        clock.utc_day(F.col("received_at")).alias("dt"),
        F.lpad(clock.utc_hour(F.col("received_at")).cast("string"), 2, "0").alias("hh"))


def start_landing(placed: DataFrame, archive: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Append placed lines to dt=/hh= partitions, gzipped, each exactly once.

    Read the result with `committed_only=True`: the sink's own log then decides what counts.
    """
    writer = (placed.where("dt IS NOT NULL").select("value", "dt", "hh").writeStream
              .format("text").option("compression", "gzip").partitionBy("dt", "hh")
              .option("path", archive).option("checkpointLocation", checkpoint)
              .outputMode("append"))
    return (writer.trigger(availableNow=True) if once
            else writer.trigger(processingTime="1 minute")).start()


def start_quarantine(placed: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Keep lines of files whose name says no partition, with that name."""
    writer = (placed.where("dt IS NULL").select("value", "file_name").writeStream
              .format("parquet").option("path", path).option("checkpointLocation", checkpoint)
              .outputMode("append"))
    return (writer.trigger(availableNow=True) if once
            else writer.trigger(processingTime="1 minute")).start()
