"""Feed monitoring: records per interval and feed, and feeds gone silent while others deliver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from dwelltime import fixed_values as fixed
from dwelltime.functions import clock


def interval_tally(records: DataFrame, moment: Column, interval: str) -> DataFrame:
    """Records per interval and feed. Intervals in which nothing arrived leave no row.

    Works on a batch and, behind a watermark, on a stream.
    """
    return (records.groupBy(F.window(moment, interval).alias("window"), "agency")
            .agg(F.count(F.lit(1)).alias("records"))
            .select(F.col("window.start").alias("interval"), "agency", "records"))


def feed_grid(tallies: DataFrame, agencies: Sequence[str]) -> DataFrame:
    """A row per interval that had anything and feed, with 0 where the feed had nothing."""
    per_feed = F.array(*[
        F.struct(F.lit(name).alias("agency"),
                 F.coalesce(F.sum(F.when(F.col("agency") == name, F.col("records"))), F.lit(0)).alias("records"))
        for name in agencies])
    return tallies.groupBy("interval").agg(per_feed.alias("feeds")).select("interval", F.inline("feeds"))


def silence(tallies: DataFrame, agencies: Sequence[str], carried: DataFrame | None = None) -> DataFrame:
    """How many intervals in a row each feed has been silent, at every interval that had anything.

    An interval in which no feed delivered is not there and counts for nobody. `carried`
    continues the counters of an earlier stretch.

    A prefix scan in two steps. Intervals are numbered within segments, a feed's UTC days; the sizes
    and last deliveries of earlier segments, a row a day, are carried back into each. So a window
    holds a day of a feed, however long its history is.
    """
    grid = feed_grid(tallies, agencies).withColumn("segment", clock.utc_day(F.col("interval")))
    inside = Window.partitionBy("agency", "segment").orderBy("interval")
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = grid.withColumn("place", F.row_number().over(inside).cast("long"))
    delivers = F.when(F.col("records") > 0, F.col("place"))
    placed = placed.withColumn("delivered", F.max(delivers).over(so_far))

    segments = placed.groupBy("agency", "segment").agg(
        F.max("place").alias("size"), F.max("delivered").alias("last"))
    earlier = Window.partitionBy("agency").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    segments = segments.withColumn("start", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
    segments = segments.select("agency", "segment", "start", F.max(
        F.col("start") + F.col("last")).over(earlier).alias("delivered_before"))
    counted = placed.join(segments, ["agency", "segment"])
    if carried is None:
        before = F.lit(0)
    else:
        counted = counted.join(carried.select("agency", F.col("silent").alias("before")), "agency", "left")
        before = F.coalesce("before", F.lit(0))
    place = F.col("start") + F.col("place")
    since = F.coalesce(F.col("start") + F.col("delivered"), F.col("delivered_before"))
    silent = F.when(since.isNull(), place + before).otherwise(place - since)
    return counted.select("interval", "agency", "records", silent.cast("int").alias("silent"))


def stalled_feeds(tallies: DataFrame, agencies: Sequence[str], threshold: int = fixed.SILENT_INTERVALS,
                  carried: DataFrame | None = None) -> DataFrame:
    """Feeds silent for `threshold` delivering intervals or more."""
    return silence(tallies, agencies, carried).where(F.col("silent") >= threshold)


def counters(silent: DataFrame) -> DataFrame:
    """Each feed's counter after the last interval, to carry on with."""
    return silent.groupBy("agency").agg(F.max_by("silent", "interval").alias("silent"))
