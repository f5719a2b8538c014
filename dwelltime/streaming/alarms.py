"""Tallies per interval behind a watermark, and alarms for feeds gone silent, from state a feed keeps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from dwelltime import fixed_values as fixed
from dwelltime.operators import monitoring

SILENCE = "interval timestamp, agency string, records long, silent int"
STATE_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def feed_tally(received: DataFrame, interval: str = f"{fixed.INTERVAL_MINUTES} minutes",
               lateness: str = "10 minutes") -> DataFrame:
    """Records per interval and feed of a (received_at, agency) stream, each interval once.

    What comes later than the watermark is not in it; the record job tallies that as well.
    """
    watched = received.withWatermark("received_at", lateness)
    return monitoring.interval_tally(watched, F.col("received_at"), interval)


def feed_grid(received: DataFrame, agencies: Sequence[str], interval: str = f"{fixed.INTERVAL_MINUTES} minutes",
              lateness: str = "10 minutes") -> DataFrame:
    """A row per closed interval and feed, 0 where the feed had nothing while another had something."""
    counts = F.array(*[F.struct(F.lit(name).alias("agency"), F.count_if(F.col("agency") == name).alias("records"))
                       for name in agencies])
    grouped = (received.withWatermark("received_at", lateness)
               .groupBy(F.window("received_at", interval).alias("window")).agg(counts.alias("feeds")))
    return grouped.select(F.window_time("window").alias("closes"), F.col("window.start").alias("interval"),
                          F.inline("feeds"))


def open_records(received: DataFrame, closed: DataFrame, interval: str) -> DataFrame:
    """The (received_at, agency) records of intervals the watermark hasn't closed, of a batch read.

    Where a stream is stopped for good, their tally completes what it has emitted.
    """
    last = closed.agg(F.max("interval").alias("last"))
    after = F.col("last").isNull() | (F.col("received_at") >= F.col("last") + F.expr(f"INTERVAL {interval}"))
    return received.join(F.broadcast(last)).where(after).drop("last")


def _silence_processor(expires_ms: int):
    """The state of a feed: how many intervals it has been silent. Defined here so that workers need no package."""
    import pandas as pd
    from pyspark.sql.streaming import StatefulProcessor

    class Silence(StatefulProcessor):
        def init(self, handle):
            self.handle = handle
            self.counter = handle.getValueState("silent", "silent int")

        def handleInputRows(self, key, rows, timerValues):
            grid = pd.concat(list(rows)).sort_values("interval")
            silent, told = self.counter.get()[0] if self.counter.exists() else 0, []
            for records in grid["records"]:
                silent = 0 if records else silent + 1
                told.append(silent)
            self.counter.update((silent,))
            # One timer a feed: a feed that is in no interval for so long, being configured no more, is forgotten.
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(int(grid["closes"].max().timestamp() * 1000) + expires_ms)
            yield pd.DataFrame({"interval": grid["interval"], "agency": key[0], "records": grid["records"],
                                "silent": pd.array(told, "int32")})

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            self.counter.clear()
            return iter([])

        def close(self):
            pass

    return Silence()


def silence(grid: DataFrame, expires_hours: int = 72) -> DataFrame:
    """How many intervals in a row each feed has been silent, at every row of a streamed `feed_grid`.

    A feed's counter lives in the state store, its timer in event time. Needs a state store that
    keeps several values a key.
    """
    grid.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_PROVIDER)
    return grid.groupBy("agency").transformWithStateInPandas(
        _silence_processor(expires_hours * 3_600_000), SILENCE, "Append", "EventTime")


def start_silence(grid: DataFrame, out: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Append every feed's silence at each closed interval to `out`, exactly once; alarms are a filter of it."""
    writer = (silence(grid).writeStream.format("parquet").option("path", out)
              .option("checkpointLocation", checkpoint).outputMode("append"))
    return (writer.trigger(availableNow=True) if once
            else writer.trigger(processingTime=f"{fixed.INTERVAL_MINUTES} minutes")).start()


def alarms_of(silence_rows: DataFrame, threshold: int = fixed.SILENT_INTERVALS) -> DataFrame:
    return silence_rows.where(F.col("silent") >= threshold)
