"""Which services run on which day: weekly pattern, then dated exceptions."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, functions as F

from dwelltime.functions import clock

KEYS = ["feed", "version", "service_date", "service_id"]


def _unbroken(days: Sequence[date]) -> bool:
    return len(set(days)) > (max(days) - min(days)).days


def _patterned(calendar: DataFrame, days: Sequence[date]) -> DataFrame:
    """Calendar rows spread over the wanted days inside their range whose weekday flag is set.

    Each row generates its own days, clipped to the wanted span, so no row meets a day it
    does not cover. Range ends are compared as text, as timetables spell them.
    """
    low, high = F.lit(min(days)), F.lit(max(days))
    starts = F.greatest(F.coalesce(clock.service_date(F.col("start_date")), low), low)
    ends = F.least(F.coalesce(clock.service_date(F.col("end_date")), high), high)
    span = F.when(starts <= ends, F.sequence(starts, ends))
    spread = calendar.select("*", F.explode(span).alias("service_date"))
    if not _unbroken(days):
        spread = spread.where(F.col("service_date").isin(list(days)))
    text = clock.compact_date(F.col("service_date"))
    return spread.where(
        (F.col("start_date") <= text) & (text <= F.col("end_date"))
        & (clock.weekday_flag(F.col("service_date")) == "1"))


def _votes(calendar: DataFrame, exceptions: DataFrame, days: Sequence[date]) -> DataFrame:
    """One row per service and day any source mentions: patterned, added, removed."""
    spelled = [f"{day:%Y%m%d}" for day in (sorted(days) if not _unbroken(days) else (min(days), max(days)))]
    named = F.col("date").between(*spelled) if _unbroken(days) else F.col("date").isin(spelled)
    dated = (exceptions.where(named & F.col("exception_type").isin("1", "2"))
             .withColumn("service_date", clock.service_date(F.col("date")))
             .where(F.col("service_date").isNotNull()))
    mentions = _patterned(calendar, days).select(
        *KEYS, F.lit(True).alias("patterned"), F.lit(False).alias("added"), F.lit(False).alias("removed")
    ).unionByName(dated.select(
        *KEYS, F.lit(False).alias("patterned"), (F.col("exception_type") == "1").alias("added"),
        (F.col("exception_type") == "2").alias("removed")))
    return mentions.groupBy(*KEYS).agg(
        *[F.bool_or(name).alias(name) for name in ("patterned", "added", "removed")])


def running_services(calendar: DataFrame, exceptions: DataFrame, days: Sequence[date]) -> DataFrame:
    """Services running on each wanted day, one row each: (pattern or added) and not removed.

    Added and removed on one day counts as removed. One grouping stands for the union, the
    distinct and the anti-join.
    """
    return (_votes(calendar, exceptions, days)
            .where((F.col("patterned") | F.col("added")) & ~F.col("removed")).select(*KEYS))


def contradicting_exceptions(calendar: DataFrame, exceptions: DataFrame,
                             days: Sequence[date]) -> DataFrame:
    """Services both added and removed on the same day."""
    return _votes(calendar, exceptions, days).where("added AND removed").select(*KEYS)
