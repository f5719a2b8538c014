"""The delay metrics every grain shares, and the safe ratios of the daily report.

Everything is read from counted values: a row per group and distinct whole second of delay, with
how many rows have it. Counting merges on the map side, spreads a hot group over tasks by its
values and leaves rows that grow with the spread of the delays, not with the rows of a group.
Quantiles are exact: running sums over the counted values of a group give the values that stand
at the ranks around a level. No buffer holds a group, so none has to be spilled or sorted again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from dwelltime import fixed_values as fixed

DELAY = "delay_seconds"
COUNT = "n"


def counted(rows: DataFrame, keys: Sequence[str], value: str = DELAY) -> DataFrame:
    """How many rows of each group have each value; a missing value is one of them."""
    return rows.groupBy(*keys, value).agg(F.count(F.lit(1)).alias(COUNT))


def merged(counts: DataFrame, keys: Sequence[str], value: str = DELAY) -> DataFrame:
    """Counts of coarser groups from those of finer ones."""
    return counts.groupBy(*keys, value).agg(F.sum(COUNT).alias(COUNT))


def ranked(counts: DataFrame, keys: Sequence[str], value: str = DELAY) -> DataFrame:
    """Counted values with how many present values stand up to each (`upto`), and of how many (`whole`)."""
    group = Window.partitionBy(*keys)
    upto = group.orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = F.when(F.col(value).isNotNull(), F.col(COUNT)).otherwise(0)
    return counts.withColumns({"upto": F.sum(held).over(upto), "whole": F.sum(held).over(group)})


def level(at: float, value: str = DELAY) -> Column:
    """The exact continuous quantile of a group of `ranked` rows, as an aggregate; NULL where nothing is present."""
    place = F.lit(at) * (F.col("whole") - 1)
    stands = lambda rank: F.min(F.when(F.col("upto") > rank, F.col(value)))
    low, high, where = stands(F.floor(place)), stands(F.ceil(place)), F.max(place)
    return F.when(low == high, low.cast("double")).otherwise(
        (F.ceil(where) - where) * low + (where - F.floor(where)) * high)


def share(part: Column, whole: Column) -> Column:
    """Percent of a whole, NULL when the whole is zero. DOUBLE throughout."""
    return F.lit(100.0) * part / F.nullif(whole, F.lit(0))


def share_or_zero(part: Column, whole: Column) -> Column:
    return F.coalesce(share(part, whole), F.lit(0.0))


def whole_seconds(value: Column) -> Column:
    """Rounded half away from zero; interpolation noise is taken off first."""
    return F.round(F.round(value, 6)).cast("int")


def metrics_of(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Scheduled, measured, median, 90th percentile and late share of groups with a measured row.

    `counts` has a row per group and delay, as `counted` and `merged` give them.
    """
    total = lambda condition: F.coalesce(F.sum(F.when(condition, F.col(COUNT))), F.lit(0))
    grouped = ranked(counts, keys).groupBy(*keys).agg(
        F.sum(COUNT).alias("scheduled"), F.max("whole").alias("measured"),
        total(F.col(DELAY) > fixed.LATE_SECONDS).alias("late"),
        level(0.5).alias("median"), level(0.9).alias("ninetieth"))
    return grouped.where(F.col("measured") > 0).select(
        *keys, "scheduled", "measured",
        whole_seconds(F.col("median")).alias("med"), whole_seconds(F.col("ninetieth")).alias("p90"),
        F.round(share(F.col("late"), F.col("measured")), 1).alias("pct5"))


def delay_metrics(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`metrics_of` straight from rows."""
    return metrics_of(counted(rows, keys), keys)
