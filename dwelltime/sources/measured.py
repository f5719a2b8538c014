"""The measured-arrivals table, by service day, as its manifest names them."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from dwelltime.schemas import ARRIVALS
from dwelltime.sinks import day_table


def read_arrivals(spark: SparkSession, path: str,
                  service_dates: Iterable[date] | None = None) -> DataFrame:
    """Every measured day, or the given ones; only their folders are listed."""
    return day_table.read_days(spark, path, ARRIVALS, service_dates)
