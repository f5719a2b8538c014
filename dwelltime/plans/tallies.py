"""The counted form of all measured days, kept from run to run so that a new day reads one day.

days/ is a table of days with each day's histogram; an entry says from which snapshot of the arrivals
it was counted, so days that were measured anew since are known without reading them. total/ holds the
sum of all days and names the snapshots in it. Counts can be added and taken away: a new, replaced or
vanished day leaves its own rows beside the total as a change, and the rest of the days is not read again.
Changes are added when the total is read, and go into a new total once they name half as many days as it.
"""

from __future__ import annotations

import json
import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from dwelltime import fixed_values as fixed
from dwelltime.network import Network
from dwelltime.operators import grains
from dwelltime.schemas import ARRIVALS, HISTOGRAM, TALLIES
from dwelltime.sinks import day_table
from dwelltime.sinks.day_table import Entry
from dwelltime.workspace import exists, remove

ORDER = ["grain", "agency", "line", "direction_id"]
MOST_CHANGES = 8


def count_days(spark: SparkSession, arrivals: str, tallies: str, zone: str) -> list[date]:
    """Count the days that are new, replaced or gone since the last time; returns them."""
    live, counted = day_table.entries(spark, arrivals), day_table.entries(spark, f"{tallies}/days")
    stale = sorted(day for day, entry in live.items() if day not in counted or counted[day].source != entry.snapshot)
    gone = sorted(day for day in counted if day not in live)
    if stale or gone:
        # The snapshots that were looked at, whatever has been committed meanwhile.
        rows = day_table.read_entries(spark, arrivals, ARRIVALS, [(day, live[day]) for day in stale])
        histogram = grains.histogram(grains.rider_view(rows, zone), ["service_date"])
        day_table.write_days(histogram.select(*TALLIES.names), f"{tallies}/days", [*stale, *gone],
                             {day: live[day].snapshot for day in stale}, ORDER)
    return stale + gone


def _signed(counts: DataFrame, sign: int) -> DataFrame:
    return counts.select(*HISTOGRAM.names).withColumns({name: F.col(name) * sign for name in ("n", "seen")})


def read_total(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(HISTOGRAM).parquet(folder).select(*HISTOGRAM.names)


def _summed(spark: SparkSession, folders: list[str]) -> DataFrame:
    """A total and its changes as one histogram."""
    if len(folders) == 1:
        return read_total(spark, folders[0])
    parts = read_total(spark, folders[0])
    for folder in folders[1:]:
        parts = parts.unionByName(read_total(spark, folder))
    return grains.added(parts).where("n <> 0")


def total(spark: SparkSession, tallies: str) -> DataFrame:
    """The histogram of all counted days, brought up to date from the last one."""
    days, root = f"{tallies}/days", f"{tallies}/total"
    now = {day: entry.snapshot for day, entry in day_table.entries(spark, days).items()}
    known = day_table.numbered(spark, f"{root}/_manifest")
    told = {number: json.loads(day_table.read_small(spark, path)) for number, path in known.items()}
    last = told[max(told)] if told else {"folder": None, "days": {}}
    folders = lambda entry: [entry["folder"], *entry.get("changes", [])]
    held = {date.fromisoformat(day): snapshot for day, snapshot in last["days"].items()}
    if last["folder"] and held == now:
        return _summed(spark, [f"{root}/{name}" for name in folders(last)])

    rows = lambda of: day_table.read_entries(spark, days, TALLIES, [(day, Entry(snapshot)) for day, snapshot in of.items()])
    plus = {day: snapshot for day, snapshot in now.items() if held.get(day) != snapshot}
    minus = {day: snapshot for day, snapshot in held.items() if now.get(day) != snapshot}
    changed = last.get("changed", 0) + len(plus.keys() | minus.keys())
    fresh = uuid.uuid4().hex
    entry = {"folder": fresh, "changes": [], "changed": 0}
    if last["folder"] and all(exists(spark, day_table.folder(days, day, Entry(s))) for day, s in minus.items()):
        parts = _signed(rows(plus), 1).unionByName(_signed(rows(minus), -1))
        if 2 * changed < len(held) and len(last.get("changes", [])) < MOST_CHANGES:
            entry = {"folder": last["folder"], "changes": [*last.get("changes", []), fresh], "changed": changed}
        else:
            for name in folders(last):
                parts = parts.unionByName(_signed(read_total(spark, f"{root}/{name}"), 1))
    else:
        parts = _signed(rows(now), 1)
    (grains.added(parts).where("n <> 0").hint("rebalance", "grain").sortWithinPartitions(*ORDER)
     .write.option("compression", "zstd").partitionBy("grain").parquet(f"{root}/{fresh}"))
    day_table.write_small(spark, f"{root}/_manifest/{max(known, default=0) + 1:012d}.json", json.dumps(
        entry | {"days": {str(day): snapshot for day, snapshot in sorted(now.items())}}))
    # The total before stays for readers that have just resolved it, older ones go.
    needed = {*folders(last), *folders(entry)}
    for number in sorted(known)[:-1]:
        for name in set(folders(told[number])) - needed:
            remove(spark, f"{root}/{name}")
        remove(spark, known[number])
    return _summed(spark, [f"{root}/{name}" for name in folders(entry)])


def refresh(spark: SparkSession, arrivals: str, tallies: str, network: Network) -> DataFrame:
    """The histogram of all measured days; only days that changed are read."""
    count_days(spark, arrivals, tallies, network.zone)
    return total(spark, tallies)


def span(spark: SparkSession, tallies: str) -> DataFrame:
    """`grains.day_span` of the counted days, from the manifest."""
    days = list(day_table.entries(spark, f"{tallies}/days"))
    row = (min(days, default=None), max(days, default=None), len(days), len(days) < fixed.SETTLED_DAYS)
    return spark.createDataFrame([row], "first_day date, last_day date, days long, provisional boolean")
