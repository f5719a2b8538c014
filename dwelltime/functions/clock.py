"""Time: GTFS clocks, service-day instants, local wall clock, dayparts.

Instants are epoch seconds. Local wall clock is TIMESTAMP_NTZ in a zone given by the caller,
so results do not change with the session's own zone.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column, functions as F

from dwelltime import fixed_values as fixed

DAY = 86400
SERVICE_DAY_SECONDS = 30 * 3600


def gtfs_seconds(clock: Column) -> Column:
    """Seconds after the day's base instant for `HH:MM:SS`, where HH may pass 24.

    Never parsed as a time of day: 25:30:00 belongs to the day the trip started. Text that
    is no clock gives NULL.
    """
    part = lambda n: F.split_part(clock, F.lit(":"), F.lit(n)).try_cast("bigint")
    return part(1) * 3600 + part(2) * 60 + part(3)


def service_date(text: Column) -> Column:
    """A date from `YYYY-MM-DD` or `YYYYMMDD`; anything else gives NULL.

    Respelled and cast, which costs a fraction of parsing by pattern on every record.
    """
    part = lambda start, size: F.substring(text, start, size)
    dashed = F.concat(part(1, 4), F.lit("-"), part(5, 2), F.lit("-"), part(7, 2))
    return (F.when(F.length(text) == 8, dashed).when(F.length(text) == 10, text)).try_cast("date")


def compact_date(day: Column) -> Column:
    """`YYYYMMDD`, the spelling used inside feeds and timetables."""
    return F.replace(day.cast("string"), F.lit("-"), F.lit(""))


def wall_seconds(wall: Column) -> Column:
    """Seconds from 1970-01-01 00:00 on the same wall clock."""
    whole_days = F.unix_date(wall.cast("date")).cast("bigint") * DAY
    return whole_days + F.hour(wall) * 3600 + F.minute(wall) * 60 + F.second(wall)


def utc_wall(epoch: Column) -> Column:
    """Epoch seconds as a UTC wall clock."""
    return F.timestamp_add("SECOND", epoch.cast("bigint"),
                           F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def local_wall(epoch: Column, zone: str) -> Column:
    """Epoch seconds as the wall clock of a zone."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc_wall(epoch))


def day_base(day: Column, zone: str) -> Column:
    """The instant GTFS times of a service day count from: local noon minus twelve hours.

    That differs from local midnight on the two days a year the clocks change.
    """
    noon = day.cast("timestamp_ntz") + F.expr("INTERVAL 12 HOURS")
    return wall_seconds(F.convert_timezone(F.lit(zone), F.lit("UTC"), noon)) - DAY // 2


def day_window(day: Column, zone: str) -> Column:
    """First and last instant a service day's records can carry."""
    base = day_base(day, zone)
    return F.struct(base.alias("starts"), (base + SERVICE_DAY_SECONDS).alias("ends"))


def day_of_week(wall: Column) -> Column:
    """Monday is 0."""
    return F.weekday(wall.cast("date"))


def hour_of_week(wall: Column) -> Column:
    """0 (Monday midnight) to 167."""
    return day_of_week(wall) * 24 + F.hour(wall)


def daypart(wall: Column) -> Column:
    """Kind of day and part of day, such as `wk-am`."""
    dow, hour = day_of_week(wall), F.hour(wall)
    kind = F.when(dow < 5, fixed.WEEKDAY).when(dow == 5, fixed.SATURDAY).otherwise(fixed.SUNDAY)
    starts = sorted(fixed.DAYPARTS, reverse=True)
    part = F.when(hour >= starts[0][0], starts[0][1])
    for first_hour, name in starts[1:]:
        part = part.when(hour >= first_hour, name)
    return F.concat(kind, F.lit("-"), part)


def weekday_flag(day: Column, columns=tuple(fixed.WEEKDAY_COLUMNS)) -> Column:
    """The calendar column that applies on a date."""
    return F.element_at(F.array(*columns), F.weekday(day) + 1)


def iso_instant(stamp: Column) -> Column:
    """`2026-08-16T02:06:55.787401Z` as a TIMESTAMP; other text gives NULL."""
    return stamp.try_cast("timestamp")


def iso_stamp(moment: Column) -> Column:
    """A TIMESTAMP as `2026-08-16T02:06:55.787401Z`; whole seconds carry no fraction."""
    micros = F.unix_micros(moment)
    whole = F.replace(utc_wall(F.floor(micros / 1_000_000)).cast("string"), F.lit(" "), F.lit("T"))
    fraction = F.pmod(micros, F.lit(1_000_000))
    tail = F.when(fraction == 0, "Z").otherwise(
        F.concat(F.lit("."), F.lpad(fraction.cast("string"), 6, "0"), F.lit("Z")))
    return F.concat(whole, tail)


def utc_day(moment: Column) -> Column:
    return utc_wall(F.unix_seconds(moment)).cast("date")


def utc_hour(moment: Column) -> Column:
    return F.hour(utc_wall(F.unix_seconds(moment)))


def parse_service_date(text: str) -> date:
    """Driver-side twin of `service_date` for job arguments."""
    return datetime.strptime(text.replace("-", ""), "%Y%m%d").date()


def default_service_date(zone: str, now: datetime | None = None) -> date:
    """Two days back: a service day runs to about 3 am, and its last UTC partition must be whole."""
    moment = now.astimezone(ZoneInfo(zone)) if now else datetime.now(ZoneInfo(zone))
    return moment.date() - timedelta(days=2)
