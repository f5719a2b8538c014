from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from frames import rows
from dwelltime import fixed_values as fixed
from dwelltime.functions import clock, metrics, text

LA = "America/Los_Angeles"


def one(spark, column, **values):
    frame = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return frame.select(column.alias("out")).first().out


@pytest.mark.parametrize("given, seconds", [
    ("00:00:00", 0), ("25:30:00", 91800), (" 7:05:09", 25509), ("noon", None)])
def test_gtfs_clock_runs_past_midnight(spark, given, seconds):
    assert one(spark, clock.gtfs_seconds(F.col("t")), t=given) == seconds


@pytest.mark.parametrize("day, base", [
    (date(2026, 8, 18), 1787036400), (date(2026, 11, 1), 1793520000), (date(2026, 3, 8), 1772953200)])
def test_day_base_is_noon_minus_twelve_hours(spark, day, base):
    assert one(spark, clock.day_base(F.col("d"), LA), d=day) == base


def test_day_window_is_thirty_hours(spark):
    window = one(spark, clock.day_window(F.col("d"), LA), d=date(2026, 8, 18))
    assert window.ends - window.starts == 108000


@pytest.mark.parametrize("given", ["2026-08-18", "20260818"])
def test_service_date_spellings(spark, given):
    assert one(spark, clock.service_date(F.col("t")), t=given) == date(2026, 8, 18)
    assert clock.parse_service_date(given) == date(2026, 8, 18)


def test_bad_service_date_is_missing(spark):
    assert one(spark, clock.service_date(F.col("t")), t="20260231") is None


def test_local_parts_ignore_the_session_zone(spark):
    epoch = int(datetime(2026, 8, 19, 5, 30, tzinfo=timezone.utc).timestamp())  # 22:30 Tuesday
    wall = clock.local_wall(F.col("e"), LA)
    assert one(spark, F.hour(wall), e=epoch) == 22
    assert one(spark, clock.day_of_week(wall), e=epoch) == 1
    assert one(spark, clock.hour_of_week(wall), e=epoch) == 46
    assert one(spark, clock.daypart(wall), e=epoch) == "wk-late"


@pytest.mark.parametrize("hour, part", [(0, "early"), (6, "am"), (9, "mid"), (15, "pm"), (19, "eve"), (23, "late")])
def test_dayparts_and_kinds_of_day(spark, hour, part):
    for day, kind in ((17, "wk"), (22, "sa"), (23, "su")):
        epoch = int(datetime(2026, 8, day, hour, tzinfo=timezone.utc).timestamp())
        assert one(spark, clock.daypart(clock.utc_wall(F.col("e"))), e=epoch) == f"{kind}-{part}"


@pytest.mark.parametrize("stamp", ["2026-08-16T02:06:55.787401Z", "2026-08-16T02:06:55Z", "2026-08-16T02:06:55.000401Z"])
def test_iso_stamps_round_trip(spark, stamp):
    assert one(spark, clock.iso_stamp(clock.iso_instant(F.col("t"))), t=stamp) == stamp


def test_default_day_is_two_back_in_the_networks_zone():
    assert clock.default_service_date(LA, datetime(2026, 8, 20, 3, tzinfo=timezone.utc)) == date(2026, 8, 17)


@pytest.mark.parametrize("route, line", [("720-13201", "720"), ("801", "801"), (" 2 -x", "2")])
def test_line_code(spark, route, line):
    assert one(spark, text.line_code(F.col("r")), r=route) == line


@pytest.mark.parametrize("given", [
    "WESTWOOD - EXPOSITION PARK VIA SUNSET-ALVARADO", "  DOWNTOWN LA  NB ", "don't stop 10TH st", "",
    "LAX/USC x'y ÉCOLE", "10/48 la2la"])
def test_readable_follows_title_case(spark, given):
    expected = " ".join(fixed.RESTORED_WORDS.get(w, w) for w in given.strip().title().split())
    assert one(spark, text.readable(F.col("t")), t=given) == expected


@pytest.mark.parametrize("raw, clean", [('W/"abc"', "abc"), (' "abc" ', "abc"), ("abc", "abc")])
def test_clean_etag(spark, raw, clean):
    assert one(spark, text.clean_etag(F.col("t")), t=raw) == clean
    assert one(spark, text.clean_etag(F.lit(None).cast("string"))) == ""


def test_archive_names(spark):
    good, bad = "vehicle_positions-20260816T020655Z.jsonl.gz", "vehicle_positions-x.jsonl.gz"
    assert one(spark, text.archive_day(F.col("n")), n=good) == date(2026, 8, 16)
    assert one(spark, text.archive_hour(F.col("n")), n=good) == 2
    assert one(spark, text.archive_day(F.col("n")), n=bad) is None
    assert one(spark, text.archive_hour(F.col("n")), n=bad) is None


def test_natural_order(frame):
    codes = frame([(c,) for c in ("102", "2", "10", "9")], "code string")
    assert [r.code for r in codes.orderBy(*text.natural_order(F.col("code"))).collect()] == ["2", "9", "10", "102"]


def test_either(spark):
    assert one(spark, text.either(F.col("a"), F.lit(" x ")), a="") == "x"
    assert one(spark, text.either(F.col("a"), F.lit("x")), a=" y ") == "y"


def test_delay_metrics_are_exact_and_count_unseen_rows(frame):
    rows_in = [("a", 10), ("a", 301), ("a", None), ("a", 15), ("b", None)]
    out = metrics.delay_metrics(frame(rows_in, "line string, delay_seconds int"), ["line"])
    assert rows(out) == [("a", 4, 3, 15, 244, 33.3)]


def test_half_seconds_round_away_from_zero(frame):
    out = metrics.delay_metrics(frame([("a", -1), ("a", -2)], "line string, delay_seconds int"), ["line"])
    assert out.first().med == -2
