"""Site documents: a JSON file per line, an index of lines, a status record.

A line's file is built as ordered parts, one a row: the opening, each direction's opening,
one part per stop, the closings. Only a stop's cells (at most 18) and a direction's profile
(at most 168 hours) are ever gathered into one value, so a line with any number of stops
streams through its writer instead of sitting in one row. Keys are alphabetical, missing
values are written, and nothing depends on the time of the run.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from dwelltime.operators.grains import DIRECTION, LINE, STOP

PART_ORDER = ["direction_rank", "step", "seq", "stop_id"]
_OPEN, _STOP, _CLOSE = 0, 1, 2
_FIRST_RANK, _LAST_RANK = -1, 2


@dataclass(frozen=True)
class Span:
    """First day, last day and number of days, as literals or scalar subqueries."""

    first_day: Column
    last_day: Column
    days: Column

    @staticmethod
    def of(first_day, last_day, days) -> "Span":
        return Span(F.lit(str(first_day)), F.lit(str(last_day)), F.lit(days))

    @staticmethod
    def lazily(day_span: DataFrame) -> "Span":
        one = lambda column: day_span.select(column).scalar()
        return Span(one(F.col("first_day").cast("string")), one(F.col("last_day").cast("string")),
                    one(F.col("days")))


def json(value: Column) -> Column:
    return F.to_json(value, {"ignoreNullFields": "false"})


def _gathered(rows: DataFrame, keys: list[str], order: str, name: str, out: str) -> DataFrame:
    """Metric rows of each group as a JSON array, ordered by one of their columns."""
    entry = F.struct(F.col(order).alias(name), F.col("med"), F.col("measured").alias("n"),
                     F.col("p90"), F.col("pct5"), F.col("scheduled").alias("sched"))
    return rows.groupBy(*keys).agg(json(F.array_sort(F.collect_list(entry))).alias(out))


def stop_entries(totals: DataFrame, cells: DataFrame, stop_labels: DataFrame) -> DataFrame:
    """One JSON object per stop: totals, name, place, and its measured dayparts.

    Stops without a measured daypart keep an empty list.
    """
    nested = _gathered(cells, STOP, "bucket", "d", "cells")
    joined = (totals.join(nested, STOP, "left")
              .join(stop_labels, ["agency", "stop_id"], "left"))
    held = F.coalesce("cells", F.lit("[]"))
    rest = json(F.struct(
        F.col("stop_id").alias("id"), "lat", "lon", F.col("measured").alias("n"),
        F.coalesce("name", "stop_id").alias("name"), F.col("scheduled").alias("sched"), "seq"))
    body = F.concat(F.lit('{"cells":'), held, F.lit(","), F.substring(rest, F.lit(2), F.length(rest)))
    return joined.select(*STOP, "seq", "scheduled", "measured", body.alias("entry"))


def direction_entries(profile: DataFrame, stops: DataFrame, direction_labels: DataFrame) -> DataFrame:
    """One row per measured direction 0 or 1: totals, profile text, sign, first stop in route order."""
    shown = F.col("direction_id").isin(0, 1)
    shapes = _gathered(profile.where(shown), DIRECTION, "how", "h", "profile")
    sums = stops.where(shown).groupBy(*DIRECTION).agg(
        F.sum("measured").alias("n"), F.sum("scheduled").alias("sched"),
        F.min(F.struct("seq", "stop_id")).alias("first_stop"))
    return (shapes.join(sums, DIRECTION)
            .join(direction_labels, DIRECTION, "left")
            .withColumn("to", F.coalesce("to", F.lit(""))))


def _labelled(lines: DataFrame, line_names: DataFrame) -> DataFrame:
    """Lines with label, corridor and mode; an unknown line is its own label and a bus."""
    return lines.join(line_names, LINE, "left").select(
        *lines.columns, F.coalesce("label", "line").alias("label"),
        F.coalesce("via", F.lit("")).alias("via"), F.coalesce("mode", F.lit("bus")).alias("mode"))


def line_parts(profile: DataFrame, stops: DataFrame, directions: DataFrame,
               labels: dict[str, DataFrame], span: Span) -> DataFrame:
    """The ordered parts of every line's file; sorted by PART_ORDER they read as one document."""
    lines = _labelled(profile.select(*LINE).distinct(), labels["lines"])
    nothing = F.lit(None)

    def part(frame, rank, step, body, seq=nothing, stop=nothing):
        return frame.select(*LINE, rank.cast("int").alias("direction_rank"),
                            F.lit(step).alias("step"), seq.cast("int").alias("seq"),
                            stop.cast("string").alias("stop_id"), body.alias("part"))

    opening = F.concat(F.lit('{"agency":'), json_text(F.col("agency")), F.lit(',"days":'),
                       span.days.cast("string"), F.lit(',"directions":['))
    tail = json(F.struct(
        span.first_day.alias("first_day"), F.col("label"), span.last_day.alias("last_day"),
        F.col("line"), F.col("mode"), F.col("via")))
    closing = F.concat(F.lit("],"), F.substring(tail, F.lit(2), F.length(tail)))

    firsts = directions.groupBy(*LINE).agg(F.min("direction_id").alias("first_direction"))
    placed = directions.join(firsts, LINE)
    rank = F.col("direction_id")
    begins = F.concat(
        F.when(rank == F.col("first_direction"), "").otherwise(","),
        F.lit('{"id":'), rank.cast("string"), F.lit(',"n":'), F.col("n").cast("string"),
        F.lit(',"profile":'), F.col("profile"), F.lit(',"sched":'), F.col("sched").cast("string"),
        F.lit(',"stops":['))
    ends = F.concat(F.lit('],"to":'), json_text(F.col("to")), F.lit("}"))
    each = stops.join(directions.select(*DIRECTION, "first_stop"), DIRECTION)
    is_first = (F.col("seq") == F.col("first_stop.seq")) & (F.col("stop_id") == F.col("first_stop.stop_id"))
    listed = F.concat(F.when(is_first, "").otherwise(","), F.col("entry"))

    parts = [
        part(lines, F.lit(_FIRST_RANK), _OPEN, opening),
        part(placed, rank, _OPEN, begins),
        part(each, rank, _STOP, listed, F.col("seq"), F.col("stop_id")),
        part(directions, rank, _CLOSE, ends),
        part(lines, F.lit(_LAST_RANK), _CLOSE, closing),
    ]
    whole = parts[0]
    for more in parts[1:]:
        whole = whole.unionByName(more)
    return whole


def json_text(value: Column) -> Column:
    """A text value as JSON, quoted and escaped."""
    inside = F.to_json(F.array(value))
    return F.substring(inside, F.lit(2), F.length(inside) - 2)


def index_entries(heads: DataFrame, profile: DataFrame, directions: DataFrame,
                  labels: dict[str, DataFrame]) -> DataFrame:
    """One JSON object per line with its headline numbers and where its directions go."""
    lines = _labelled(profile.select(*LINE).distinct(), labels["lines"])
    signs = directions.groupBy(*LINE).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("direction_id", "to"))),
                    lambda pair: pair["to"]).alias("to"))
    entry = json(F.struct(
        "agency", "label", "line", "med", "mode", F.col("measured").alias("n"), "p90", "pct5",
        F.col("scheduled").alias("sched"),
        F.coalesce("to", F.array().cast("array<string>")).alias("to"), "via"))
    return (lines.join(heads, LINE, "left").join(signs, LINE, "left")
            .select(*LINE, entry.alias("entry")))


INDEX_ORDER = ["step", "agency", "width", "line"]


def index_parts(entries: DataFrame, span: Span) -> DataFrame:
    """The index as ordered parts, a row a line between an opening and a closing; sorted by INDEX_ORDER.

    Nothing is gathered: the one line without a comma before it is the least of them.
    """
    head = json(F.struct(span.days.alias("days"), span.first_day.alias("first_day"), span.last_day.alias("last_day")))
    opening = F.concat(F.substring(head, F.lit(1), F.length(head) - 1), F.lit(',"lines":['))
    placed = entries.select(*LINE, F.length("line").alias("width"), "entry")
    first = placed.agg(F.min(F.struct("agency", "width", "line")).alias("first")).select("first.*").select(
        *[F.col(name).alias(f"first_{name}") for name in ("agency", "line")])
    listed = placed.join(F.broadcast(first), (F.col("agency") == F.col("first_agency")) & (
        F.col("line") == F.col("first_line")), "left")
    text = lambda value: F.lit(value).cast("string")
    # One row, also where no line is listed.
    ends = entries.sparkSession.range(1)
    edge = lambda step, part: ends.select(F.lit(step).alias("step"), text(None).alias("agency"),
                                          F.lit(None).cast("int").alias("width"), text(None).alias("line"), part.alias("part"))
    middle = listed.select(F.lit(_STOP).alias("step"), "agency", "width", "line", F.concat(
        F.when(F.col("first_line").isNull(), ",").otherwise(""), F.col("entry")).alias("part"))
    return edge(_OPEN, opening).unionByName(middle).unionByName(edge(_CLOSE, F.lit("]}")))


def index_document(entries: DataFrame, span: Span) -> DataFrame:
    """The index, one row: as many entries as the network has lines, in natural order."""
    ordered = F.array_sort(F.collect_list(
        F.struct(F.col("agency"), F.length("line").alias("width"), F.col("line"), F.col("entry"))))
    listed = F.array_join(F.transform(ordered, lambda row: row["entry"]), ",")
    head = json(F.struct(span.days.alias("days"), span.first_day.alias("first_day"),
                         span.last_day.alias("last_day")))
    return entries.agg(listed.alias("listed")).select(F.concat(
        F.substring(head, F.lit(1), F.length(head) - 1), F.lit(',"lines":['),
        F.coalesce("listed", F.lit("")), F.lit("]}")).alias("document"))


def status_document(totals: DataFrame, span: Span) -> DataFrame:
    """Days, coverage and totals, one row."""
    return totals.select(json(F.struct(
        "coverage_pct", span.days.alias("days"), span.first_day.alias("first_day"),
        span.last_day.alias("last_day"), "lines", "lines_by_code", "measured_arrivals",
        "scheduled_stops", "trips")).alias("document"))
