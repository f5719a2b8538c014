"""Explicit schemas: inference would cost a pass over the archive and could drift by day."""

from pyspark.sql import types as T


def _fields(*pairs):
    return T.StructType([T.StructField(name, kind) for name, kind in pairs])


_S, _I, _L, _B = T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType()

# Leaves are text: feeds send numbers both bare and quoted, and a text leaf reads either.
POSITION = _fields(
    ("received_at", _S),
    ("agency", _S),
    ("payload", _fields(
        ("vehicle", _fields(
            ("trip", _fields(("startDate", _S), ("tripId", _S))),
            ("currentStatus", _S),
            ("currentStopSequence", _S),
            ("stopId", _S),
            ("timestamp", _S),
        )),
    )),
)

OBSERVATIONS = _fields(
    ("service_date", T.DateType()), ("agency", _S), ("trip_id", _S), ("status", _S),
    ("stop_sequence", _I), ("stop_id", _S), ("ts", _L),
)

SCHEDULED = _fields(
    ("service_date", T.DateType()), ("agency", _S), ("line", _S), ("route_id", _S),
    ("direction_id", _I), ("trip_id", _S), ("stop_id", _S), ("stop_sequence", _I),
    ("scheduled_arrival", _L), ("scheduled_departure", _L),
    ("is_origin", _B), ("is_terminus", _B),
)

ARRIVALS = _fields(
    ("service_date", T.DateType()), ("agency", _S), ("line", _S), ("route_id", _S),
    ("direction_id", _I), ("trip_id", _S), ("stop_id", _S), ("stop_sequence", _I),
    ("scheduled_time", T.TimestampType()), ("actual_time", T.TimestampType()),
    ("delay_seconds", _I), ("source", _S), ("in_transit_seen", _B),
    ("is_origin", _B), ("is_terminus", _B),
)

TIMETABLE_VERSIONS = _fields(
    ("feed", _S), ("version", _S), ("source_etag", _S), ("source_url", _S),
    ("fetched_at", T.TimestampType()), ("updated_at", T.TimestampType()),
    ("route_codes", _S), ("path", _S),
)

# Rows and measured rows by grain (operators.grains.GRAINS); columns a grain lacks are missing.
HISTOGRAM = _fields(
    ("grain", _S), ("agency", _S), ("line", _S), ("direction_id", _I), ("how", _I), ("delay_seconds", _I),
    ("stop_id", _S), ("bucket", _S), ("stop_sequence", _I), ("trip_id", _S), ("n", _L), ("seen", _L),
)
TALLIES = T.StructType([T.StructField("service_date", T.DateType()), *HISTOGRAM.fields])
