"""Transit punctuality as Spark jobs.

Matches what vehicles reported with what the timetable promised, and summarises the
difference. Every operator takes DataFrames and returns a DataFrame; service days are a
column, never a loop, so one job covers a day or ten years.

    functions/  column expressions: GTFS clocks, local wall time, names, delay metrics
    sources/    the position archive, timetable zips, the measured table
    operators/  joins, groupings and checks, one concern a module
    sinks/      partition replacement, site documents, size report
    plans/      the jobs a scheduler calls
    streaming/  landing of raw messages and feed monitoring
    bindings/   the same operators over a TPC-H-like star schema, with SQL to compare
"""

__version__ = "0.1.0"
