import gzip
import json
import os
import random
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from frames import rows
from dwelltime.operators import monitoring
from dwelltime.sources import positions
from dwelltime.streaming import alarms, landing, record

START = datetime(2026, 8, 18, 4, 0, tzinfo=timezone.utc)


def _line(moment, agency, payload='{ "vehicle" : {"n": 1.50} }'):
    stamp = moment.isoformat().replace("+00:00", "Z")
    return f'{{"received_at":"{stamp}","agency":"{agency}","payload":{payload}}}'


def _spool(folder, name, lines):
    folder.mkdir(parents=True, exist_ok=True)
    with gzip.open(folder / name, "wt") as out:
        out.write("\n".join(lines) + "\n")


def test_envelope_splices_the_payload_untouched(frame):
    given = frame([(START, "A", '{ "b" : 1.50 }')], "received_at timestamp, agency string, payload string")
    row = landing.enveloped(given).first()
    assert row.value == '{"received_at":"2026-08-18T04:00:00Z","agency":"A","payload":{ "b" : 1.50 }}'
    assert (str(row.dt), row.hh) == ("2026-08-18", "04")


def test_landing_places_lines_by_file_name_once(spark, tmp_path):
    spool, archive = tmp_path / "spool", str(tmp_path / "archive")
    _spool(spool, "vehicle_positions-20260818T045500Z.jsonl.gz", [_line(START, "bus"), _line(START, "rail")])
    _spool(spool, "stray.gz", ["left over"])

    def run():
        placed = landing.placed_lines(landing.spool_lines(spark, str(spool)))
        landing.start_landing(placed, archive, str(tmp_path / "c1"), once=True).awaitTermination()
        landing.start_quarantine(placed, str(tmp_path / "odd"), str(tmp_path / "c2"), once=True).awaitTermination()

    run()
    _spool(spool, "vehicle_positions-20260818T050000Z.jsonl.gz", [_line(START, "bus")])
    run()  # resumes from its checkpoint
    landed = positions.read_positions(spark, archive, committed_only=True)
    assert rows(landed.groupBy("hh", "agency").count()) == [(4, "bus", 1), (4, "rail", 1), (5, "bus", 1)]
    texts = [r.value for r in spark.read.text(archive).collect()]
    assert texts.count(_line(START, "bus")) == 2
    assert rows(spark.read.schema("value string, file_name string").parquet(str(tmp_path / "odd"))) == [("left over", "stray.gz")]


def _deliver(spool, first, last, rail, every=5):
    """A file per stretch of intervals; nothing at all arrives in interval 2."""
    lines = []
    for n in range(first, last):
        moment = START + timedelta(minutes=every * n, seconds=7)
        if n != 2:
            lines += [_line(moment, "bus")] * 3 + ([_line(moment, "rail")] if rail(n) else [])
    _spool(spool, f"f-{first:03d}.gz", lines)


def test_streamed_tallies_and_silence_equal_the_batch_over_ten_batches_and_a_restart(spark, tmp_path):
    spool, out, agencies = tmp_path / "spool", str(tmp_path / "out"), ["bus", "rail", "ferry"]
    rail = lambda n: n == 0 or n in (9, 10) or n > 21

    def run():
        raw = (spark.readStream.format("text").option("pathGlobFilter", "*.gz").option("maxFilesPerTrigger", 1)
               .load(str(spool)).select("value"))
        grid = alarms.feed_grid(landing.messages(raw), agencies)
        alarms.start_silence(grid, out, str(tmp_path / "c"), once=True).awaitTermination()

    for n in range(0, 24, 4):
        _deliver(spool, n, n + 4, rail)
    run()
    for n in range(24, 40, 4):
        _deliver(spool, n, n + 4, rail)
    run()  # resumes from its checkpoint, with the feeds' counters
    told = spark.read.schema(alarms.SILENCE).parquet(out)
    received = landing.messages(spark.read.text(str(spool)))
    batch = monitoring.interval_tally(received, F.col("received_at"), "5 minutes")
    closed = told.agg(F.max("interval")).first()[0]
    batch = batch.where(F.col("interval") <= closed)
    assert rows(told) == rows(monitoring.silence(batch, agencies))
    assert rows(alarms.alarms_of(told)) == rows(monitoring.stalled_feeds(batch, agencies))
    assert told.where("agency = 'ferry'").agg(F.max("silent")).first()[0] >= 34
    batches = len(list((tmp_path / "c" / "commits").glob("[0-9]*")))
    assert batches >= 10


def test_windowed_tally_of_a_stream(spark, tmp_path):
    _deliver(tmp_path / "spool", 0, 8, lambda n: n == 0)
    tallies = alarms.feed_tally(landing.messages(landing.spool_lines(spark, str(tmp_path / "spool"))))
    out = str(tmp_path / "tally")
    (tallies.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "c"))
     .outputMode("append").trigger(availableNow=True).start().awaitTermination())
    closed = spark.read.schema("interval timestamp, agency string, records long").parquet(out)
    received = landing.messages(spark.read.text(str(tmp_path / "spool")))
    left = monitoring.interval_tally(alarms.open_records(received, closed, "5 minutes"), F.col("received_at"), "5 minutes")
    batch = monitoring.interval_tally(received, F.col("received_at"), "5 minutes")
    assert rows(closed.unionByName(left)) == rows(batch) and closed.count() >= 5


def _recorder(spark, tmp_path, files=1):
    def run(lateness="10 minutes"):
        raw = (spark.readStream.format("text").option("pathGlobFilter", "*.gz").option("maxFilesPerTrigger", files)
               .load(str(tmp_path / "spool")).select("value", F.col("_metadata.file_name").alias("file_name")))
        record.start_record(raw, str(tmp_path / "out"), str(tmp_path / "c"), ["bus", "rail"], lateness=lateness,
                            once=True).awaitTermination()
    return run


def test_the_record_job_keeps_every_line_in_any_order(spark, tmp_path):
    spool, out = tmp_path / "spool", str(tmp_path / "out")
    order = list(range(0, 40, 4))
    random.Random(4).shuffle(order)
    run = _recorder(spark, tmp_path)
    for place, n in enumerate(order):
        _deliver(spool, n, n + 4, lambda n: n % 7 < 3)
        os.utime(spool / f"f-{n:03d}.gz", (1_700_000_000 + place, 1_700_000_000 + place))
    _spool(spool, "f-bad.gz", ["{broken", '{"agency":"bus","payload":{}}', '{"received_at":"2026-08-18T04:00:00Z"}', "", "left over"])
    run()
    received = landing.messages(spark.read.text(str(spool)))
    batch = monitoring.interval_tally(received, F.col("received_at"), "5 minutes")
    assert rows(record.tally(spark, out)) == rows(batch)
    late, in_time = record.tally(spark, out, late=True), record.tally(spark, out, late=False)
    assert not late.isEmpty() and not in_time.isEmpty()
    bad = record.unreadable(spark, out)
    assert rows(bad.groupBy("reason").count()) == [("no feed", 1), ("no receive time", 1), ("not JSON", 3)]
    landed = positions.read_positions(spark, f"{out}/archive")
    assert landed.count() == received.count()


def test_alarms_of_the_record_job_equal_the_batch_and_a_replay_changes_nothing(spark, tmp_path):
    spool, out = tmp_path / "spool", str(tmp_path / "out")
    for place, n in enumerate(range(0, 40, 4)):
        _deliver(spool, n, n + 4, lambda n: n < 3 or n > 30)
        os.utime(spool / f"f-{n:03d}.gz", (1_700_000_000 + place, 1_700_000_000 + place))
    run = _recorder(spark, tmp_path)
    run()
    received = landing.messages(spark.read.text(str(spool)))
    batch = monitoring.interval_tally(received, F.col("received_at"), "5 minutes")
    last = START + timedelta(minutes=5 * 39, seconds=7) - timedelta(minutes=10)
    closed = batch.where(F.col("interval") + F.expr("INTERVAL 5 MINUTES") <= F.lit(last))
    everything = lambda: [rows(frame) for frame in (
        record.tally(spark, out), record.alarms(spark, out), record.unreadable(spark, out).drop("batch"),
        positions.read_positions(spark, f"{out}/archive").select("received_at", "agency"))]
    before = everything()
    assert before[1] == rows(monitoring.stalled_feeds(closed, ["bus", "rail"])) and before[1]
    # The last batch is run again, as after a crash between its outputs and its commit.
    commits = sorted((tmp_path / "c" / "commits").glob("[0-9]*"), key=lambda path: int(path.name))
    commits[-1].unlink()
    (commits[-1].parent / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    run()
    assert everything() == before
    assert len(commits) == 10
