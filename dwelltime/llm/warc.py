"""WARC archives with revisit records, and a capture index merged from locally sorted runs.

Archives are written by Spark's text writer, gzipped, a record per row; records are read back by the same source, cut
at the version line and put together again by their lengths, so a payload may hold that line. Each archive gives one
run of captures sorted by URL key and time. Runs are dealt out by ranges of key, time and page, and a loser tree
merges those of a range: partitions in order, and rows in order within them, are the captures of all URLs in order.

Defined results: a null html is an empty payload; of pages with equal payloads that with the smallest page_id is the
response (pages that repeat it are responses too), pages without an id revisit it, and are responses if none has an
id; a null url has no target and an empty key; line ends in a url are percent-encoded. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwelltime.llm.tables import keep_table
from dwelltime.workspace import fresh_path

VERSION = "WARC/1.0\r\n"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
RECORDS_PER_ARCHIVE = 4000


def base32_of_hex(digest: Column) -> Column:
    """Base32 of a 40-digit hexadecimal SHA-1: every five digits give four characters."""
    out = []
    for k in range(8):
        part = F.conv(F.substring(digest, 5 * k + 1, 5), 16, 10).cast("int")
        out += [F.substr(F.lit(ALPHABET), F.call_function("shiftright", part, F.lit(5 * (3 - j))).bitwiseAND(F.lit(31)) + 1,
                         F.lit(1)) for j in range(4)]
    return F.concat(*out)


def with_types(pages: DataFrame, least_bytes: int = 0, captured: Column | None = None) -> DataFrame:
    """page_id, url, html, digest, captured (epoch seconds) and, for revisits, refers_to."""
    if captured is None:
        captured = F.lit(946_684_800) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(1 << 30))
    own = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), captured.alias("captured"))
    own = own.withColumn("digest", F.sha1("html"))
    small = own.where(F.octet_length("html") >= least_bytes).select(F.col("page_id").alias("page"),
                                                                  F.col("digest").alias("of"))
    first = small.groupBy("of").agg(F.min("page").alias("refers_to"), F.count("*").alias("n")).where("n > 1")
    again = (small.join(first, "of").where("refers_to is not null and (page is null or page > refers_to)")
             .select("page", "of", "refers_to").distinct())
    return (own.join(again, own["page_id"].eqNullSafe(again["page"]) & (own["digest"] == again["of"]), "left")
            .drop("page", "of"))


def records(typed: DataFrame) -> DataFrame:
    """One column, value: the text of each record without the blank lines that end it."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    revisit = F.col("refers_to").isNotNull()
    urn = lambda value: F.concat(F.lit("<urn:page:"), value.cast("string"), F.lit(">"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"),
                    line("Content-Length", F.octet_length("html").cast("string")), F.lit("\r\n"))
    block = F.when(revisit, http).otherwise(F.concat(http, "html"))
    target = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    head = F.concat(
        F.lit(VERSION), line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        F.coalesce(line("WARC-Record-ID", urn(F.col("page_id"))), F.lit("")),
        F.coalesce(line("WARC-Target-URI", target), F.lit("")),
        line("WARC-Date", F.date_format(F.timestamp_seconds("captured"), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_of_hex(F.col("digest")))),
        F.when(revisit, F.concat(line("WARC-Refers-To", urn(F.col("refers_to"))),
                                 line("WARC-Profile", F.lit(PROFILE)))).otherwise(""),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"))
    return typed.select(F.concat(head, block).alias("value"))


def write_archives(pages: DataFrame, path: str, **how) -> None:
    (records(with_types(pages, **how)).write.mode("overwrite").option("lineSep", "\r\n\r\n")
     .option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_ARCHIVE).text(path))


def url_key(url: str) -> str:
    """Host parts in reverse, then the path and query; scheme, default port, leading www and fragment are left out."""
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or "").removeprefix("www."), parts.port
    except ValueError:
        return url
    if not host:
        return url
    place = ",".join(reversed(host.split("."))) + (f":{port}" if port not in (None, 80, 443) else "")
    return f"{place}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


INDEX = pa.schema([("url_key", pa.string()), ("captured", pa.string()), ("page_id", pa.int64()),
                   ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
                   ("refers_to", pa.int64()), ("archive", pa.string()), ("offset", pa.int64())])
INDEX_SQL = ("url_key string, captured string, page_id long, payload_bytes long, payload_digest string, "
             "record_type string, refers_to long, archive string, offset long")
_ORDER = (0, 1, 2)


def _key(row: tuple) -> tuple:
    return row[0], row[1], -1 if row[2] is None else row[2]


def _capture(record: bytes, archive: str, offset: int) -> tuple:
    """An index row; the digest of a response is taken from the payload it holds and must be the one it states."""
    head, _, block = record.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode("utf-8", "replace").split("\r\n") if ": " in x)
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response":
        if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest or len(payload) != size:
            raise ValueError(f"{archive}: the record at {offset} does not hold its payload")
    number = lambda name: int(fields[name][10:-1]) if name in fields else None
    url = fields.get("WARC-Target-URI")
    return (url_key(url) if url else "", fields["WARC-Date"], number("WARC-Record-ID"), size, digest,
            fields["WARC-Type"], number("WARC-Refers-To"), archive, offset)


def _block_size(text: bytes) -> int | None:
    """Bytes a record has, from its header; None if the header isn't whole yet."""
    end = text.find(b"\r\n\r\n")
    if end < 0:
        return None
    at = text.rfind(b"Content-Length: ", 0, end)
    return end + 4 + int(text[at + 16:text.find(b"\r\n", at)])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted runs of captures, one an archive: the lines of an archive follow each other."""
    archive, run, text, offset, mark = None, [], None, 0, VERSION.encode()

    def sorted_run() -> pa.RecordBatch:
        run.sort(key=_key)
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*run, strict=True), INDEX, strict=True)],
                                          schema=INDEX)

    for batch in batches:
        for name, line in zip(batch.column("archive").to_pylist(), batch.column("value").to_pylist(), strict=True):
            if name != archive:
                if text is not None:
                    raise ValueError(f"{archive}: the last record is not whole")
                if run:
                    yield sorted_run()
                archive, run, offset = name, [], 0
            if text is None and not line:
                continue  # what stands before the first version line
            text = line if text is None else text + mark + line
            size = _block_size(text)
            if size is not None and len(text) >= size:
                run.append(_capture(text[:size], archive, offset))
                offset, text = offset + len(mark) + len(text), None
    if text is not None:
        raise ValueError(f"{archive}: the last record is not whole")
    if run:
        yield sorted_run()


def read_runs(spark, path: str) -> DataFrame:
    """The captures of all archives, each archive's in order, written as the runs to merge."""
    lines = (spark.read.option("lineSep", VERSION).text(path)
             .select(F.col("_metadata.file_name").alias("archive"), F.col("value").cast("binary").alias("value")))
    return keep_table(lines.mapInArrow(_read, INDEX_SQL), "runs")


class LoserTree:
    """Merges sorted sequences: inner nodes keep the loser of a match, so each step plays one path to the root."""

    def __init__(self, runs: list[list]):
        self.runs, self.at, self.k = runs, [0] * len(runs), len(runs)
        self.losers = [-1] * max(self.k, 1)
        for i in range(self.k - 1, -1, -1):
            self._play(i)

    def _head(self, i: int):
        run = self.runs[i]
        return run[self.at[i]] if self.at[i] < len(run) else None

    def _beats(self, i: int, j: int) -> bool:
        a, b = self._head(i), self._head(j)
        return b is None or (a is not None and (a, i) < (b, j))

    def _play(self, winner: int) -> None:
        node = (winner + self.k) // 2
        while node:
            other = self.losers[node]
            if other == -1:
                self.losers[node] = winner
                return
            if self._beats(other, winner):
                self.losers[node], winner = winner, other
            node //= 2
        self.losers[0] = winner

    def __iter__(self):
        while self.k and self._head(self.losers[0]) is not None:
            winner = self.losers[0]
            yield self._head(winner)
            self.at[winner] += 1
            self._play(winner)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One range of keys: the pieces of the runs that fall in it, merged."""
    parts = [b for b in batches if b.num_rows]
    if not parts:
        return
    table = pa.Table.from_batches(parts)
    columns = [table.column(i).to_pylist() for i in _ORDER]
    runs: dict[str, list] = {}
    for i, name in enumerate(table.column("archive").to_pylist()):
        runs.setdefault(name, []).append((*_key((columns[0][i], columns[1][i], columns[2][i])), i))
    for run in runs.values():
        if any(x > y for x, y in zip(run, run[1:], strict=False)):  # blocks of a run may come in any order
            run.sort()
    order = [key[-1] for key in LoserTree(list(runs.values()))]
    yield from table.take(pa.array(order)).combine_chunks().to_batches(max_chunksize=4096)


def merge_runs(runs: DataFrame) -> DataFrame:
    """All captures in order of URL key, time and page: by partition, and within each."""
    return runs.repartitionByRange("url_key", "captured", "page_id").mapInArrow(_merge, INDEX_SQL)


def capture_index(pages: DataFrame, **how) -> DataFrame:
    """Writes the archives to the shared folder, reads them back and merges the index."""
    path = fresh_path(pages.sparkSession, "warc")
    write_archives(pages, path, **how)
    return merge_runs(read_runs(pages.sparkSession, path))
