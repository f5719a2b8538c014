"""Sharding by extendible hashing: a directory over hash-prefix bits, in which only oversized buckets split.

A document's hash is the first 60 bits of the MD5 of its id. The directory starts as one bucket; while a bucket holds
more bytes than the limit it is split on the next bit, others stay. Sizes are summed by prefix once, some bits deeper
than needed on average, and rolled up; only rows of buckets that are still too large are looked at with more bits.

Only DataFrame functions are used; what is shuffled is a hash and a size per row, never the texts.

Defined results: a null text has 0 bytes; a null id counts as the text "null"; rows whose hashes are equal can't be
split by bits: a bucket of one hash that is over the limit gets numbered pages of as many rows as fit, at least one.
Other columns are ignored. Without rows there is no shard.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dwelltime.llm.tables import free_name, keep_table

BITS = 60
LIMIT = 1 << 20
SPARE_BITS = 4
STEP_BITS = 8


def hash_bits(key: Column) -> Column:
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("null")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def prefix(bits: Column, depth: Column | int) -> Column:
    """The first depth bits as a number."""
    depth = F.lit(depth) if isinstance(depth, int) else depth
    return F.call_function("shiftright", bits, F.lit(BITS) - depth)


def directory(sized: DataFrame, limit: int) -> DataFrame:
    """(depth, prefix, bytes) of every bucket; sized has the columns bits and bytes."""
    total = sized.agg(F.sum("bytes")).first()[0] or 0
    low, high = 0, min(BITS, max(0, math.ceil(math.log2(max(total / limit, 1)))) + SPARE_BITS)
    found, rest = None, sized
    while True:
        cells = keep_table(rest.groupBy(prefix(F.col("bits"), high).alias("cell"))
                           .agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n")), "cells")
        # A bucket stands at the first depth where it fits, so its parent doesn't; rolled up from the cells.
        rolled = cells.select("cell", "bytes", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth"))
        sums = rolled.groupBy("depth", F.call_function("shiftright", "cell", F.lit(high) - F.col("depth"))
                              .alias("prefix")).agg(F.sum("bytes").alias("bytes"))
        sums = keep_table(sums, "sums")
        parent = sums.where(F.col("bytes") > limit).select(
            (F.col("depth") + 1).alias("depth"), F.col("prefix").alias("above"))
        last = F.lit(high == BITS) & (F.col("depth") == BITS)
        here = sums.where((F.col("bytes") <= limit) | last)
        inner = here.where(F.col("depth") > low).withColumn("above", F.call_function("shiftright", "prefix", F.lit(1)))
        stand = inner.join(parent, ["depth", "above"]).select("depth", "prefix", "bytes")
        if low == 0:
            stand = stand.unionByName(here.where("depth = 0").select("depth", "prefix", "bytes"))
        found = stand if found is None else found.unionByName(stand)
        large = keep_table(sums.where((F.col("depth") == high) & (F.col("bytes") > limit)).select("prefix"), "large")
        if high == BITS or large.isEmpty():
            return keep_table(found, "directory")
        rest = keep_table(rest.withColumn("prefix", prefix(F.col("bits"), high)).join(large, "prefix", "left_semi")
                          .select("bits", "bytes"), "rest")
        low, high = high, min(BITS, high + STEP_BITS)


def _looked_up(sized: DataFrame, buckets: DataFrame) -> DataFrame:
    """Every row of (row, bits, bytes) with its shard and what the shard holds."""
    depths = [row[0] for row in buckets.select("depth").distinct().orderBy("depth").collect()]  # at most 61
    # A row looks up one prefix for every depth that occurs; exactly one of them is a bucket.
    asked = sized.select("*", F.explode(F.array(*map(F.lit, depths)) if depths else F.array().cast("array<int>"))
                         .alias("depth")).withColumn("prefix", prefix(F.col("bits"), F.col("depth")))
    placed = asked.join(buckets.select("depth", "prefix", F.col("bytes").alias("held")), ["depth", "prefix"])
    name = F.when(F.col("depth") == 0, "").otherwise(F.lpad(F.bin("prefix"), F.col("depth"), F.lit("0")))
    return placed.select("row", F.col("bytes").alias("n_bytes"), name.alias("shard"), "held")


def _assigned(docs: DataFrame, columns: list[str], limit: int) -> DataFrame:
    """(row, n_bytes, shard), a row for each of docs; row holds the columns asked for."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    row = F.struct(*[F.col(f"`{name}`") for name in columns])
    sized = keep_table(docs.select(row.alias("row"), hash_bits(F.col("doc_id")).alias("bits"), size.alias("bytes")), "sized")
    return _with_pages(_looked_up(sized, directory(sized.select("bits", "bytes"), limit)), limit)


def assign(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, shard (the bucket's bits, with a page after a dot where pages were needed) per document."""
    return _assigned(docs, ["doc_id"], limit).select("row.doc_id", "n_bytes", "shard")


def _with_pages(placed: DataFrame, limit: int) -> DataFrame:
    """Numbers pages in buckets of one hash that are over the limit; other rows pass without a shuffle."""
    fits = placed.where(F.col("held") <= limit).drop("held")
    over = keep_table(placed.where(F.col("held") > limit).withColumn("part", F.spark_partition_id()), "over")
    if over.isEmpty():
        return fits
    # Rows of each source partition fill pages of their own, so a hot hash is numbered by many tasks.
    line = Window.partitionBy("shard", "part").orderBy("n_bytes", "row.doc_id").rowsBetween(Window.unboundedPreceding, 0)
    biggest = F.max("n_bytes").over(Window.partitionBy("shard", "part"))
    each = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(limit) / F.greatest(biggest, F.lit(1))))
    page = F.floor((F.count("*").over(line) - 1) / each).cast("string")
    return fits.unionByName(over.select("row", "n_bytes", F.concat_ws(".", "shard", F.col("part").cast("string"), page)
                                        .alias("shard")))


def write_shards(docs: DataFrame, path: str, limit: int = LIMIT) -> str:
    """One folder a shard, with the documents' own columns, every row once; returns the folders' column.

    It is `shard`, with underscores behind where the documents have a column of that name.
    """
    folder = free_name(docs, "shard")
    rows = _assigned(docs, docs.columns, limit).select("row.*", F.col("shard").alias(folder))
    rows.repartition(folder).write.mode("overwrite").partitionBy(folder).parquet(path)
    return folder
