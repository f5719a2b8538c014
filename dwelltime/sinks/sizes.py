"""How big the output is, from file lengths; no file is opened."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def file_sizes(spark: SparkSession, path: str | list[str], pattern: str) -> DataFrame:
    return (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
            .option("recursiveFileLookup", "true").load(path).select("path", "length"))


def table_size(spark: SparkSession, path: str | list[str], rows: DataFrame) -> DataFrame:
    """Bytes, rows and bytes a row of a Parquet table or of the given folders of one, one row."""
    measured = file_sizes(spark, path, "*.parquet").agg(F.sum("length").alias("bytes"))
    counted = rows.agg(F.count(F.lit(1)).alias("rows"))
    return measured.select(
        F.coalesce("bytes", F.lit(0)).alias("bytes"), counted.scalar().alias("rows")
    ).withColumn("bytes_per_row", F.col("bytes") / F.nullif(F.col("rows"), F.lit(0)))


def document_sizes(spark: SparkSession, path: str, pattern: str = "{*.txt*,*.json*}") -> DataFrame:
    """Bytes per line file, of a published site or of the parts it is built from; a gzip copy gives gzip sizes."""
    part = lambda group: F.url_decode(F.replace(F.regexp_extract(
        "path", r"/(?:agency=)?([^/]+)/(?:line=)?([^/]+?)(?:/part-[^/]*|[.]json(?:[.]gz)?)$", group),
        F.lit("+"), F.lit("%2B")))
    return (file_sizes(spark, path, pattern)
            .groupBy(part(1).alias("agency"), part(2).alias("line"))
            .agg(F.sum("length").alias("bytes")))


def largest_document(sizes: DataFrame) -> DataFrame:
    """Number of line files, total bytes, and the largest with its size, one row."""
    biggest = F.max(F.struct("bytes", "agency", "line"))
    return sizes.agg(
        F.count(F.lit(1)).alias("documents"), F.sum("bytes").alias("bytes"), biggest.alias("top")
    ).select("documents", "bytes", F.col("top.agency").alias("agency"),
             F.col("top.line").alias("line"), F.col("top.bytes").alias("largest_bytes"))
