"""Session settings the jobs are planned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings that shape plans. Initial shuffle partitions are generous because adaptive
# execution merges small ones, while it cannot spread rows that were hashed too coarsely.
PLAN_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Shuffle sizes are compressed; keys and counts shrink so far that a megabyte can be half
    # a million rows.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256KB",
    # Merged partitions stop at this size. A sort or hash table takes some seventy times the compressed
    # bytes it reads, so this bounds the memory of a task whatever the input.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16MB",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even where a later step then needs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Archive files are small, gzipped fifteenfold and not splittable; weighing each as this
    # much keeps a task to a handful of them and leaves large files alone.
    "spark.sql.files.openCostInBytes": str(16 << 20),
    # File sizes are compressed sizes; without this a table several times the broadcast
    # threshold would pass for one below it.
    "spark.sql.sources.fileCompressionFactor": "4.0",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings above to a session somebody else built.

    Listing a table of thousands of day partitions then takes a few tasks a core instead of
    one a directory.
    """
    for key, value in PLAN_SETTINGS.items():
        spark.conf.set(key, value)
    listing = max(32, 4 * spark.sparkContext.defaultParallelism)
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(listing))
    return spark


def build_session(name: str = "dwelltime", zone: str | None = None,
                  shuffle_partitions: int | None = None, master: str | None = None,
                  **extra: str) -> SparkSession:
    """A session with the settings above; cluster size and memory stay with spark-submit."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = dict(PLAN_SETTINGS)
    if zone:
        settings["spark.sql.session.timeZone"] = zone
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(extra)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())
