"""Where intermediate tables live: the shared folder the session names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where none is set, a local session gets one; a cluster is refused.

    On a cluster a machine's own folder would hold only what that machine wrote.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = getattr(spark, "_dwelltime_folder", None) or tempfile.mkdtemp(prefix="dwelltime-")
        spark._dwelltime_folder = folder
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of any file system Spark knows; a missing one is no error."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def full_path(spark: SparkSession, path: str) -> str:
    """The path as Spark's readers spell it, scheme included."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where).toString()


def partition_folder(spark: SparkSession, path: str, **values: str) -> str:
    """Folder of one partition, its values spelled the way the writer spells them."""
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return "/".join([path.rstrip("/"), *[f"{name}={escape(str(value))}" for name, value in values.items()]])


def materialise(frame: DataFrame, label: str) -> DataFrame:
    """Write once to the shared folder and read back.

    Used where a result feeds several actions. A written table survives lost executors and
    keeps column pruning and filter pushdown for whoever reads it.
    """
    spark = frame.sparkSession
    path = fresh_path(spark, label)
    frame.write.mode("overwrite").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
