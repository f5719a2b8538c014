"""Outputs of a micro-batch, kept by its number: a batch that is run again writes the same partitions."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from dwelltime.workspace import remove


def replace(frame: DataFrame, path: str, batch: int) -> None:
    """A small output of one batch, as one partition of a Parquet table; without rows it is there, but empty."""
    frame.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def read(spark: SparkSession, path: str, schema: str, batch: int) -> DataFrame:
    """What a batch left; empty where there was none."""
    try:
        return spark.read.schema(schema).parquet(f"{path}/batch={batch}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def forget(spark: SparkSession, path: str, batch: int) -> None:
    """Drop state that no batch can ask for any more."""
    if batch >= 0:
        remove(spark, f"{path}/batch={batch}")


def every(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All batches' rows, with the number of the batch."""
    return spark.read.schema(f"{schema}, batch long").parquet(path).select("*", F.col("batch"))
