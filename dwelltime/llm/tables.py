"""Reading the corpus tables, session settings and shipping of the package to executors."""

from __future__ import annotations

import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path
from tempfile import mkdtemp

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dwelltime.workspace import fresh_path

# Rows in an Arrow batch. Texts may be long, and a Python worker holds a batch at a time.
BATCH_ROWS = 512

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS),
    "spark.sql.parquet.compression.codec": "zstd",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Settings of these operators, and the package for the executors' Python workers."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    context = spark.sparkContext
    if not getattr(context, "_dwelltime_shipped", False):
        root = Path(__file__).resolve().parents[2]
        archive = Path(mkdtemp(prefix="ship-")) / "dwelltime_package.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for path in sorted(root.glob("dwelltime/**/*.py")):
                out.write(path, str(path.relative_to(root)))
        context.addPyFile(str(archive))
        context._dwelltime_shipped = True
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def free_name(frame: DataFrame, wish: str) -> str:
    """A column name the frame doesn't have yet."""
    taken = {name.lower() for name in frame.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files: they go with the end of the job that needed them."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def keep_table(frame: DataFrame, label: str, rows_per_file: int | None = None) -> DataFrame:
    """Written once to the shared folder and read back: survives lost executors, cuts lineage."""
    path = fresh_path(frame.sparkSession, label)
    writer = frame.write.mode("overwrite")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
