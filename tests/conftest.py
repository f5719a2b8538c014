import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from dwelltime.session import tune  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (SparkSession.builder.master("local[4]").appName("tests")
               .config("spark.sql.shuffle.partitions", "4")
               # Not the networks' zone on purpose: results must not depend on it.
               .config("spark.sql.session.timeZone", "Asia/Tokyo")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    def make(rows, schema):
        return spark.createDataFrame(rows, schema)

    return make
