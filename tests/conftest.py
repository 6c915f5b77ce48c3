import os
import sys
from datetime import datetime, timezone
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master(f"local[{os.environ.get('TEST_CPUS', '8')}]")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .appName("docwatch-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def as_of():
    return datetime(2024, 1, 31, tzinfo=timezone.utc)


@pytest.fixture
def one(spark):
    """Value of a function of the string column ``x`` over one row."""

    def value(build, **columns):
        frame = spark.createDataFrame(
            [tuple(columns.values())], ", ".join(f"{c} string" for c in columns)
        )
        return frame.select(build(F.col("x")).alias("value")).first().value

    return value
