import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tidepool.session import configure

    spark = (
        SparkSession.builder.master("local[*]")
        .appName("tidepool-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # tests set their own shared folder; clusters name theirs
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidepool-test-ckpt-"))
    configure(spark)
    yield spark
    spark.stop()


@pytest.fixture()
def scratch(spark):
    from tidepool.session import scratch_path

    return lambda name: scratch_path(spark, name)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so that tests can open the path."""
    return "/" + path.removeprefix("file:").lstrip("/")


def rows(df, *cols):
    """Sorted list of tuples for order-insensitive comparison."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=repr)
