import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import SparkSession  # noqa: E402

import rillet  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[*]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield rillet.configure(session)
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")
