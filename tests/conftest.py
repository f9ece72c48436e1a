import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

HERE = Path(__file__).resolve().parent
sys.path[:0] = [str(HERE), str(HERE.parent)]

from checking import SMALL  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from tablex import configure

    session = (
        SparkSession.builder.master("local[*]")
        .appName("tablex-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL
