import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

import __spark_entry__  # noqa: E402, F401  (ships the package by value)


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def order(row):
    return tuple((v is None, 0 if v is None else v) for v in row)


def rows(df, *columns):
    """Sorted list of row tuples, NULLs last."""
    df = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in df.collect()), key=order)
