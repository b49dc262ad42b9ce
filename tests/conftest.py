import datetime as dt
import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from calloom.session import tune  # noqa: E402
from calloom.sources import Tables  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.maxMetadataStringLength", "5000")
        .config("spark.sql.debug.maxToStringFields", "200")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


@pytest.fixture(scope="session")
def table(spark):
    """Build a frame from a schema text and rows; ISO texts in date and timestamp columns are parsed."""

    def build(schema, *rows):
        types = [part.strip().split(" ", 1)[1] for part in schema.split(",")]

        def value(type_, cell):
            if isinstance(cell, str) and type_ == "date":
                return dt.date.fromisoformat(cell)
            if isinstance(cell, str) and type_ == "timestamp_ntz":
                return dt.datetime.fromisoformat(cell)
            return cell

        return spark.createDataFrame([tuple(map(value, types, row)) for row in rows], schema)

    return build


@pytest.fixture(scope="session")
def tables(spark):
    return lambda **frames: Tables(spark, frames=frames)


def values(df, *columns):
    """The rows of the given columns as a sorted list of tuples."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(row) for row in chosen.collect()), key=repr)


def day(text):
    return dt.date.fromisoformat(text)
