from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

from aislane import configure


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def ais(spark, sf_dir):
    from aislane.sources.fixture import ais_rows

    return ais_rows(spark, sf_dir)


def as_set(frame, *columns):
    """Rows as a sorted list of tuples, to compare without order."""
    chosen = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in chosen.collect()), key=str)
