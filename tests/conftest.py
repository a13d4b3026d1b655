from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TINY = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("scoreloom-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def applicants(spark):
    """A stored applicant table, so that plans over it show the operators alone."""
    from scoreloom.sources.applicants import applicant_table, write_snapshot
    from scoreloom.storage import new_path

    return write_snapshot(applicant_table(spark, TINY), new_path(spark, "applicants"))


@pytest.fixture(scope="session")
def pandas_applicants(applicants):
    return applicants.toPandas()
