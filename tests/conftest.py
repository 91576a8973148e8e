from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[*]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(folder / "shared"))
        .config("spark.sql.warehouse.dir", str(folder / "warehouse"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def no_broadcast(spark):
    """No table counts as small enough for a broadcast."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


def rows(df):
    """Rows as a sorted list of tuples, columns in name order."""
    found = [tuple(r) for r in df.select(*sorted(df.columns)).collect()]
    return sorted(found, key=repr)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
