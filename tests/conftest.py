from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC").config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint"))).config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse"))).getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
