import os

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "3g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared"))).getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def sf():
    d = "/root/testdata/sf0.001"
    if not os.path.isdir(d):
        pytest.skip("driver tables are not here")
    return d
