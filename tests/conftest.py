from pathlib import Path

import pytest
from pyspark.sql import SparkSession

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (SparkSession.builder.master("local[4]").appName("tabkit-tests")
               .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
               .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "6g")
               .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints"))).getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    if not Path(SMALL).exists():
        pytest.skip("test tables are not here")
    return SMALL
