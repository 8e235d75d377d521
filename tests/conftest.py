import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = os.environ.get("DWSPARK_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from dwspark.session import BASE_CONF, ensure_checkpoint_dir

    b = SparkSession.builder.master("local[*]").appName("dwspark-tests")
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    s = b.config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g").getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="dwspark-test-")


@pytest.fixture(scope="session")
def sf_dir():
    return SF_SMALL
