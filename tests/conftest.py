import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from tabulon.session import DEFAULT_CONF
    b = SparkSession.builder.master("local[4]").appName("tabulon-tests")
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "4g")
    # tests run without a cluster-provided checkpoint folder: use a fresh one
    b = b.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tabulon-test-ckpt-"))
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_fresh():
    return tempfile.mkdtemp(prefix="tabulon-test-")
