import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from ordermart.session import DEFAULT_CONF, prepare

    builder = (SparkSession.builder.master("local[4]").appName("ordermart-tests")
               .config("spark.sql.shuffle.partitions", "4"))
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    prepare(s)
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="ordermart-test-")
