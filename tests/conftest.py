import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

FIXTURES = os.path.join(os.path.dirname(os.path.abspath(__file__)), "fixtures")
SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from issuelens.session import DEFAULT_CONF
    builder = SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    if s.sparkContext.getCheckpointDir() is None:   # tests set their own shared folder
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="issuelens-test-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def pages_dir():
    return os.path.join(FIXTURES, "pages")
