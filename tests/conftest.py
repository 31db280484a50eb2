import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from ledgerlake.session import JOB_CONF
    b = (SparkSession.builder.master("local[*]").appName("ledgerlake-tests")
         .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
         .config("spark.driver.memory", "4g")
         .config("spark.ui.showConsoleProgress", "false"))
    for k, v in JOB_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    from ledgerlake.sources.tables import use_root
    use_root(s, tempfile.mkdtemp(prefix="ledgerlake-test-ckpt-"))
    yield s


SF_SMALL = "/root/testdata/sf0.001"
