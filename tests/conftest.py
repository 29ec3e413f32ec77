import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from paylake.session import configure
    s = (SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
         .config("spark.driver.memory", "6g")
         .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="paylake-test-"))
    configure(s)
    yield s


@pytest.fixture(scope="session")
def duck_small():
    from paylake.tools.oracle_check import duck_connect
    return duck_connect(SF_SMALL)
