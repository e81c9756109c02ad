import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    # tests are the one place that sets its own checkpoint folder
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="partyfold-test-ckpt-"))
    yield s


@pytest.fixture(scope="session")
def conf():
    from partyfold.sources.conf import Conf
    return Conf.default()


def one_col(spark, values, name="v"):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")
