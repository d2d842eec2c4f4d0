import os
import sys
import tempfile

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from pyspark.sql import SparkSession  # noqa: E402

@pytest.fixture(scope="session")
def spark():
    s = (SparkSession.builder.master("local[4]").appName("funnelspark-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    from funnelspark.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(s, tempfile.mkdtemp(prefix="funnelspark-test-ckpt-"))
    yield s
