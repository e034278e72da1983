import os
import sys
import tempfile

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
for path in (HERE, os.path.dirname(HERE)):
    if path not in sys.path:
        sys.path.insert(0, path)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[*]").appName("lakestrata-tests")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    # tests only: no cluster-provided checkpoint folder, so use a fresh scratch one
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lakestrata-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(params=[True, False], ids=["ansi_on", "ansi_off"])
def ansi(request, spark):
    """Run a test with ANSI mode on and off: results must not depend on it."""
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", str(request.param).lower())
    yield request.param
    spark.conf.set("spark.sql.ansi.enabled", old)


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="lakestrata-test-")
