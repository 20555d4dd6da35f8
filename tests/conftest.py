import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from pricelake.session import configure, release_scratch

    ckpt = tempfile.mkdtemp(prefix="pricelake-test-ckpt-")
    s = (
        SparkSession.builder.master("local[*]")
        .appName("pricelake-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None) and not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(ckpt)  # only where the session names no shared folder
    configure(s)
    yield s
    release_scratch(s)
