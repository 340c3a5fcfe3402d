import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from farelane.session import SCALE_CONF, ensure_checkpoint_dir

    b = (SparkSession.builder.master("local[*]").appName("farelane-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         # tests name their own shared folder; a cluster sets spark.checkpoint.dir
         .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="farelane-test-ckpt-")))
    for k, v in SCALE_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF_SMALL


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="farelane-test-")
