"""Operators run where Python workers cannot import this library: only the driver knows its folder."""

import json
import os
import subprocess
import sys
import tempfile

from tests.conftest import ROOT, SF_SMALL

CODE = """
import json, sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
import __spark_entry__ as E
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
print("RESULT" + json.dumps({k: E.queries()[k](spark, sys.argv[2]).count() for k in E.queries() if k.split("_")[0] in sys.argv[3].split(",")}))
"""


def test_workers_without_the_package():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    # what the driver imports beside the library, workers may import too
    env["PYTHONPATH"] = os.pathsep.join(p for p in sys.path if p and os.path.realpath(p) != os.path.realpath(ROOT))
    p = subprocess.run([sys.executable, "-c", CODE, ROOT, SF_SMALL, "op2,op3,op4,op8,op10,op11,op12,op13"], cwd=tempfile.mkdtemp(), env=env, capture_output=True, text=True, timeout=900)
    assert "RESULT" in p.stdout, p.stderr[-2000:]
    counts = json.loads(p.stdout.rpartition("RESULT")[2])
    assert len(counts) == 8 and all(counts.values()), counts
