"""Every query runs, and matches its SQL twin, in a session that has none of the library's own settings."""

import json
import os
import subprocess
import sys

from tests.conftest import ROOT, SF_SMALL

CODE = """
import json, sys
from pyspark.sql import SparkSession
import __spark_entry__ as E
from tests.oracle_check import compare, duck
spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "8").getOrCreate()
con, out = duck(sys.argv[1]), {}
for key in sys.argv[2].split(","):
    r = compare(spark, con, key, sys.argv[1]) if key in E.oracle_sql() else {"status": "ok" if E.queries()[key](spark, sys.argv[1]).count() else "EMPTY"}
    out[key] = r["status"]
print("RESULT" + json.dumps(out))
"""


def test_model_queries_run_in_a_plain_session():
    keys = ["local_tree_models", "local_tree_predictions", "tree_root_split", "local_tree_gaps", "local_lr_gaps", "feature_votes",
            "global_lr_rmse", "feature_votes_small", "correlation_matrix_wide", "context_features", "train_test_split"]
    env = os.environ | {"PYTHONPATH": os.pathsep.join([ROOT, *filter(None, sys.path)])}  # whatever this process can import
    p = subprocess.run([sys.executable, "-c", CODE, SF_SMALL, ",".join(keys)], cwd=ROOT, env=env, capture_output=True, text=True, timeout=600)
    assert "RESULT" in p.stdout, p.stderr[-2000:]
    got = json.loads(p.stdout.rpartition("RESULT")[2])
    assert got == dict.fromkeys(keys, "ok")
