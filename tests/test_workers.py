"""Queries whose work runs in Python workers (Arrow batches) must run from
any working directory: the package is shipped to the workers, not found
through the driver's current folder."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
import __spark_entry__ as E
for name in ("tokenize", "mlm_mask", "kmer_sketch"):
    print(name, E.queries()[name](spark, "/root/testdata/sf0.001").count())
spark.stop()
"""


def test_arrow_queries_run_outside_the_repo(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env,
                         capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    counts = dict(line.split() for line in out.stdout.strip().splitlines())
    assert set(counts) == {"tokenize", "mlm_mask", "kmer_sketch"}
    assert all(int(v) > 0 for v in counts.values())
