"""The driver loads ``__spark_entry__.py`` by path from another directory with
its own session: executors must still import the package (shipped with
``addPyFile``)."""

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import importlib.util
from pyspark.sql import SparkSession
spec = importlib.util.spec_from_file_location("__spark_entry__", "{ROOT}/__spark_entry__.py")
m = importlib.util.module_from_spec(spec)
spec.loader.exec_module(m)
spark = (SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.enabled", "false").getOrCreate())
assert m.entry(spark).count() == 500 * 64
assert m.queries()["mlp_predict"](spark, "/root/testdata/sf0.001").count() == 6000
print("ok")
"""


def test_entry_from_foreign_directory():
    cwd = tempfile.mkdtemp(prefix="tessera-driver-", dir="/tmp")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True,
                         text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-3000:]
    assert out.stdout.strip().endswith("ok")
