"""The pandas paths must work when the driver runs outside the repository
(Python workers import the package shipped with ``addPyFile``)."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import importlib.util
spec = importlib.util.spec_from_file_location("entry_mod", {os.path.join(REPO, "__spark_entry__.py")!r})
m = importlib.util.module_from_spec(spec)
spec.loader.exec_module(m)
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
q = m.queries()
print("answers", q["answer_table"](spark, "/root/testdata/sf0.001").count())
print("stall", q["stream_stall"](spark, "/root/testdata/sf0.001").count())
spark.stop()
"""


def test_pandas_paths_from_another_directory():
    cwd = tempfile.mkdtemp(prefix="qaspark-cwd-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    res = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True, text=True,
                         timeout=600)
    assert res.returncode == 0, res.stderr[-2000:]
    lines = dict(line.split() for line in res.stdout.splitlines() if line.startswith(("answers", "stall")))
    assert int(lines["answers"]) > 0 and int(lines["stall"]) > 0
