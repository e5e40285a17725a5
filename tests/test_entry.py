"""The entry module works from any folder, as the driver loads it."""

import os
import subprocess
import sys

SCRIPT = """
import importlib.util
spec = importlib.util.spec_from_file_location("entry_module", {path!r})
module = importlib.util.module_from_spec(spec)
spec.loader.exec_module(module)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
print("ROWS", module.entry(spark).count(), module.queries()["alert_times"](spark, {sf!r}).count())
"""


def test_queries_run_without_the_package_on_the_workers(sf, tmp_path):
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(path=path, sf=sf)],
        cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300,
    )
    assert done.returncode == 0, done.stderr[-2000:]
    rows = done.stdout.split("ROWS ")[1].split()
    assert int(rows[0]) == 15 and int(rows[1]) > 0
