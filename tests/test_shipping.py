"""Executors do not import the package: a job started elsewhere still finds its functions."""

import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
from lumetra.operators.similarity import user_pearson
spark = (SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "1").getOrCreate())
rows = [(u, i, float(u * i % 5)) for u in range(4) for i in range(6)]
print("pairs", user_pearson(spark.createDataFrame(rows, "user int, item int, rating double")).count())
"""


def test_python_workers_need_no_import_of_the_package(tmp_path):
    repo = str(Path(__file__).resolve().parent.parent)
    run = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(repo=repo)], cwd=tmp_path, capture_output=True, text=True, timeout=300
    )
    assert "pairs 6" in run.stdout, run.stderr[-2000:]
