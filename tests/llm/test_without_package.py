"""Executors get the functions they run: no query with a Python worker needs the package there."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[2]


def test_tasks_do_not_need_the_package(tmp_path):
    code = f"""
import sys; sys.path.insert(0, {str(ROOT)!r})
from pyspark.sql import SparkSession
import __spark_entry__ as entry
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
missing = []
for name, build in entry.queries().items():
    if name.split("_")[0] in ("op1", "op2", "op4", "op6", "op7", "op9", "op10", "op11", "op12", "op13"):
        build(spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
        missing.append(name)
assert len(missing) == 10, missing
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=400)
    assert done.returncode == 0, done.stderr[-3000:]
