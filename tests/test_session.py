from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

from vintara import session


ROOT = Path(__file__).resolve().parent.parent


class Fake:
    """A session that is not local."""

    def __init__(self, master, named=None):
        self.sparkContext = type("C", (), {"master": master, "applicationId": "x"})()
        self.conf = type("F", (), {"get": lambda _, key, default=None: named or default})()


def test_the_named_folder_is_used():
    assert session.shared_folder(Fake("spark://c", "s3://b/checkpoints")) == "s3://b/checkpoints"


def test_a_cluster_without_one_is_refused():
    with pytest.raises(ValueError):
        session.shared_folder(Fake("spark://c"))


def test_settled_rows_are_equal_and_have_no_lineage(spark):
    df = spark.range(100).selectExpr("id", "id % 7 AS k").groupBy("k").count()
    settled = session.settle(df)
    assert settled.exceptAll(df).count() == 0 and settled.schema.names == df.schema.names
    assert "Exchange" not in settled._jdf.queryExecution().executedPlan().toString()


def test_tune_applies_every_setting(spark):
    session.tune(spark)
    assert all(spark.conf.get(k) == v for k, v in session.SETTINGS.items())


def test_tasks_do_not_need_the_package(tmp_path):
    """Executors get the functions they run, not an installed package."""
    code = f"""
import sys; sys.path.insert(0, {str(ROOT)!r})
from pyspark.sql import SparkSession
from vintara.catalog import files
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
for name in ("zip_members", "xlsx_cells"):
    assert getattr(files, name)(spark, "/root/testdata/sf0.001").count() > 0
"""
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, capture_output=True, timeout=300)
