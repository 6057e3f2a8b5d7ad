"""Profiles of files from their footers."""

from __future__ import annotations

import datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from vintara.plans import lca
from vintara.sources.footers import count_values, footers_of, profile_files


@pytest.fixture
def files(tmp_path):
    for part in range(3):
        pq.write_table(pa.table({
            "a b": pa.array([None if i % 4 == 0 else f"t{i}" for i in range(100)]), "never": pa.array([None] * 100, pa.string()),
            "n": pa.array(range(part * 100, part * 100 + 100), pa.int32()),
            "day": pa.array([datetime.date(2020, 1 + part, 1 + i % 28) for i in range(100)]),
            "at": pa.array([datetime.datetime(2020, 1 + part, 1 + i % 28) for i in range(100)], pa.timestamp("us"))}),
            tmp_path / f"part-{part}.parquet", row_group_size=30)
    return str(tmp_path)


def _read_schemas(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line.split("ReadSchema:")[1].split()[0] for line in plan.splitlines() if "ReadSchema:" in line]


def test_profile(spark, files):
    got = {r["column_name"]: tuple(r)[1:] for r in profile_files(spark, [files], ["n", "day"]).collect()}
    assert got == {"a b": (300, 75, 25.0, None, None), "never": (300, 300, 100.0, None, None), "n": (300, 0, 0.0, "0", "299"),
                   "day": (300, 0, 0.0, "2020-01-01", "2020-03-28"), "at": (300, 0, 0.0, None, None)}


def test_no_column_is_read(spark, files):
    profile = profile_files(spark, [files], ["n", "day"])
    plan = profile._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)" in plan
    assert all("count(" in s or "min(" in s or "max(" in s for s in _read_schemas(profile)), _read_schemas(profile)


def test_only_columns_without_bounds_are_read(spark, files):
    profile = profile_files(spark, [files], ["n", "at", "a b"])
    assert any(s in ("struct<a", "struct<a b:string,at:timestamp_ntz>") for s in _read_schemas(profile)), _read_schemas(profile)
    got = {r["column_name"]: (r["rows"], r["first_value"], r["last_value"]) for r in profile.collect()}
    assert got["at"] == (300, "2020-01-01 00:00:00", "2020-03-28 00:00:00") and got["a b"] == (300, "t1", "t99")
    assert got["n"] == (300, "0", "299") and got["never"] == (300, None, None)


def test_the_reader_of_other_queries_stays(spark, files):
    footers_of(spark, files)
    assert "FileScan parquet" in spark.read.parquet(files)._jdf.queryExecution().executedPlan().toString()


def test_values_of_each_path(spark, files, tmp_path):
    other = tmp_path / "sub"
    other.mkdir()
    pq.write_table(pa.table({"x": [1, None], "y": ["a", "b"]}), other / "f.parquet", write_statistics=False)
    whole = {f"{files}/part-0.parquet": ["a b", "never"], f"{files}/part-1.parquet": ["n"]}
    assert count_values(spark, whole) == {f"{files}/part-0.parquet": {"a b": 75, "never": 0}, f"{files}/part-1.parquet": {"n": 100}}
    assert count_values(spark, {str(other): ["x", "y"]}) == {str(other): {"x": 1, "y": 2}}  # no counts in the footer
    assert count_values(spark, {}) == {}


def test_contested_columns_cost_no_pass(spark, tmp_path):
    names = ["CASE_NUMBER", "WAGE_RATE_OF_PAY_FROM", "WAGE_RATE_OF_PAY_FROM_1"]
    rows = {"2018/a b.parquet": [("1", None, "10")], "2019/c.parquet": [("2", "20", "21")], "2020/d.parquet": [("3", None, None)]}
    for path, values in rows.items():
        (tmp_path / path).parent.mkdir(parents=True, exist_ok=True)
        pq.write_table(pa.table({n: pa.array([v[i] for v in values], pa.string()) for i, n in enumerate(names)}), tmp_path / path)
    compiled = lca.compile_lca(spark, str(tmp_path)).select("case_number", "wage_rate_of_pay_from")
    assert sorted(map(tuple, compiled.collect())) == [("1", "10"), ("2", "20"), ("3", None)]
    plan = lca.compile_lca(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") <= 3, plan  # rows once, keys twice
