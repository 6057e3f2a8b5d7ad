from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from vintara.config.lca import LCA, LCA_ALIASES, LCA_COLUMNS, LCA_LABELS, REPEATED_GROUPS, SECOND_SITE, is_repeat
from vintara.config.perm import PERM, PERM_COLUMNS, PERM_LABELS, PERM_LITERAL
from vintara.config.wages import WAGE_RENAMES
from vintara.operators import harmonise as h


def test_sizes_of_the_fixed_tables():
    assert len(LCA_COLUMNS) == len(set(LCA_COLUMNS)) == 107
    assert len(PERM_COLUMNS) == len(set(PERM_COLUMNS)) == 252
    assert len(LCA_ALIASES) == 96 and sum(a != b for a, b in LCA_ALIASES.items()) == 94
    assert len(LCA_LABELS) == 36 and len(PERM_LABELS) == 6
    assert len(REPEATED_GROUPS) == 21 and len(SECOND_SITE) == 15
    assert len(WAGE_RENAMES) == 44
    assert set(LCA_LABELS) <= set(LCA_COLUMNS) and set(PERM_LABELS) <= set(PERM_COLUMNS)
    assert set(LCA_ALIASES.values()) <= set(LCA_COLUMNS)


def test_literal_policy_loses_the_columns_aliased_to_themselves():
    live = h.candidates(PERM_COLUMNS, PERM_LITERAL)
    assert len(live) == 169
    assert PERM_COLUMNS[live["pw_track_number"][0]] == "job_opp_pwd_number"
    assert "emp_poc_email" not in live and "emp_business_name" not in live
    assert len(h.candidates(PERM_COLUMNS, PERM)) == 252
    assert "pw_track_number" not in h.candidates(["pw_track_number"], PERM_LITERAL)


def test_dropped_columns():
    dropped = ["worksite_city_2", "wage_rate_of_pay_from_10", "pw_survey_name_3", "wage_rate_2", "city_2", "pw_unit_2"]
    kept = ["worksite_city_1", "wage_rate_1", "city_1", "lca_case_workloc2_city", "work_location_city2", "address2"]
    assert [n for n in dropped + kept if is_repeat(n)] == dropped


def test_first_of_repeated_names_wins_and_unnamed_are_left_out():
    header = ["Status", "status ", "Unnamed: 7", "", "CASE NO", "Wage_Rate_2"]
    assert h.usable_columns(header, LCA) == {"status": 0, "case_no": 4}


def one_file(spark, columns, rows):
    schema = ", ".join(f"c{i} string" for i in range(len(columns)))
    return spark.createDataFrame(rows, schema).toDF(*columns)


def test_output_is_the_canonical_schema(spark):
    df = one_file(spark, ["CASE NO", "x.y", "Case-Status"], [("1", "z", "ok")])
    out = h.harmonise(df, LCA, {"year": F.lit("2020")})
    assert out.columns == LCA_COLUMNS
    row = out.collect()[0]
    assert (row["case_number"], row["case_status"], row["year"]) == ("1", "ok", "2020")
    assert sum(v is not None for v in row) == 3


def test_duplicate_and_case_insensitive_names(spark):
    df = one_file(spark, ["STATUS", "status", "Status"], [(None, "b", "c"), ("a", "b", "c")])
    out = h.harmonise(df, LCA).select("case_status").collect()
    assert [r[0] for r in out] == [None, "a"]


def test_empty_column_does_not_shadow_but_a_null_in_the_winner_stays(spark):
    columns = ["WAGE_RATE_OF_PAY_FROM_1", "LCA_CASE_WAGE_RATE_FROM", "WAGE_RATE_1"]
    out = h.harmonise(one_file(spark, columns, [(None, None, "3"), (None, "2", "4")]), LCA)
    assert [r[0] for r in out.select("wage_rate_of_pay_from").collect()] == [None, "2"]


def test_each_file_has_its_own_empty_columns(spark):
    df = one_file(spark, ["file", "A", "B"], [("x", None, "1"), ("x", None, None), ("y", "2", "3"), ("y", None, "4"), ("z", None, None)])
    layout = h.Layout(columns=["t"], aliases={"a": "t", "b": "t"})
    out = h.harmonise(df, layout, keep=["file"], file="file")
    got = sorted((r["file"], r["t"] or "") for r in out.collect())
    assert got == [("x", ""), ("x", "1"), ("y", ""), ("y", "2"), ("z", "")]


def test_harmonise_is_idempotent(spark):
    for layout, columns in ((LCA, ["CASE NO", "STATUS", "NAME"]), (PERM, ["CASE_NUMBER", "EMPLOYER_NAME", "JOB_OPP_PWD_NUMBER"])):
        once = h.harmonise(one_file(spark, columns, [("1", "a", "b"), ("2", None, "c")]), layout)
        assert once.exceptAll(h.harmonise(once, layout)).count() == 0


def test_coalesce_and_fallback(spark):
    df = one_file(spark, ["a", "b"], [(None, "1"), ("2", "3")])
    layout = h.Layout(columns=["t"], aliases={"a": "t", "b": "t"}, policy="coalesce")
    assert [r[0] for r in h.harmonise(df, layout).collect()] == ["1", "2"]
    out = h.harmonise(one_file(spark, ["pw_track_number", "job_opp_pwd_number"], [(None, "j"), ("p", "k")]), PERM)
    assert [r[0] for r in out.select("pw_track_number").collect()] == ["j", "p"]


def test_one_projection_and_no_python(spark):
    df = one_file(spark, ["CASE NO", "STATUS"], [("1", "a")])
    plan = h.harmonise(df, LCA)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_union_keeps_all_rows(spark):
    a = one_file(spark, ["x"], [("1",), ("1",)])
    b = one_file(spark, ["y"], [("2",)])
    assert h.union_all([a, b]).count() == 3
    with pytest.raises(ValueError):
        h.union_all([])


def test_empty_columns_per_file(spark):
    df = one_file(spark, ["file", "a", "b"], [("x", None, "1"), ("y", "2", None)])
    assert sorted(map(tuple, h.empty_columns(df, "file").collect())) == [("x", "a"), ("y", "b")]
