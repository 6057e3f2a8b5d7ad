from __future__ import annotations

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from vintara.config.values import LCA_STATUS, NA_TOKENS, PAY_UNIT, PERM_STATUS, VISA_CLASS, YES_NO
from vintara.functions import text, typed


def one(spark, values, make):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, v string").select("i", make("v").alias("out"))
    return [r["out"] for r in df.orderBy("i").collect()]


def test_strip_removes_what_python_removes(spark):
    random.seed(1)
    spaces = [chr(i) for i in range(0x3001) if chr(i).isspace()]
    letters = list("aé​﻿0-_") + spaces
    values = ["".join(random.choices(letters, k=random.randint(0, 9))) for _ in range(400)]
    assert one(spark, values, text.strip) == [v.strip() for v in values]


def test_squeeze(spark):
    values = ["  a  \t b\n", "", None, "x y", "\x1c z \x1d\x1e w"]
    assert one(spark, values, text.squeeze) == ["a b", "", "", "x y", "z w"]


def test_missing_tokens_are_exact(spark):
    assert len(NA_TOKENS) == 19
    assert one(spark, NA_TOKENS, text.na_to_null) == [None] * 19
    assert one(spark, ["NAN", "NONE", " NA", "none"], text.na_to_null) == ["NAN", "NONE", " NA", "none"]


def test_status(spark):
    values = [" certified ", "CERTIFIED-WITHDRAWN", "certified - withdrawn", "Pending", "nan", "", None, "Certified-Expired"]
    assert one(spark, values, lambda c: text.upper_code(c, LCA_STATUS)) == [
        "Certified", "Certified - Withdrawn", "Certified - Withdrawn", "PENDING", None, None, None, "Certified - Expired"]
    assert one(spark, values[1:2], lambda c: text.upper_code(c, PERM_STATUS)) == ["CERTIFIED-WITHDRAWN"]


def test_exact_case_codes(spark):
    assert one(spark, ["R ", "r", "H-1B", "NAN", None], lambda c: text.plain_code(c, VISA_CLASS)) == [
        "H-1B", "r", "H-1B", None, None]
    assert one(spark, ["yr", "HOUR", "BI-WEEKLY", "HR", "Year"], lambda c: text.plain_code(c, PAY_UNIT)) == [
        "Year", "Hour", "Bi-Weekly", "HR", "Year"]
    assert one(spark, ["Y", "n", "1.0", "0", "Yes", "N/A"], lambda c: text.plain_code(c, YES_NO)) == [
        "Yes", "No", "Yes", "No", "Yes", "N/A"]


def test_clean_text_keeps_none_word(spark):
    assert one(spark, [" x ", "nan", "NAN", " ", "NONE"], text.clean_text) == ["x", None, None, None, "NONE"]


def test_headers_as_text_and_column_agree(spark):
    headers = [" Case Status ", "H-1B_DEPENDENT", "Unnamed: 3", "unnamed", "a  b-C", "", " X"]
    assert one(spark, headers, text.normalise_header) == [text.normalise_header_text(h) for h in headers]


def test_dates(spark):
    values = ["2019-01-02", "2019-01-02 00:00:00", "1/2/2019", "12/31/2019", "7-Mar-09", "43831", "12:30", "bad", "", None,
              "2019-02-30", "2019-1-2", " 2019-01-02 "]
    day = datetime(2019, 1, 2)
    assert one(spark, values, typed.parse_date) == [
        day, day, day, datetime(2019, 12, 31), datetime(2009, 3, 7), datetime(2020, 1, 1), None, None, None, None, None,
        None, day]
    assert one(spark, values[:3], lambda c: typed.parse_date(c, ["yyyy-MM-dd"])) == [day, None, None]


def test_dates_in_the_layout_of_the_first(spark):
    df = spark.createDataFrame(
        [(2, "2019-01-02 00:00:00"), (1, "2019-01-02"), (0, None), (3, "2020-05-06")], "i int, v string")
    got = df.select("i", typed.parse_like_first(df, "v", "i").alias("out")).orderBy("i").collect()
    assert [r["out"] for r in got] == [None, datetime(2019, 1, 2), None, datetime(2020, 5, 6)]


def test_numbers(spark):
    values = ["1e3", " 7 ", "1,000", "$3", "5D", "inf", ".5", "5.", "-2.5", "+1", "1e", "", None, "NaN", "0x1", "1f"]
    assert one(spark, values, typed.parse_number) == [
        1000.0, 7.0, None, None, None, None, 0.5, 5.0, -2.5, 1.0, None, None, None, None, None, None]


def test_flags(spark):
    assert one(spark, ["1", "15", "1.5", "0.0", "Y", None], typed.parse_flag) == [1, 15, None, 0, None, None]
    assert one(spark, ["1", "1.5", "Y", None], typed.flag_rejected) == [False, True, False, False]


def test_case_key(spark):
    assert one(spark, [" i-1 ", None], lambda c: text.case_key(c, null_as="NAN")) == ["I-1", "NAN"]
    assert one(spark, [" i-1", None], lambda c: text.case_key(c, trim=False)) == [" I-1", None]


def test_bind_evaluates_to_its_body(spark):
    assert one(spark, ["a", None], lambda c: text.bind(F.col(c), lambda v: F.concat(v, v))) == ["aa", None]


@pytest.mark.parametrize("name", ["a.b", "with `tick`", "blank name"])
def test_quoted_names(spark, name):
    df = spark.createDataFrame([(1,)], "x int").toDF(name)
    assert df.select(text.quoted(name)).collect()[0][0] == 1
