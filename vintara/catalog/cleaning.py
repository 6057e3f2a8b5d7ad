"""Queries over dirty values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vintara.catalog import cases, derive, derive_sql, query, quote, recode_sql, strip_sql, table
from vintara.config.values import LCA_STATUS, NA_TOKENS, PAY_UNIT, PERM_STATUS, VISA_CLASS, YES_NO
from vintara.functions import text, typed


def listed(values: list[str]) -> str:
    return ", ".join(quote(v) for v in values)


def clean_text_sql(c: str) -> str:
    return f"CASE WHEN {strip_sql(c)} NOT IN ('nan', 'NAN', '') THEN {strip_sql(c)} END"


def upper_code_sql(c: str, mapping: dict[str, str] | None = None) -> str:
    value = f"upper({strip_sql(c)})"
    return f"CASE WHEN {value} NOT IN ('NAN', '') THEN {recode_sql(value, mapping) if mapping else value} END"


def plain_code_sql(c: str, mapping: dict[str, str]) -> str:
    value = strip_sql(c)
    return f"CASE WHEN {value} NOT IN ('nan', 'NAN', '') THEN {recode_sql(value, mapping)} END"


NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def number_sql(c: str) -> str:
    value = strip_sql(c)
    return f"CASE WHEN regexp_matches({value}, '{NUMBER}') THEN try_cast({value} AS DOUBLE) END"


DATE_SQL = (
    "coalesce(try_strptime({c}, '%Y-%m-%d %H:%M:%S'), try_strptime({c}, '%Y-%m-%d'), "
    "try_strptime({c}, '%m/%d/%Y'), try_strptime({c}, '%d-%b-%y'), "
    "CASE WHEN regexp_matches({c}, '^[0-9]{{5}}$') "
    "THEN (DATE '1899-12-30' + try_cast({c} AS INTEGER))::TIMESTAMP END)"
)

TOKENS = {"doc_id": "doc_id", "cell": cases("doc_id % 25", NA_TOKENS + ["NAN", "NONE"], "text"), "body": "text"}


@query(f"""SELECT doc_id, CASE WHEN cell NOT IN ({listed(NA_TOKENS)}) THEN cell END AS value,
  CASE WHEN body NOT IN ({listed(NA_TOKENS)}) THEN body END AS body
FROM {derive_sql('documents', TOKENS)}""")
def na_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing-value tokens become null."""
    return derive(table(spark, sf_dir, "documents"), TOKENS).select(
        "doc_id", text.na_to_null("cell").alias("value"), text.na_to_null("body").alias("body"))


PADDED = {
    "doc_id": "doc_id",
    "cell": "chr(160) || ' ' || chr(9) || text || chr(13) || chr(10) || chr(160)",
    "mark": "chr(160) || " + cases("doc_id % 11", ["nan", "NAN", "", "NONE"], "source") + " || chr(9)",
}
_RUN = r"[\t\n\x0b\x0c\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


@query(f"""SELECT doc_id, {clean_text_sql('cell')} AS value, {clean_text_sql('mark')} AS mark,
regexp_replace({strip_sql('cell')}, '{_RUN}', ' ', 'g') AS squeezed
FROM {derive_sql('documents', PADDED)}""")
def strip_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts stripped of any whitespace, blanks to null; runs of whitespace collapsed."""
    return derive(table(spark, sf_dir, "documents"), PADDED).select(
        "doc_id", text.clean_text("cell").alias("value"), text.clean_text("mark").alias("mark"), text.squeeze("cell").alias("squeezed"))


_STATUSES = [" certified ", "CERTIFIED-EXPIRED", "Certified - Expired", "CERTIFIED-WITHDRAWN",
             "certified - withdrawn", "denied", "Withdrawn", "INVALIDATED", "nan", "", "Pending"]
STATUS = {"o_orderkey": "o_orderkey", "code": cases("o_orderkey % 13", _STATUSES, "o_orderstatus")}


@query(f"""SELECT o_orderkey, {upper_code_sql('code', LCA_STATUS)} AS lca_status,
{upper_code_sql('code', PERM_STATUS)} AS perm_status FROM {derive_sql('orders', STATUS)}""")
def status_std(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Case status under both programs' dictionaries."""
    return derive(table(spark, sf_dir, "orders"), STATUS).select(
        "o_orderkey", text.upper_code("code", LCA_STATUS).alias("lca_status"),
        text.upper_code("code", PERM_STATUS).alias("perm_status"))


CODES = {
    "event_id": "event_id",
    "visa": cases("event_id % 9", [" R", "A", "S ", "C", "r", "H-1B", "NAN", ""], "event_type"),
    "unit": cases("event_id % 19", list(PAY_UNIT) + ["HR", " Year "], "event_type"),
    "answer": cases("event_id % 14", list(YES_NO) + ["", "Maybe ", "nan"], "event_type"),
    "form": cases("event_id % 5", [" old", "New ", "nan", ""], "event_type"),
}


@query(f"""SELECT event_id, {plain_code_sql('visa', VISA_CLASS)} AS visa, {plain_code_sql('unit', PAY_UNIT)} AS unit,
{plain_code_sql('answer', YES_NO)} AS answer, {upper_code_sql('form')} AS form FROM {derive_sql('events', CODES)}""")
def codes_std(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visa class, pay unit, yes/no and form codes."""
    return derive(table(spark, sf_dir, "events"), CODES).select(
        "event_id", text.plain_code("visa", VISA_CLASS).alias("visa"),
        text.plain_code("unit", PAY_UNIT).alias("unit"),
        text.plain_code("answer", YES_NO).alias("answer"), text.upper_code("form").alias("form"))


_ISO = "cast(cast(l_shipdate as date) as string)"
DATES = {
    "l_orderkey": "l_orderkey", "l_linenumber": "l_linenumber",
    "cell": f"CASE l_orderkey % 7 WHEN 0 THEN {_ISO} || ' 00:00:00' WHEN 1 THEN cast(month(l_shipdate) as string) || '/' "
            "|| cast(day(l_shipdate) as string) || '/' || cast(year(l_shipdate) as string) WHEN 2 THEN '12:30' "
            "WHEN 3 THEN cast(40000 + l_partkey % 9999 as string) WHEN 4 THEN '7-Mar-09' WHEN 5 THEN 'bad' "
            f"ELSE {_ISO} END",
}


@query(f"""SELECT l_orderkey, l_linenumber, {DATE_SQL.format(c='cell')} AS value,
coalesce(try_strptime(cell, '%Y-%m-%d')) AS iso_only FROM {derive_sql('lineitem', DATES)}""")
def date_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates in several layouts; anything else is null."""
    return derive(table(spark, sf_dir, "lineitem"), DATES).select(
        "l_orderkey", "l_linenumber", typed.parse_date("cell").alias("value"),
        typed.parse_date("cell", ["yyyy-MM-dd"], serials=False).alias("iso_only"))


@query(f"""
WITH raw AS {derive_sql('orders', {'o_orderkey': 'o_orderkey', 'cell': "CASE o_orderkey % 3 WHEN 2 THEN cast(cast(o_orderdate as date) as string) WHEN 1 THEN cast(cast(o_orderdate as date) as string) || ' 00:00:00' END"})},
first AS (SELECT min_by(cell, o_orderkey) FILTER (cell IS NOT NULL) AS cell FROM raw)
SELECT o_orderkey, CASE WHEN try_strptime((SELECT cell FROM first), '%Y-%m-%d %H:%M:%S') IS NOT NULL
  THEN try_strptime(cell, '%Y-%m-%d %H:%M:%S') ELSE try_strptime(cell, '%Y-%m-%d') END AS value FROM raw""")
def date_like_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only dates in the layout of the first value."""
    iso = "cast(cast(o_orderdate as date) as string)"
    rows = derive(table(spark, sf_dir, "orders"), {
        "o_orderkey": "o_orderkey",
        "cell": f"CASE o_orderkey % 3 WHEN 2 THEN {iso} WHEN 1 THEN {iso} || ' 00:00:00' END"})
    return rows.select("o_orderkey", typed.parse_like_first(rows, "cell", "o_orderkey").alias("value"))


NUMBERS = {
    "event_id": "event_id",
    "cell": cases("event_id % 16", ["5D", "1,000", "$3", "1e3", " 7 ", ".5", "5.", "+4", "--1", "inf", ""],
                  "cast(cast(value as decimal(12,2)) as string)"),
}


@query(f"SELECT event_id, {number_sql('cell')} AS value FROM {derive_sql('events', NUMBERS)}")
def num_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain decimals as doubles; anything else is null."""
    return derive(table(spark, sf_dir, "events"), NUMBERS).select(
        "event_id", typed.parse_number("cell").alias("value"))


FLAGS = {
    "doc_id": "doc_id",
    "cell": cases("doc_id % 7", ["15", "1.5", "Y", " 1.0 "], "cast(quality as string)"),
}
_FLAG = number_sql("cell")


@query(f"""SELECT doc_id, CASE WHEN {_FLAG} = floor({_FLAG}) THEN cast({_FLAG} AS BIGINT) END AS flag,
coalesce({_FLAG} <> floor({_FLAG}), false) AS rejected FROM {derive_sql('labels', FLAGS)}""")
def int_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole-number flags; fractions are null and marked."""
    return derive(table(spark, sf_dir, "labels"), FLAGS).select(
        "doc_id", typed.parse_flag("cell").alias("flag"), typed.flag_rejected("cell").alias("rejected"))


KEYS = {
    "o_orderkey": "o_orderkey",
    "cell": "CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE chr(160) || 'i-' || o_orderstatus || cast(o_custkey as string) || ' ' END",
}


@query(f"""SELECT o_orderkey, upper({strip_sql('cell')}) AS case_key, upper(cell) AS case_key_as_is,
coalesce(upper({strip_sql('cell')}), 'NAN') AS grouping_key FROM {derive_sql('orders', KEYS)}""")
def case_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Case numbers as keys of both programs."""
    return derive(table(spark, sf_dir, "orders"), KEYS).select(
        "o_orderkey", text.case_key("cell").alias("case_key"),
        text.case_key("cell", trim=False).alias("case_key_as_is"),
        text.case_key("cell", null_as="NAN").alias("grouping_key"))
