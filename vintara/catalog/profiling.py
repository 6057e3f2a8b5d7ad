"""Queries that describe tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vintara.catalog import derive, derive_sql, query, table
from vintara.operators import dedup, profile

LINES = {
    "flag": "l_returnflag", "status": "CASE WHEN l_linestatus = 'O' THEN l_linestatus END",
    "number": "cast(l_linenumber as string)",
}


@query(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {c} AS value, count(*) AS \"rows\" FROM {derive_sql('lineitem', LINES)} "
    f"WHERE {c} IS NOT NULL GROUP BY {c}" for c in LINES))
def freq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Value counts of several columns."""
    return profile.frequencies(derive(table(spark, sf_dir, "lineitem"), LINES), list(LINES))


@query("""SELECT year(o_orderdate) AS value, count(*) AS "rows" FROM orders GROUP BY ALL""")
def freq_by_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per year, by year."""
    rows = derive(table(spark, sf_dir, "orders"), {"year": "cast(year(o_orderdate) as bigint)"})
    return profile.frequency(rows, "year", by_value=True)


@query("""SELECT o_custkey AS value, count(*) AS "rows" FROM orders WHERE o_custkey IS NOT NULL
GROUP BY o_custkey ORDER BY "rows" DESC, value LIMIT 10""")
def freq_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten most frequent values (a report of ten lines)."""
    return profile.frequency(table(spark, sf_dir, "orders"), "o_custkey", top=10)


@query("SELECT min(l_shipdate) AS first_value, max(l_shipdate) AS last_value FROM lineitem")
def date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and last date."""
    return profile.value_range(table(spark, sf_dir, "lineitem"), "l_shipdate")


GAPS = {
    "event_id": "event_id",
    "user": "CASE WHEN user_id % 4 <> 0 THEN user_id END",
    "click_value": "CASE WHEN event_type = 'click' THEN value END",
    "props": "props",
    "never": "CASE WHEN value < 0 THEN props END",
}


@query(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count(\"{c}\") AS null_rows, "
    f"round(100.0::DOUBLE * (count(*) - count(\"{c}\")) / count(*), 4) AS null_percent FROM {derive_sql('events', GAPS)}"
    for c in GAPS))
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of nulls per column."""
    return profile.null_shares(derive(table(spark, sf_dir, "events"), GAPS))


DETAIL = {"flag": "l_returnflag", "number": "l_linenumber", "quantity": "l_quantity"}


@query(f"""
SELECT 0 AS step_no, 'read' AS step, count(*) AS "rows", 3 AS "columns" FROM lineitem
UNION ALL SELECT 1, 'distinct', count(*), 3 FROM (SELECT DISTINCT * FROM {derive_sql('lineitem', DETAIL)})""")
def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and columns before and after removing duplicates."""
    rows = derive(table(spark, sf_dir, "lineitem"), DETAIL)
    return profile.step_counts({"read": rows, "distinct": dedup.distinct_rows(rows)})
