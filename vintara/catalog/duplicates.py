"""Queries that remove duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintara.catalog import derive, derive_sql, query, table
from vintara.operators import dedup

KEYED = {
    "event_id": "event_id", "event_type": "event_type", "value": "value",
    "key": "CASE WHEN user_id % 13 = 0 THEN NULL ELSE 'u-' || cast(user_id as string) END",
}
BLOCK = 500


@query(f"""SELECT event_id, event_type, value, "key" FROM {derive_sql('events', KEYED)}
QUALIFY row_number() OVER (PARTITION BY "key" ORDER BY event_id) = 1""")
def dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First row of each key, null being one key."""
    return dedup.keep_first(derive(table(spark, sf_dir, "events"), KEYED), ["key"], ["event_id"])


@query(f"""SELECT event_id, event_type, value, "key" FROM {derive_sql('events', KEYED)}
QUALIFY "key" IS NULL OR row_number() OVER (PARTITION BY "key" ORDER BY event_id) = 1""")
def dedup_first_keep_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First row of each key; rows without a key all stay."""
    rows = derive(table(spark, sf_dir, "events"), KEYED)
    return dedup.keep_first(rows, ["key"], ["event_id"], null_keys="keep")


@query(f"""SELECT event_id, event_type, value, "key" FROM {derive_sql('events', KEYED)}
QUALIFY min(event_id // {BLOCK}) OVER (PARTITION BY coalesce("key", 'NAN')) = event_id // {BLOCK}""")
def dedup_chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in the block of positions where their key first appears."""
    rows = derive(table(spark, sf_dir, "events"), KEYED)
    return dedup.keep_first_block(rows, "key", "event_id", BLOCK)


LINES = {
    "flag": "l_returnflag", "status": "CASE WHEN l_linestatus = 'O' THEN l_linestatus END",
    "number": "l_linenumber", "quantity": "l_quantity", "discount": "l_discount",
}


@query(f"SELECT DISTINCT * FROM {derive_sql('lineitem', LINES)}")
def dedup_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct rows, nulls equal."""
    return dedup.distinct_rows(derive(table(spark, sf_dir, "lineitem"), LINES))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) = 1""")
def dedup_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First shipped line of each (order, line number)."""
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]
    return dedup.keep_first(rows, ["l_orderkey", "l_linenumber"], order).drop("l_shipdate")


ROW_FILES = {"vintage": "event_type", "file": "'f' || cast(user_id % 10 as string)"}


@query("""
WITH raw AS (SELECT event_type AS vintage, 'f' || cast(user_id % 10 as string) AS file, count(*) AS n
             FROM events GROUP BY ALL)
SELECT vintage, file, n AS "rows", cast(sum(n) OVER (ORDER BY vintage, file) - n AS BIGINT) AS first_position FROM raw""")
def row_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each file starts among all rows, in file order."""
    rows = derive(table(spark, sf_dir, "events"), {**ROW_FILES, "row": "event_id - event_id"})
    placed = dedup.global_positions(rows, "vintage", "file", "row")
    return placed.groupBy("vintage", "file").agg(
        F.count("*").alias("rows"), F.min("position").alias("first_position"))
