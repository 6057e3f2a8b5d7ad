"""Profiles of a table: frequencies, ranges, empty shares, counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintara.functions.text import quoted


def frequencies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Counts of the non-null values of each column, most frequent first.

    All columns share one scan and one shuffle of partial counts.
    """
    long = df.select(*[F.col(quoted(c)).cast("string").alias(c) for c in columns]).unpivot(
        [], list(columns), "column_name", "value"
    )
    return (
        long.where("value IS NOT NULL")
        .groupBy("column_name", "value")
        .agg(F.count("*").alias("rows"))
        .orderBy("column_name", F.desc("rows"), "value")
    )


def frequency(df: DataFrame, column: str, by_value: bool = False, top: int | None = None) -> DataFrame:
    """Counts of a column's non-null values, by count or by value; ``top`` is the report size."""
    c = F.col(quoted(column))
    counted = df.where(c.isNotNull()).groupBy(c.alias("value")).agg(F.count("*").alias("rows"))
    ordered = counted.orderBy("value") if by_value else counted.orderBy(F.desc("rows"), "value")
    return ordered if top is None else ordered.limit(top)


def value_range(df: DataFrame, column: str) -> DataFrame:
    c = F.col(quoted(column))
    return df.agg(F.min(c).alias("first_value"), F.max(c).alias("last_value"))


def null_shares(df: DataFrame) -> DataFrame:
    """Percentage of nulls per column, highest first: one aggregate row, turned."""
    names = df.columns
    counted = df.agg(
        F.count("*").alias("_rows"), *[F.count(F.col(quoted(c))).alias(c) for c in names]
    )
    share = F.round(100.0 * (F.col("_rows") - F.col("filled")) / F.nullif(F.col("_rows"), F.lit(0)), 4)
    return (
        counted.unpivot(["_rows"], [F.col(quoted(c)) for c in names], "column_name", "filled")
        .select("column_name", (F.col("_rows") - F.col("filled")).alias("null_rows"),
                share.alias("null_percent"))
        .orderBy(F.desc("null_percent"), "column_name")
    )


def step_counts(steps: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns after each named step."""
    rows: list[DataFrame] = []
    for order, (name, df) in enumerate(steps.items()):
        rows.append(df.agg(F.count("*").alias("rows")).select(
            F.lit(order).alias("step_no"), F.lit(name).alias("step"), "rows",
            F.lit(len(df.columns)).alias("columns")))
    out = rows[0]
    for r in rows[1:]:
        out = out.union(r)
    return out


def conditional_counts(df: DataFrame, column: str, values: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One count column per value, in one pass."""
    c = F.col(column)
    counts: list[Column] = [F.count_if(c == v).alias(v) for v in values]
    return df.groupBy(*by).agg(*counts)
