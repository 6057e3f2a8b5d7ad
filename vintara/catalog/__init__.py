"""Registered queries over the given tables, each with its SQL for comparison.

Inputs the reference's domain has and the tables lack (dirty codes, file names, manifests)
are derived from whole tables by row-local expressions, written once as SQL text that both
engines read; what is compared is the work on top of them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

Build = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Build] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Build], Build]:
    """Register a query under its function name."""

    def register(build: Build) -> Build:
        QUERIES[build.__name__] = build
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derive(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Project row-local SQL expressions."""
    return df.selectExpr(*[f"{expression} AS `{name}`" for name, expression in columns.items()])


def derive_sql(source: str, columns: Mapping[str, str]) -> str:
    """The same projection as a SQL subquery."""
    listed = ", ".join(f'{expression} AS "{name}"' for name, expression in columns.items())
    return f"(SELECT {listed} FROM {source})"


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def cases(selector: str, values: list[str], otherwise: str) -> str:
    """CASE that deals the values out by the selector, with an expression for the rest."""
    whens = " ".join(f"WHEN {i} THEN {quote(v)}" for i, v in enumerate(values))
    return f"CASE {selector} {whens} ELSE {otherwise} END"


def recode_sql(value: str, mapping: Mapping[str, str]) -> str:
    whens = " ".join(f"WHEN {quote(k)} THEN {quote(v)}" for k, v in mapping.items())
    return f"CASE {value} {whens} ELSE {value} END"


#: Characters the strip functions remove, as a DuckDB expression.
STRIPPED = " || ".join(f"chr({i})" for i in range(0x3001) if chr(i).isspace())


def strip_sql(value: str) -> str:
    return f"trim({value}, {STRIPPED})"


def load() -> None:
    """Import the modules that register queries."""
    from vintara.catalog import (  # noqa: F401
        cleaning,
        duplicates,
        files,
        harmonising,
        manifests,
        profiling,
        releases,
        webpages,
        wide,
    )
